"""Toxicity score: character n-grams scaled by naive Bayes log-count ratios, logistic weights.

The fit takes at most ``SAMPLE`` labelled rows (those with the least hash of
doc_id; a document counts as toxic if any of its label rows says so) and at
most ``FEATURES`` hashed n-grams of 3 to 6 characters: those whose document
counts differ most surely between the classes.  A feature's value is
log(1 + count) / sqrt(n-grams of the text) times its log-count ratio; the
weights come from logistic regression on the sample.  Every whole text is
scored by a map-only pass.

Defined results: null reads as empty; an empty text gets the base rate that
the model learnt; without usable labels of both classes every score is the
share of toxic labels (0 without labels); rows are scored one by one, so
repeated rows repeat; an empty table gives an empty result; extra columns
are kept by the filter and ignored by the report.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import Shared, body, materialize

SAMPLE = 12_000
FEATURES = 8_000
BITS = 20
SIZES = (3, 4, 5, 6)
SURE = 4.0        # least |log ratio| in standard errors
THRESHOLD = 0.3
_CHUNK = 1 << 20  # characters hashed at once
_SLICES = 64


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def ngram_buckets(text: str) -> Iterator[np.ndarray]:
    """Hash buckets of the n-grams of a text in lower case with single blanks, chunk by chunk."""
    chars = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    reach = max(SIZES) - 1
    for lo in range(0, len(chars), _CHUNK):
        own = min(_CHUNK, len(chars) - lo)
        part = chars[lo:lo + own + reach] * np.uint32(0x9E3779B1)
        h = np.zeros(len(part), dtype=np.uint32)
        for n in range(1, max(SIZES) + 1):
            if len(part) < n:
                break
            h = h[:len(part) - n + 1] * np.uint32(0x01000193) + part[n - 1:]
            if n in SIZES:
                z = h[:own] ^ np.uint32((n * 0x85EBCA6B) & 0xFFFFFFFF)
                z = (z ^ (z >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
                yield (z ^ (z >> np.uint32(12))) >> np.uint32(32 - BITS)


@dataclass
class Model:
    place: np.ndarray    # bucket -> feature number, -1 for none
    weight: np.ndarray   # log-count ratio times weight
    bias: float

    def features(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers present and their values before scaling."""
        hits, total = [], 0
        for buckets in ngram_buckets(text):
            total += len(buckets)
            at = self.place[buckets]
            hits.append(at[at >= 0])
        number, n = np.unique(np.concatenate(hits), return_counts=True) if hits else (np.zeros(0, int), np.zeros(0))
        return number, np.log1p(n) / np.sqrt(max(total, 1))

    def score(self, text: str) -> float:
        number, value = self.features(text)
        z = float(value @ self.weight[number]) + self.bias
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, toxic) of the sampled rows, none of them held out."""
    ids = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
           .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    return (docs.select("doc_id", body().alias("text"))
            .join(F.broadcast(materialize(ids, "label-sample")), "doc_id")  # at most ``sample`` rows of two numbers
            .select("text", "toxic"))


def _count_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document counts per bucket and class of one task, as slices of the bucket range."""
    counts = np.zeros((2, 1 << BITS), dtype=np.int32)
    size = np.zeros(2, dtype=np.int64)
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = list(ngram_buckets(text))
            if found:
                counts[toxic, np.unique(np.concatenate(found))] += 1
            size[toxic] += 1
    if size.any():
        width = (1 << BITS) // _SLICES
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(_SLICES), pa.int32()),
             *[pa.array([counts[c, k * width:(k + 1) * width].tobytes() for k in range(_SLICES)], pa.binary()) for c in (0, 1)],
             *[pa.array([int(size[c])] * _SLICES, pa.int64()) for c in (0, 1)]],
            names=["slice", "clean", "toxic", "n_clean", "n_toxic"])


def _sure_features(table: pa.Table) -> pa.Table:
    """Features of one slice: bucket, log-count ratio, its size in standard errors."""
    total = [sum(np.frombuffer(b, dtype=np.int32).astype(np.int64) for b in table.column(c).to_pylist()) for c in ("clean", "toxic")]
    n = [sum(table.column(c).to_pylist()) for c in ("n_clean", "n_toxic")]
    clean, toxic = total
    ratio = np.log(((toxic + 0.5) / (n[1] + 1)) / ((clean + 0.5) / (n[0] + 1)))
    sure = np.abs(ratio) / np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    keep = np.flatnonzero((sure > SURE) & (clean + toxic >= 4))
    first = table.column("slice")[0].as_py() * len(clean)
    return pa.table({"bucket": pa.array(keep + first, pa.int64()), "ratio": ratio[keep], "sure": sure[keep]})


def fit_logistic(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, y: np.ndarray, width: int,
                 rounds: int = 120, decay: float = 1e-6) -> tuple[np.ndarray, float]:
    """Logistic regression on a sparse matrix by Adam steps over the whole sample."""
    base = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    theta = np.zeros(width + 1)
    theta[-1] = np.log(base / (1 - base))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    parts = [slice(lo, lo + 200_000) for lo in range(0, len(values), 200_000)]
    for t in range(1, rounds + 1):
        z = np.full(len(y), theta[-1])
        for part in parts:  # slices keep the temporaries small
            z += np.bincount(rows[part], weights=values[part] * theta[cols[part]], minlength=len(y))
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        grad = np.zeros_like(theta)
        grad[-1] = err.sum()
        for part in parts:
            grad[:-1] += np.bincount(cols[part], weights=values[part] * err[rows[part]], minlength=width)
        grad[:-1] += decay * theta[:-1]
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad * grad
        theta -= 0.1 * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-9)
    return theta[:-1], float(theta[-1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    rows = materialize(labelled_sample(docs, labels, sample).repartition(12), "labelled")
    none = np.full(1 << BITS, -1, dtype=np.int32)
    share = rows.agg(F.avg("toxic").alias("m")).first()["m"]
    if share is None or share in (0.0, 1.0):
        odds = np.clip(share or 0.0, 1e-9, 1 - 1e-9)
        return Model(none, np.zeros(0), float(np.log(odds / (1 - odds))))
    slices = rows.mapInArrow(_count_slices, "slice int, clean binary, toxic binary, n_clean long, n_toxic long")
    chosen = (slices.groupBy("slice").applyInArrow(_sure_features, "bucket long, ratio double, sure double")
              .orderBy(F.desc("sure"), "bucket").limit(FEATURES).collect())
    place = none.copy()
    ratio = np.array([r["ratio"] for r in chosen], dtype=float)
    for i, r in enumerate(chosen):
        place[r["bucket"]] = i
    bare = Model(place, np.zeros(len(chosen)), 0.0)

    def matrix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, value = zip(*[bare.features(t) for t in batch.column(0).to_pylist()]) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([n.astype(np.int32).tobytes() for n in number], pa.binary()),
                 pa.array([v.astype(np.float32).tobytes() for v in value], pa.binary())], names=["toxic", "number", "value"])

    got = rows.mapInArrow(matrix, "toxic int, number binary, value binary").toArrow()  # bounded by sample and features
    y = got.column("toxic").to_numpy().astype(float)
    cols = np.concatenate([np.frombuffer(b, dtype=np.int32) for b in got.column("number").to_pylist()])
    values = np.concatenate([np.frombuffer(b, dtype=np.float32) for b in got.column("value").to_pylist()])
    sizes = [len(b) // 4 for b in got.column("number").to_pylist()]
    del got
    at = np.repeat(np.arange(len(y), dtype=np.int32), sizes)
    scale = 20.0
    values *= (ratio * scale).astype(np.float32)[cols]
    weight, bias = fit_logistic(at, cols, values, y, len(chosen))
    return Model(place, weight * ratio * scale, bias)


def _scores(model: Model, texts: list[str | None]) -> list[float]:
    return [model.score(t or "") for t in texts]


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted per row."""
    model = Shared(docs.sparkSession, fit(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_scores(model.value, batch.column(1).to_pylist()), pa.float64())],
                names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted not toxic; all columns as they were."""
    model = Shared(docs.sparkSession, fit(docs, labels))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (many.slice(lo, 500) for many in batches for lo in range(0, many.num_rows, 500)):
            keep = [s < THRESHOLD for s in _scores(model.value, batch.column(at).to_pylist())]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
