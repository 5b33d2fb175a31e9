"""Benchmark decontamination: rare n-gram seeds joined on Spark, then Smith-Waterman alignment.

Alignment is local (match 2, other word -1, gap -1); similarity is the best
score over that of the whole item, and 0.8 or more is a leak.  Such a copy has
lost at most floor(0.4 L) points of an item of L words, and no edit spoils
more word pairs than it loses points: an inserted word costs 1 and parts one
pair, a missing end word costs 2 and takes one, a changed or missing inner
word costs 3 and takes two.  So of any floor(0.4 L) + 1 word pairs of the item
one stands unbroken in the copy.  The item's seeds are that many of its pairs,
the rarest in the corpus: no copy is missed, at any corpus size.  At least
L - 1 - floor(0.4 L) pairs must lie near one diagonal before it is aligned.

Counts, seeds, places and candidates are tables.  Tasks get a bitmap of the
pairs' hashes, of fixed size (4 MB) whatever the benchmark, which selects the
places of a text that are counted; those of seeds are then joined with them.
A text is read as words once, its places (at most one a word) are written.

Defined results: null texts and items, and those without words, match
nothing; items of one word are found as that word; equal items each report; a
repeated document row reports once per item and row; item and document ids are
of any type; an empty corpus or benchmark gives an empty result; extra columns
of any name are kept by the filter and ignored by the report.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import fresh, materialize, row_key
from linkloom.llm.words import WordHashes, mix, words

SIMILARITY = 0.8
MATCH, OTHER, GAP = 2, -1, -1
BITMAP_BITS = 1 << 25
STRETCH = 2_000_000  # cells of an alignment held at once, about


def losable(n: int) -> int:
    """Points a copy of an item of ``n`` words may lose, and so the pairs it may lack."""
    return int((1 - SIMILARITY) * MATCH * n + 1e-9)


def pair_hashes(h: np.ndarray) -> np.ndarray:
    """Hashes of every two neighbouring words; of the word itself where there is one only."""
    if len(h) < 2:
        return mix(h + np.uint64(77))
    return mix(mix(h[:-1]) + h[1:])


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: score, and the text range [start, end) it covers."""
    m = len(text)
    steps = np.arange(m + 1)
    score = np.zeros(m + 1, dtype=np.int64)
    origin = steps.copy()
    best = (0, 0, 0)
    for w in item:
        diag = score[:-1] + np.where(text == w, MATCH, OTHER)
        gap = score[1:] + GAP
        h = np.maximum(diag, gap)
        o = np.where(diag >= gap, origin[:-1], origin[1:])
        cell = np.r_[0, np.maximum(h, 0)]
        start = np.r_[0, np.where(h > 0, o, steps[1:])]
        # gaps in the item: running maximum of score minus the way walked
        lifted = cell - GAP * steps
        source = np.maximum.accumulate(lifted)
        lead = np.where(lifted == source, steps, 0)
        lead = np.maximum.accumulate(lead)
        score = source + GAP * steps
        origin = start[lead]
        score[score < 0] = 0
        top = int(score.argmax())
        if score[top] > best[0]:
            best = (int(score[top]), int(origin[top]), top)
    return best


# ---------------------------------------------------------------- items and seeds

def item_pairs(benchmark: DataFrame) -> DataFrame:
    """Written rows of the distinct item texts' pairs: item (hash of the text), n_words, place, pair."""
    texts = (benchmark.where("text is not null").select(F.xxhash64(F.lit(31), "text").alias("item"), "text")
             .groupBy("item").agg(F.first("text").alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            item, n, place, pair = [], [], [], []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h = hashes.array(words(text))
                if len(h):
                    p = pair_hashes(h).view(np.int64)
                    item.append(np.full(len(p), k))
                    n.append(np.full(len(p), len(h)))
                    place.append(np.arange(len(p)))
                    pair.append(p)
            if item:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(t)) for x, t in
                                                  ((item, np.int64), (n, np.int32), (place, np.int32), (pair, np.int64))],
                                                 names=["item", "n_words", "place", "pair"])

    return materialize(texts.mapInArrow(run, "item long, n_words int, place int, pair long"), "item-pairs")


def bitmap(pairs: DataFrame):
    """A broadcast bitmap of the pairs' hashes (of fixed size)."""
    spark = pairs.sparkSession
    byte, bit = F.shiftrightunsigned("at", 3), F.col("at").bitwiseAND(F.lit(7)).cast("int")
    at = F.col("pair").bitwiseAND(F.lit(BITMAP_BITS - 1)).alias("at")
    rows = (pairs.select(at).select(byte.alias("byte"), F.call_function("shiftleft", F.lit(1), bit).alias("m"))
            .groupBy("byte").agg(F.bit_or("m").alias("m")).toArrow())  # at most one row a byte of the bitmap
    bits = np.zeros(BITMAP_BITS // 8, dtype=np.uint8)
    bits[rows.column("byte").to_numpy()] = rows.column("m").to_numpy()
    return spark.sparkContext.broadcast(bits.tobytes())


def _hits(pairs: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = (pairs & np.uint64(BITMAP_BITS - 1)).astype(np.int64)
    return np.flatnonzero((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1)


def item_places(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Written rows (key, pair, place), a text each: the text's pairs that may be an item's, and where; ``docs``: key, text.

    Texts are read as words here only: seeds are counted and found in this table.
    """
    held = bitmap(pairs.select("pair"))
    single = not pairs.where("n_words = 1").isEmpty()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bits = WordHashes(), np.frombuffer(held.value, dtype=np.uint8)
        for batch in (whole.slice(lo, 1000) for whole in batches for lo in range(0, whole.num_rows, 1000)):
            key, ends, pair, place = [], [0], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h = hashes.array(words(text))
                sets = [pair_hashes(h)] if len(h) > 1 else []
                if single and len(h):
                    sets.append(mix(h + np.uint64(77)))
                n = 0
                for p in sets:
                    at = _hits(p, bits)
                    pair.append(p[at].view(np.int64))
                    place.append(at)
                    n += len(at)
                if n:
                    key.append(k)
                    ends.append(ends[-1] + n)
            cuts = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(pair))),
                                              pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(place).astype(np.int32)))],
                                             names=["key", "pair", "place"])

    return materialize(docs.select("key", "text").mapInArrow(run, "key long, pair array<long>, place array<int>"), "item-places",
                       compression="zstd")


def rare_seeds(pairs: DataFrame, places: DataFrame) -> DataFrame:
    """item, n_words, place, pair of each item's floor(0.4 L) + 1 rarest pairs by the corpus's counts; ``places``: :func:`item_places`."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, n = np.unique(batch.column(0).flatten().to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], names=["pair", "n"])

    counts = places.select("pair").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    known = pairs.join(counts, "pair", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = Window.partitionBy("item").orderBy("n", "pair", "place")  # an item's pairs: bounded by its text
    lacks = F.floor(F.lit((1 - SIMILARITY) * MATCH) * F.col("n_words") + F.lit(1e-9))
    return materialize(known.withColumn("rank", F.row_number().over(rarest)).where(F.col("rank") <= lacks + 1)
                       .select("item", "n_words", "place", "pair"), "seeds")


# ---------------------------------------------------------------- candidates

def candidates(seeds: DataFrame, places: DataFrame) -> DataFrame:
    """(key, item, shifts): where seeds of an item lie in a text, as text place minus item place; ``places``: :func:`item_places`."""
    held = bitmap(seeds.select("pair"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(held.value, dtype=np.uint8)
        for batch in batches:
            pair, place = (batch.column(i).flatten().to_numpy() for i in (1, 2))
            at = _hits(pair.view(np.uint64), bits)
            key = np.repeat(batch.column(0).to_numpy(), batch.column(1).value_lengths().to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(x[at]) for x in (key, pair, place)], names=["key", "pair", "place"])

    found = places.mapInArrow(run, "key long, pair long, place int")
    lead = seeds.select("item", F.col("place").alias("own"), "pair")
    return materialize(found.join(lead, "pair").groupBy("key", "item")
                       .agg(F.sort_array(F.collect_set(F.col("place") - F.col("own"))).alias("shifts")), "leak-candidates")


def _stretches(shifts: list[int], n: int, length: int) -> list[tuple[int, int]]:
    """Stretches of a text (word places) that copies with seeds at ``shifts`` cannot leave, joined where they touch."""
    slack = 2 * losable(n) + 2  # words a copy can have before its first unbroken pair, or more than the item
    out: list[list[int]] = []
    for s in shifts:
        lo, hi = max(0, s - slack), min(length, s + n + slack)
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(x) for x in out]


def best_copy(item: np.ndarray, text: np.ndarray, shifts: list[int]) -> tuple[float, int, int] | None:
    """(similarity, first word, end word) of the best copy at or above the threshold; arguments are word hashes."""
    n = len(item)
    need = max(1, n - 1 - losable(n)) if n > 1 else 1
    own = np.unique(pair_hashes(item))
    found = (0.0, 0, 0)
    for lo, hi in _stretches(shifts, n, len(text)):
        part = text[lo:hi]
        pairs = pair_hashes(part) if n > 1 else mix(part + np.uint64(77))
        if n > 1 and len(part) < 2:
            continue
        held = np.flatnonzero(np.isin(pairs, own))
        reach = n + losable(n)
        # windows as long as a copy can be that hold enough of the item's pairs
        crowd = np.searchsorted(held, held + reach) - np.arange(len(held))
        at = held[crowd >= min(need, len(held) + 1)] if len(held) else held
        for a, b in _stretches((at + lo).tolist(), n, len(text)) if len(at) else []:
            step = max(4 * (n + reach), STRETCH // max(1, n))
            for c in range(a, b, step):  # stretches overlap by the longest copy
                score, first, end = align(item, text[c:min(b, c + step + 2 * reach)])
                found = max(found, (score / (MATCH * n), c + first, c + end), key=lambda x: (x[0], -x[1]))
    return found if found[0] >= SIMILARITY - 1e-12 else None


def leak_pairs(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Written rows (key, item, similarity, first_word, end_word); ``docs``: key (of the text), text, copies included."""
    items = item_pairs(benchmark)
    places = item_places(items, docs)
    near = candidates(rare_seeds(items, places), places)
    texts = docs.join(near.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    wanted = (benchmark.where("text is not null").select(F.xxhash64(F.lit(31), "text").alias("item"), F.col("text").alias("item_text"))
              .groupBy("item").agg(F.first("item_text").alias("item_text")))
    both = near.join(wanted, "item").join(texts, "key").select("key", "item", "shifts", "item_text", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        last: tuple = (None, None)
        for batch in batches:
            row, found = [], []
            for r in range(batch.num_rows):
                key = batch.column(0)[r].as_py()
                if key != last[0]:
                    last = (key, hashes.array(words(batch.column(4)[r].as_py())))
                copy = best_copy(hashes.array(words(batch.column(3)[r].as_py())), last[1], batch.column(2)[r].as_py())
                if copy:
                    row.append(r)
                    found.append(copy)
            take = pa.array(row, pa.int64())
            similarity, first, end = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(similarity, pa.float64()),
                                              pa.array(first, pa.int32()), pa.array(end, pa.int32())],
                                             names=["key", "item", "similarity", "first_word", "end_word"])

    return materialize(both.mapInArrow(run, "key long, item long, similarity double, first_word int, end_word int"), "leaks")


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row and item it holds: doc_id, item_id, similarity, first_word, end_word."""
    keyed = row_key(docs.where("text is not null").select("doc_id", "text"), "key")
    found = leak_pairs(keyed.select("key", "text"), benchmark)
    ids = benchmark.where("text is not null").select("item_id", F.xxhash64(F.lit(31), "text").alias("item"))
    return (keyed.select("doc_id", "key").join(found, "key").join(ids, "item")
            .select("doc_id", "item_id", "similarity", "first_word", "end_word"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no test item; all columns as they were."""
    (key,) = fresh(docs, "key")
    keyed = row_key(docs, key)
    found = leak_pairs(keyed.where("text is not null").select(F.col(key).alias("key"), "text"), benchmark)
    gone = found.select(F.col("key").alias(key)).distinct()
    return keyed.join(gone, key, "left_anti").select(*[f"`{c}`" for c in docs.columns])
