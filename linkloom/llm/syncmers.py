"""Document fingerprints from closed syncmers, and their likeness by order-keeping matches.

A k-mer of 16 code points is an anchor if the least of its 12 inner 5-mers (by
hash) is its first or its last one.  That depends on the k-mer alone, so an
edit moves no anchor outside the k-mers it touches, and at least one of any 12
consecutive k-mers is an anchor.  The fingerprint lists all anchors of the
text in order, 5 letters of base 64 each: 24 bits of the k-mer's hash and the
distance to the anchor before (at most 63).  A text without an anchor (short
ones) has one for the whole text; an empty text has an empty fingerprint.

Likeness matches equal anchors (the i-th of equal ones with the i-th) and
takes a longest chain that keeps the order in both texts; every anchor weighs
its distance.  It is the matched weight over the whole weight: 1 for equal
fingerprints, 0 without a common anchor.

For the document that follows each one, distinct documents are split by range
of (doc_id, content hash); every range gets a copy of the first document of
the next one, and is read in order by one task.  Only the ranges' first keys
(one per shuffle partition) go through the driver.

Defined results: null text is empty; null ids come first; rows equal in doc_id
and text follow each other, rows of one id go by content hash; a single
document follows itself; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from linkloom.llm.common import body, materialize, null_safe
from linkloom.llm.words import mix

K = 16
S = 5
WINDOW = K - S + 1
LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", dtype=np.uint8)
VALUES = np.zeros(128, dtype=np.int64)
VALUES[LETTERS] = np.arange(64)
ANCHOR = 5  # letters


# ---------------------------------------------------------------- fingerprints

def _rolling(code: np.ndarray, at: np.ndarray | None, size: int) -> np.ndarray:
    """Hashes of ``size`` code points from every place of ``at`` (all places if None)."""
    n = len(code) - size + 1
    out = np.zeros(n if at is None else len(at), dtype=np.uint64)
    for j in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + (code[j:j + n] if at is None else code[at + j]) + np.uint64(1)
    return mix(out)


def _least(v: np.ndarray, window: int) -> np.ndarray:
    """Minimum of every ``window`` consecutive values."""
    size = 1
    while 2 * size <= window:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    rest = window - size
    return np.minimum(v[:len(v) - rest], v[rest:]) if rest else v


def anchors(text: str) -> tuple[np.ndarray, np.ndarray]:
    """24-bit hashes of the closed syncmers in order, and their distances."""
    if not text:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    place = np.zeros(0, dtype=np.int64)
    if len(code) >= K:
        inner = _rolling(code, None, S)
        least = _least(inner, WINDOW)
        place = np.flatnonzero((least == inner[:len(least)]) | (least == inner[WINDOW - 1:]))
    if not len(place):
        return (_rolling(code, None, len(code)) >> np.uint64(40)).astype(np.int64), np.ones(1, dtype=np.int64)
    return (_rolling(code, place, K) >> np.uint64(40)).astype(np.int64), np.minimum(np.diff(place, prepend=-1), 63)


def fingerprint(text: str | None) -> str:
    hashes, gaps = anchors(text or "")
    out = np.empty((len(hashes), ANCHOR), dtype=np.uint8)
    for j in range(4):
        out[:, j] = LETTERS[(hashes >> (18 - 6 * j)) & 63]
    out[:, 4] = LETTERS[gaps]
    return out.tobytes().decode("ascii")


def _read(mark: str) -> tuple[np.ndarray, np.ndarray]:
    v = VALUES[np.frombuffer(mark.encode("ascii"), dtype=np.uint8)].reshape(-1, ANCHOR)
    return (v[:, 0] << 18) | (v[:, 1] << 12) | (v[:, 2] << 6) | v[:, 3], np.maximum(v[:, 4], 1)


def _numbered(h: np.ndarray) -> np.ndarray:
    """Each hash with the count of equal ones before it."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.r_[True, s[1:] != s[:-1]]
    start = np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
    out = np.empty(len(h), dtype=np.int64)
    out[order] = (s << 32) | (np.arange(len(s)) - start)
    return out


def chain(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of a longest chain of matches that rises in both; equal ends are always in it."""
    n = min(len(a), len(b))
    lead = int(np.argmin(np.r_[a[:n] == b[:n], False]))
    tail = int(np.argmin(np.r_[a[len(a) - (n - lead):][::-1] == b[len(b) - (n - lead):][::-1], False]))
    ends = np.r_[0:lead], np.arange(tail)
    inner_a, inner_b = a[lead:len(a) - tail], b[lead:len(b) - tail]
    pick_a = pick_b = np.zeros(0, dtype=np.int64)
    if len(inner_a) and len(inner_b):
        _, at_a, at_b = np.intersect1d(_numbered(inner_a), _numbered(inner_b), assume_unique=True, return_indices=True)
        order = np.argsort(at_a)
        at_a, at_b = at_a[order], at_b[order]
        keep = _rising(at_b.tolist())
        pick_a, pick_b = at_a[keep] + lead, at_b[keep] + lead
    return (np.r_[ends[0], pick_a, ends[1] + len(a) - tail].astype(np.int64),
            np.r_[ends[0], pick_b, ends[1] + len(b) - tail].astype(np.int64))


def _rising(values: list[int]) -> list[int]:
    """Places of a longest rising subsequence of distinct values."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        back.append(at[k - 1] if k else -1)
        if k == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[k] = v
            at[k] = i
    out = []
    i = at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def likeness(a: str, b: str) -> float:
    """Share of two fingerprints' weight that an order-keeping chain of equal anchors holds."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    (ha, wa), (hb, wb) = _read(a), _read(b)
    pa_, pb_ = chain(ha, hb)
    return float(wa[pa_].sum() + wb[pb_].sum()) / float(wa.sum() + wb.sum())


# ---------------------------------------------------------------- documents in order

def _unique(docs: DataFrame) -> DataFrame:
    """doc_id, key (content hash), text, n: rows equal in doc_id and text are one; they alone are shuffled for it."""
    rows = docs.select("doc_id", F.xxhash64(F.lit(13), body()).alias("key"), body().alias("text"))
    counts = materialize(rows.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n")), "keys")
    again = counts.where("n > 1").select(F.col("doc_id").alias("d_"), F.col("key").alias("k_"))
    if again.isEmpty():
        return rows.withColumn("n", F.lit(1).cast("long"))
    same = null_safe(rows, again, [("doc_id", "d_"), ("key", "k_")])
    many = (rows.join(again, same, "left_semi").groupBy("doc_id", "key")
            .agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("n")))
    return rows.join(again, same, "left_anti").withColumn("n", F.lit(1).cast("long")).unionByName(many)


def in_order(docs: DataFrame) -> DataFrame:
    """Distinct documents in ranges: range, guest (a copy of the next range's first), doc_id, key, text, n; sorted, one task a range."""
    spark = docs.sparkSession
    rows = _unique(docs)
    keys = materialize(rows.select("doc_id", "key"), "ids")
    order = [F.asc_nulls_first("doc_id"), "key"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", "key")
    firsts = (keys.repartitionByRange(n, *order).groupBy(F.spark_partition_id().alias("part")).agg(F.min(place).alias("first"))
              .orderBy("part").collect())  # one row a partition
    splits = [(r["first"]["has"], r["first"]["doc_id"], r["first"]["key"]) for r in firsts]

    @F.arrow_udf("int")
    def span(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        return pa.array([bisect_right(splits, (d is not None, d, k)) - 1 for d, k in zip(ids.to_pylist(), hashes.to_pylist())], pa.int32())

    own = rows.select(span("doc_id", "key").alias("range"), F.lit(False).alias("guest"), "doc_id", "key", "text", "n")
    heads = spark.createDataFrame([(d, k, (i - 1) % len(splits)) for i, (_, d, k) in enumerate(splits)],
                                  f"d_ {docs.schema['doc_id'].dataType.simpleString()}, k_ long, range int")
    guests = (rows.join(F.broadcast(heads), null_safe(rows, heads, [("doc_id", "d_"), ("key", "k_")]))
              .select("range", F.lit(True).alias("guest"), "doc_id", "key", "text", "n"))
    return (own.unionByName(guests).repartition(n, "range")
            .sortWithinPartitions("range", "guest", *order))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, text fingerprint, the edited text's hash and fingerprint, and both likenesses.

    The edited text has the last half (rounded down) of its code points
    replaced by the first as many of the document that follows.
    """
    doc_id = docs.schema["doc_id"].dataType
    schema = (f"doc_id {doc_id.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [to_arrow_type(doc_id), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def edited(doc, text, mark, following, following_mark):
        half = len(text) // 2
        new = text[:len(text) - half] + following[:half]
        new_mark = fingerprint(new)
        return (doc, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), mark, new_mark,
                likeness(mark, new_mark), likeness(mark, following_mark))

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # range, doc_id, text, fingerprint
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                out = []
                some = batch.slice(lo, 500)
                for span, guest, doc, text, n in zip(*[c.to_pylist() for c in some.columns]):
                    mark = fingerprint(text)
                    if last is not None and last[0] == span:
                        out.append(edited(*last[1:], text, mark))
                    last = (span, doc, text, mark)
                    if guest:
                        last = None
                        continue
                    if n > 1:
                        row = edited(doc, text, mark, text, mark)
                        for _ in range(n - 1):
                            out.append(row)
                            if len(out) == 500:
                                yield batch_of(out)
                                out = []
                if out:
                    yield batch_of(out)

    return in_order(docs).select("range", "guest", "doc_id", "text", "n").mapInArrow(run, schema)
