"""Line dedup by winnowing: later copies of repeated runs of lines go.

A line of w words counts as ceil(w / 25) units, blank lines as none.  In every
window of 3 units the least line hash (rightmost on ties) is its fingerprint,
so any two equal runs of 3 units share fingerprints at equal places.  Only
windows under a fingerprint that occurs twice go on; equal windows are joined
on their content, the first in document order stays, and a line goes if a
window of a later occurrence touches it: joined windows extend a match both
ways to the whole run.  A run below 3 units (three short lines, or one line
of 51 words) is no match.

Document order is (doc_id, nulls last; then content hash; then line).
Defined results: null text stays null and has no lines; rows equal in doc_id
and text are one document; an empty table gives an empty result; blank lines
stay; extra columns of any name are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm.common import fresh, materialize, null_safe, row_key
from linkloom.llm.words import hash64

UNIT_WORDS = 25
UNITS = 3


def line_units(text: str) -> tuple[list[int], list[int]]:
    """Unit hashes in order, and the line each belongs to."""
    units, owner = [], []
    for i, line in enumerate(text.split("\n")):
        n = len(line.split())
        if n:
            h = hash64(line.encode("utf-8", "surrogatepass"))
            for j in range(-(-n // UNIT_WORDS)):
                units.append(hash((h, j)))  # of integers: the same in every process
                owner.append(i)
    return units, owner


def winnow(units: list[int], width: int = UNITS) -> list[tuple[int, int, int]]:
    """(fingerprint, window hash, start) of every window."""
    out = []
    for s in range(len(units) - width + 1):
        window = units[s:s + width]
        out.append((min(window), hash(tuple(window)), s))
    return out


def fingerprints(docs: DataFrame, key: str) -> DataFrame:
    """Windows nested under their selected minimum: doc_id, key, print, windows (hash, start)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, key long, print long, windows array<struct<hash:long,start:int>>"
    item = pa.list_(pa.struct([("hash", pa.int64()), ("start", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                some = batch.slice(lo, 2000)
                row, prints, windows = [], [], []
                for r, text in enumerate(some.column(2).to_pylist()):
                    nest: dict[int, list[dict]] = {}
                    for p, w, s in winnow(line_units(text)[0]):
                        nest.setdefault(p, []).append({"hash": w, "start": s})
                    row.extend([r] * len(nest))
                    prints.extend(nest)
                    windows.extend(nest.values())
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(take), some.column(1).take(take), pa.array(prints, pa.int64()),
                     pa.array(windows, item)], names=["doc_id", "key", "print", "windows"])

    return (docs.where("text is not null").select("doc_id", F.col(key).alias("key"), "text").mapInArrow(run, schema))


def repeated_starts(docs: DataFrame, key: str) -> DataFrame:
    """(doc_id, key, starts): starts of windows that also occur earlier."""
    marks = materialize(fingerprints(docs, key), "fingerprints")
    twice = marks.groupBy("print").agg(F.sum(F.size("windows")).alias("n")).where("n > 1").select("print")
    windows = (marks.join(twice, "print", "left_semi")
               .select("doc_id", "key", "print", F.explode("windows").alias("w"))
               .select("doc_id", "key", "print", "w.hash", "w.start"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "start")
    first = (windows.groupBy("print", "hash").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").drop("n"))
    later = windows.join(first, ["print", "hash"]).where(place > F.col("first"))
    return later.groupBy("doc_id", "key").agg(F.collect_set("start").alias("starts"))


def dedup_lines(docs: DataFrame, report: bool = False) -> DataFrame:
    """The documents without later repeated runs; ``report`` adds n_lines and n_removed."""
    key, lost, d, k = fresh(docs, "key", "starts", "d", "k")
    keyed = row_key(docs, key)
    gone = repeated_starts(keyed, key).select(F.col("doc_id").alias(d), F.col("key").alias(k), F.col("starts").alias(lost))
    joined = keyed.join(gone, null_safe(keyed, gone, [("doc_id", d), (key, k)]), "left").drop(d, k)
    columns = docs.schema.fields
    counts = [T.StructField(n, T.LongType()) for n in ("n_lines", "n_removed")] if report else []
    out_schema = T.StructType([*columns, *counts])
    at = [f.name for f in columns].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (many.slice(lo, 500) for many in batches for lo in range(0, many.num_rows, 500)):
            texts, lines, removed = [], [], []
            for text, starts in zip(batch.column(at).to_pylist(), batch.column(len(columns)).to_pylist()):
                kept, n, m = cut_lines(text, starts)
                texts.append(kept)
                lines.append(n)
                removed.append(m)
            cols = [batch.column(i) for i in range(len(columns))]
            cols[at] = pa.array(texts, cols[at].type)
            if report:
                cols += [pa.array(lines, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=out_schema.names)

    return joined.select(*[f"`{f.name}`" for f in columns], lost).mapInArrow(run, out_schema)


def cut_lines(text: str | None, starts: list[int] | None) -> tuple[str | None, int, int]:
    """Text without the lines that windows at ``starts`` touch; lines before; lines removed."""
    if text is None:
        return None, 0, 0
    lines = text.split("\n")
    if not starts:
        return text, len(lines), 0
    owner = line_units(text)[1]
    drop = {owner[u] for s in starts for u in range(s, s + UNITS)}
    return "\n".join(x for i, x in enumerate(lines) if i not in drop), len(lines), len(drop)
