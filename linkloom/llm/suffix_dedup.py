"""Removal of byte strings that occur more than once, by sorted suffixes at sampled places.

Any two equal 400-byte strings hold an equal 200-byte string that is a local
minimum of its hash in both (a window of 201 starts), so only suffixes that
start at such minima are kept (about one in a hundred).  They are
range-partitioned by sampled splitters on their leading token (a 64-bit hash
of the first 200 bytes, with a salt for very large runs) and
sorted inside each range; neighbours with equal leads are the candidates.
In a run of equal leads every 400-byte window around the shared lead is
classed by its place and digest.

A lead held by very many suffixes is refined: the 201 windows around it fall
into 8 classes by where they start, the windows of a class share at least 375
bytes, and the hash of those is the class's leading token.  Tokens held once
go; a run that is still large is split by a salt, and its windows are
compared across the boundaries of its pieces as well.

Exact up to collisions of two independent 64-bit hashes at equal place.
Defined results: null text is empty; texts under 400 bytes lose nothing;
equal rows are documents of their own; bytes, not characters, are cut (the
result is binary); an empty table gives an empty result; extra columns are
ignored by the report and kept by the rewrite.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import body, fresh, materialize, null_safe, row_key
from linkloom.llm.words import mix

LENGTH = 400
LEAD = 200
CROWD = 4000  # suffixes of one lead that a task compares at once; more are refined, then split by a salt
CLASSES = [(lo, min(lo + 24, LENGTH - LEAD)) for lo in range(0, LENGTH - LEAD + 1, 25)]  # bytes of a window before the lead
if CLASSES[-1][0] == CLASSES[-1][1]:  # 200 itself joins the class before it
    CLASSES[-2:] = [(CLASSES[-2][0], LENGTH - LEAD)]
MAP_BITS, SLICE_BITS = 26, 19
AT_ONCE = 1500  # suffixes of several leads that a task compares at once
HASHED_AT_ONCE = 256  # of those, suffixes whose bytes are hashed at once

_P = np.uint64(0x9E3779B97F4A7C15)


def _inverse(p: int) -> int:
    return pow(p, -1, 1 << 64)


_Q = np.uint64(_inverse(int(_P)))
_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Powers of the hash base and its inverse, grown as needed."""

    def __init__(self) -> None:
        self.n = 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, 2 * self.n, 1 << 16)
            self.up, self.down = _powers(_P, self.n), _powers(_Q, self.n)
        return self.up, self.down


def window_hashes(data: np.ndarray, width: int, powers: Powers) -> np.ndarray:
    """64-bit hashes of every ``width`` consecutive bytes."""
    n = len(data)
    if n < width:
        return np.zeros(0, dtype=np.uint64)
    up, down = powers.upto(n + 1)
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_TABLE[data] * up[:n], out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * down[:n - width + 1])


def sliding_argmin(v: np.ndarray, width: int) -> np.ndarray:
    """Distinct places that hold the minimum of some ``width`` consecutive values."""
    n = len(v)
    if n < width:
        return np.zeros(0, dtype=np.int64)
    pad = -n % width
    w = np.concatenate([v, np.full(pad, np.iinfo(np.uint64).max, dtype=np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(w, axis=1).ravel()
    behind = np.minimum.accumulate(w[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(behind[:n - width + 1], ahead[width - 1:n])
    change = np.r_[True, low[1:] != low[:-1]]
    # every place that holds its window's minimum; equal values are all kept
    first = np.flatnonzero(change)
    out = []
    ends = np.r_[first[1:], len(low)]
    for s, e in zip(first.tolist(), ends.tolist()):
        seg = v[s:e - 1 + width]
        out.append(s + np.flatnonzero(seg == low[s]))
    return np.unique(np.concatenate(out))


def leads(data: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Places of the sampled suffixes of one document, and their leading tokens."""
    if len(data) < LENGTH:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    h = window_hashes(data, LEAD, powers)
    at = sliding_argmin(h, LENGTH - LEAD + 1)
    return at, h[at]


def fold_periods(at: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which sampled suffixes to keep, and byte runs that repeat within themselves.

    Suffixes of one lead at a constant step d <= 200 lie in a stretch of
    period d.  In a stretch of 1000 bytes or more every 400-byte window comes
    again d bytes further or earlier, so the stretch is covered as a whole;
    its first and last suffix (for windows over its ends) and one with a full
    context inside it (for equal windows elsewhere) stand for the others.
    """
    keep = np.ones(len(at), dtype=bool)
    if len(at) < 3:
        return keep, []
    step = np.diff(at)
    same = (lead[1:] == lead[:-1]) & (step <= LEAD)
    chain = np.r_[False, same[1:] & same[:-1] & (step[1:] == step[:-1])]  # gap i goes on with the step of gap i - 1
    spans = []
    first = np.flatnonzero(same & ~chain)
    for g in first.tolist():
        end = g + 1
        while end < len(same) and chain[end]:
            end += 1
        a, z = int(at[g]), int(at[end])
        if z + LEAD - a >= 1000:
            spans.append((a, z + LEAD))
            middle = g + int(np.searchsorted(at[g:end + 1], a + LENGTH - LEAD))
            keep[g + 1:end] = False
            keep[middle] = True
    return keep, spans


def sampled_suffixes(docs: DataFrame, key: str) -> DataFrame:
    """(doc_id, key, place, lead) of every sampled suffix, and (doc_id, key, place, stop) of periodic stretches."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, key long, place int, lead long, stop int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                some = batch.slice(lo, 1000)
                rows, places, tokens, periods = [], [], [], []
                for r, raw in enumerate(some.column(2)):
                    at, lead = leads(np.frombuffer(raw.as_buffer(), dtype=np.uint8), powers)
                    keep, spans = fold_periods(at, lead)
                    rows.append(np.full(int(keep.sum()), r))
                    places.append(at[keep].astype(np.int32))
                    tokens.append(lead[keep].view(np.int64))
                    periods.extend((r, *x) for x in spans)
                n, m = sum(map(len, rows)), len(periods)
                take = pa.array(np.concatenate([*rows, np.array([x[0] for x in periods], dtype=np.int64)]))
                place = np.concatenate([*places, np.array([x[1] for x in periods], dtype=np.int32)])
                real = np.arange(n + m) >= n
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(take), some.column(1).take(take), pa.array(place),
                     pa.array(np.concatenate([*tokens, np.zeros(m, dtype=np.int64)]), mask=real),
                     pa.array(np.r_[np.zeros(n, dtype=np.int32), np.array([x[2] for x in periods], dtype=np.int32)], mask=~real)],
                    names=["doc_id", "key", "place", "lead", "stop"])

    return (docs.where(F.octet_length(body()) >= LENGTH)
            .select("doc_id", F.col(key).alias("key"), body().cast("binary").alias("raw")).mapInArrow(run, schema))


def marked_keys(keys: DataFrame, spark) -> Callable[[Column], Column]:
    """A test that holds for every key in ``keys`` (and for few others while they are under 2**23).

    A bitmap of 2**26 bits (8 MB) whatever the corpus size, put together in
    slices.  It only spares rows a shuffle; the join after it decides.
    """
    def fill(table: pa.Table) -> pa.Table:
        bits = np.zeros(1 << SLICE_BITS, dtype=bool)
        bits[table.column("slot").to_numpy() & ((1 << SLICE_BITS) - 1)] = True
        return pa.table({"slice": table.column("slice").slice(0, 1), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    slot = F.pmod("key", F.lit(1 << MAP_BITS)).cast("long")
    parts = (keys.select(slot.alias("slot")).distinct()
             .withColumn("slice", F.shiftright("slot", SLICE_BITS).cast("int"))
             .groupBy("slice").applyInArrow(fill, "slice int, bits binary").collect())  # at most 8 MB
    whole = np.zeros(1 << (MAP_BITS - 3), dtype=np.uint8)
    width = 1 << (SLICE_BITS - 3)
    for r in parts:
        whole[r["slice"] * width:(r["slice"] + 1) * width] = np.frombuffer(r["bits"], dtype=np.uint8)
    held = spark.sparkContext.broadcast(whole)

    @F.pandas_udf("boolean")
    def test(key: pd.Series) -> pd.Series:
        at = key.to_numpy() & ((1 << MAP_BITS) - 1)
        return pd.Series((held.value[at >> 3] >> (7 - (at & 7))) & 1 == 1)

    return test


def with_marks(docs: DataFrame, key: str, marked: DataFrame) -> DataFrame:
    """(doc_id, key, raw, marks) of the texts that hold marked suffixes."""
    test = marked_keys(marked.select("key"), docs.sparkSession)
    plain = docs.where(test(F.col(key))).select("doc_id", F.col(key).alias("key"), body().cast("binary").alias("raw"))
    wanted = marked.select(F.col("doc_id").alias("__d"), F.col("key").alias("__k"), "marks")
    return (plain.join(wanted, null_safe(plain, wanted, [("doc_id", "__d"), ("key", "__k")]))
            .select("doc_id", "key", "raw", "marks"))


def refined(docs: DataFrame, key: str, crowded: DataFrame) -> DataFrame:
    """(doc_id, key, place, low, high, lead) per class of windows of every crowded suffix.

    The lead is the hash of what all windows of the class share, mixed with
    the class and the old lead; a class without a whole window has no row.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    held = crowded.groupBy("doc_id", "key").agg(F.collect_set(F.struct("place", "lead")).alias("marks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                some = batch.slice(lo, 200)
                rows, out = [], []
                for r, (raw, own) in enumerate(zip(some.column(2), some.column(3).to_pylist())):
                    data = np.frombuffer(raw.as_buffer(), dtype=np.uint8)
                    place = np.array([m["place"] for m in own], dtype=np.int64)
                    lead = np.array([m["lead"] for m in own], dtype=np.int64).view(np.uint64)
                    for low, high in CLASSES:
                        width = LENGTH - (high - low)
                        start = place - low
                        whole = (start >= 0) & (start + width <= len(data))
                        hashes = window_hashes(data, width, powers)[start[whole]]
                        name = mix(hashes + mix(lead[whole] + np.uint64(low)) * _P)
                        n = len(name)
                        rows.append(np.full(n, r))
                        out.append((place[whole], np.full(n, low), np.full(n, high), name.view(np.int64)))
                take = pa.array(np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64), pa.int64())
                cols = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, dtype=np.int64)] * 4
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(take), some.column(1).take(take),
                     *[pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.int64()))]],
                    names=["doc_id", "key", "place", "low", "high", "lead"])

    return with_marks(docs, key, materialize(held, "crowded")).mapInArrow(
        run, f"doc_id {kind}, key long, place int, low int, high int, lead long")


def suffix_contexts(docs: DataFrame, key: str, marked: DataFrame) -> DataFrame:
    """The bytes of all windows of every mark: from ``high`` before its place to 400 past the start of the last."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, key long, place int, lead long, salt int, split boolean, before int, bytes binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 50):
                some = batch.slice(lo, 50)
                rows, pieces, before, marks = [], [], [], []
                for r, (raw, own) in enumerate(zip(some.column(2).to_pylist(), some.column(3).to_pylist())):
                    for m in own:
                        start = max(0, m["place"] - m["high"])
                        rows.append(r)
                        before.append(m["place"] - start)
                        pieces.append(raw[start:m["place"] - m["low"] + LENGTH])
                        marks.append(m)
                take = pa.array(rows, pa.int64())
                field = {n: pa.array([m[n] for m in marks], t) for n, t in
                         (("place", pa.int32()), ("lead", pa.int64()), ("salt", pa.int32()), ("split", pa.bool_()))}
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(take), some.column(1).take(take), *field.values(),
                     pa.array(before, pa.int32()), pa.array(pieces, pa.binary())],
                    names=["doc_id", "key", *field, "before", "bytes"])

    return with_marks(docs, key, marked).mapInArrow(run, schema)


def context_digests(data: np.ndarray, ends: np.ndarray, n: np.ndarray, inner: np.ndarray, powers: Powers) -> np.ndarray:
    """Hashes of the windows of contexts that lie one after another, some contexts at a time.

    ``ends``: where contexts begin and end, ``n``: windows a context, ``inner``: place of each window in its context.
    """
    out = np.empty(len(inner), dtype=np.uint64)
    upto = np.r_[0, np.cumsum(n)]
    for lo in range(0, len(n), HASHED_AT_ONCE):
        hi = min(lo + HASHED_AT_ONCE, len(n))
        here = slice(int(upto[lo]), int(upto[hi]))
        begin = np.repeat(ends[lo:hi] - ends[lo], n[lo:hi])
        out[here] = window_hashes(data[ends[lo]:ends[hi]], LENGTH, powers)[begin + inner[here]]
    return out


def compare_runs(table: pa.Table, powers: Powers) -> pa.Table:
    """Whole runs of suffixes with equal lead (and salt): per suffix the span of its windows found
    twice in its run, and for split runs one row per distinct window to compare across their pieces."""
    col = {n: table.column(n).combine_chunks() for n in table.column_names}
    place = col["place"].to_numpy().astype(np.int64)
    before = col["before"].to_numpy().astype(np.int64)
    lead = col["lead"].to_numpy().view(np.uint64)
    split = col["split"].to_numpy(zero_copy_only=False)
    ends = _ends(col["bytes"])
    data = np.frombuffer(col["bytes"].buffers()[2], dtype=np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    n = np.maximum(np.diff(ends) - LENGTH + 1, 0)               # windows per suffix
    owner = np.repeat(np.arange(len(n), dtype=np.int32), n)
    inner = (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)).astype(np.int32)
    digest = context_digests(data, ends, n, inner, powers)
    rel = inner - before[owner]
    name = mix(digest + rel.astype(np.uint64) * _P + mix(lead)[owner])
    order = np.argsort(name)
    line = name[order]
    equal = line[1:] == line[:-1]
    head = np.r_[True, ~equal] if len(line) else np.zeros(0, dtype=bool)
    twice = np.zeros(len(name), dtype=bool)
    twice[order] = (np.r_[False, equal] | np.r_[equal, False]) if len(line) else twice
    hit = np.flatnonzero(twice)
    who, first = np.unique(owner[hit], return_index=True)
    last = np.r_[first[1:], len(hit)][:len(who)] - 1
    probe = np.sort(order[head])
    probe = probe[split[owner[probe]]]
    k, m = len(who), len(probe)
    none = np.arange(k + m) < k

    def half(x, dtype):
        return pa.array(np.r_[np.zeros(k, dtype=dtype), x.astype(dtype)], mask=none)

    def start_at(window):
        return place[owner[window]] + rel[window]

    take = pa.array(np.r_[who, owner[probe]].astype(np.int64))
    # windows of one suffix start within 200 bytes, so what repeats of them is one run
    return pa.table({
        "doc_id": col["doc_id"].take(take), "key": col["key"].take(take),
        "start": np.r_[start_at(hit[first]), start_at(probe)].astype(np.int32),
        "stop": np.r_[start_at(hit[last]) + LENGTH, start_at(probe) + LENGTH].astype(np.int32),
        "lead": half(lead[owner[probe]].view(np.int64), np.int64), "rel": half(rel[probe], np.int32),
        "digest": half(digest[probe].view(np.int64), np.int64), "many": half(1 + twice[probe], np.int32)})


def _ends(binary: pa.Array) -> np.ndarray:
    """Value offsets of a binary array."""
    return np.frombuffer(binary.buffers()[1], dtype=np.int32)[binary.offset:binary.offset + len(binary) + 1].astype(np.int64)


def repeated_spans(docs: DataFrame, key: str) -> DataFrame:
    """(doc_id, key, spans): byte runs of each document covered by repeated 400-byte strings."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    sampled = materialize(sampled_suffixes(docs, key), "suffixes")
    suffixes = sampled.where("lead is not null").drop("stop")
    runs = materialize(suffixes.groupBy("lead").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "runs")
    plain = (suffixes.join(runs.where(F.col("n") <= CROWD), "lead")
             .select("doc_id", "key", "place", F.lit(0).alias("low"), F.lit(LENGTH - LEAD).alias("high"), "lead",
                     F.lit(1).alias("pieces")))
    finer = materialize(refined(docs, key, suffixes.join(runs.where(F.col("n") > CROWD), "lead")), "finer")
    again = (finer.groupBy("lead").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .select("lead", F.ceil(F.col("n") / CROWD).cast("int").alias("pieces")))
    salt = F.pmod(F.xxhash64("doc_id", "key", "place"), F.col("pieces")).cast("int")
    mark = F.struct("place", "low", "high", "lead", salt.alias("salt"), (F.col("pieces") > 1).alias("split"))
    marked = materialize(plain.unionByName(finer.join(again, "lead")).groupBy("doc_id", "key")
                         .agg(F.collect_set(mark).alias("marks")), "marks")
    contexts = suffix_contexts(docs, key, marked)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = contexts.repartitionByRange(parts, "lead", "salt").sortWithinPartitions("lead", "salt")
    schema = f"doc_id {kind}, key long, start int, stop int, lead long, rel int, digest long, many int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, held, size, name = Powers(), [], 0, None
        for batch in batches:
            lead, salt = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            cut = np.flatnonzero((lead[1:] != lead[:-1]) | (salt[1:] != salt[:-1])) + 1
            edges = [0, *cut.tolist(), len(lead)] if len(lead) else [0]
            for lo, hi in zip(edges[:-1], edges[1:]):
                if size >= AT_ONCE and name != (lead[lo], salt[lo]):  # whole runs only
                    yield from compare_runs(pa.Table.from_batches(held), powers).to_batches()
                    held, size = [], 0
                    pa.default_memory_pool().release_unused()
                name = (lead[lo], salt[lo])
                held.append(batch.slice(lo, hi - lo))
                size += hi - lo
        if held:
            yield from compare_runs(pa.Table.from_batches(held), powers).to_batches()

    found = materialize(ranges.mapInArrow(run, schema), "windows")
    probes = found.where("lead is not null")
    shared = probes.groupBy("lead", "rel", "digest").agg(F.sum("many").alias("m")).where("m > 1").drop("m")
    across = probes.where("many = 1").join(shared, ["lead", "rel", "digest"], "left_semi")
    periods = sampled.where("lead is null").select("doc_id", "key", F.col("place").alias("start"), "stop")
    return (found.where("lead is null").select("doc_id", "key", "start", "stop")
            .unionByName(across.select("doc_id", "key", "start", "stop")).unionByName(periods)
            .groupBy("doc_id", "key").agg(F.collect_set(F.struct("start", "stop")).alias("spans")))


def merge_spans(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s in sorted((x["start"], x["stop"]) for x in spans or ()):
        if out and s[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s[1])
        else:
            out.append(list(s))
    return [tuple(x) for x in out]


def cut_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, kept (remaining bytes), n_bytes, n_removed, n_spans of every row."""
    (key,) = fresh(docs, "key")
    keyed = row_key(docs.select("doc_id", "text"), key)
    spans = materialize(repeated_spans(keyed, key), "spans")
    gone = spans.select(F.col("doc_id").alias("__d"), F.col("key").alias("__k"), "spans")
    test = marked_keys(spans.select("key"), docs.sparkSession)
    some, others = keyed.where(test(F.col(key))), keyed.where(~test(F.col(key)))
    raw = body().cast("binary")
    joined = (some.join(gone, null_safe(some, gone, [("doc_id", "__d"), (key, "__k")]), "left")
              .select("doc_id", raw.alias("raw"), "spans"))
    none = F.lit(0).cast("long")  # rows that certainly hold no repeat stay as they are
    whole = others.select("doc_id", raw.alias("kept"), F.octet_length(raw).cast("long").alias("n_bytes"),
                          none.alias("n_removed"), none.alias("n_spans"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (many.slice(lo, 200) for many in batches for lo in range(0, many.num_rows, 200)):
            kept, size, removed, count = [], [], [], []
            for raw, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                cuts = merge_spans(spans)
                at, pieces = 0, []
                for a, b in cuts:
                    pieces.append(raw[at:a])
                    at = b
                pieces.append(raw[at:])
                kept.append(b"".join(pieces) if cuts else raw)
                size.append(len(raw))
                removed.append(sum(b - a for a, b in cuts))
                count.append(len(cuts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.binary()), *[pa.array(x, pa.int64()) for x in (size, removed, count)]],
                names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return joined.mapInArrow(run, f"doc_id {kind}, kept binary, n_bytes long, n_removed long, n_spans long").unionByName(whole)
