"""Minimum-cost-flow resharding: fewest bytes moved from old shards to new capacities.

The flow network has one node per old and per new shard, so the solver on
the driver sees shard sizes only (its input is bounded by the two shard
counts, never by the rows).  Its result is a table of block transfers; rows
take their shard from where they lie on their old shard's byte line.  The
files of shards that gain or lose rows are rewritten with the documents in
them; a shard that ends empty loses its folder.

Defined results: null text counts as empty (size 1); repeated rows are rows
of their own; an empty table gives an empty result; equal texts are not tied
together (a group may outgrow a shard); all columns of the documents are
kept as they are, in one column ``doc``.
"""

from __future__ import annotations

from collections import deque

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import body, materialize, prefix_sum, utf8_bytes
from linkloom.session import path_exists


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Flow[i][j] of least total cost that ships every supply within the capacities.

    Successive shortest augmenting paths (label-correcting, so that reverse
    arcs with negative cost are fine).
    """
    if sum(supply) > sum(capacity):
        raise ValueError("capacities are smaller than what is stored")
    n_old, n_new = len(supply), len(capacity)
    source, sink, total = n_old + n_new, n_old + n_new + 1, n_old + n_new + 2
    left = np.zeros((total, total), dtype=object)
    price = np.zeros((total, total), dtype=object)
    for i, s in enumerate(supply):
        left[source, i] = int(s)
        for j in range(n_new):
            left[i, n_old + j] = int(s)
            price[i, n_old + j], price[n_old + j, i] = cost[i][j], -cost[i][j]
    for j, c in enumerate(capacity):
        left[n_old + j, sink] = int(c)
    while True:
        distance, via = [None] * total, [None] * total
        distance[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for v in range(total):
                if left[u, v] > 0:
                    d = distance[u] + price[u, v]
                    if distance[v] is None or d < distance[v]:
                        distance[v], via[v] = d, u
                        queue.append(v)
        if distance[sink] is None:
            break
        path, v = [], sink
        while v != source:
            path.append((via[v], v))
            v = via[v]
        amount = min(left[u, v] for u, v in path)
        for u, v in path:
            left[u, v] -= amount
            left[v, u] += amount
    return [[int(left[n_old + j, i]) for j in range(n_new)] for i in range(n_old)]


def plan_transfers(sizes: list[int], capacity: list[int]) -> list[list[int]]:
    """Bytes from old shard i to new shard j; a shard keeping its number moves nothing."""
    cost = [[0 if i == j else 1 for j in range(len(capacity))] for i in range(len(sizes))]
    return min_cost_flow(sizes, capacity, cost)


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def _by_cuts(lines: dict[int, list[tuple[int, float]]], old: str, at: Column) -> Column:
    """Shard of a row from its place ``at`` on its old shard's line of (shard, end) blocks."""
    out = None
    for i, blocks in lines.items():
        pick = F.lit(blocks[-1][0])
        for shard, end in reversed(blocks[:-1]):
            pick = F.when(at < F.lit(float(end)), F.lit(shard)).otherwise(pick)
        cond = F.col(old) == F.lit(i)
        out = F.when(cond, pick) if out is None else out.when(cond, pick)
    return out if out is not None else F.lit(None).cast("int")


def _blocks(share: list[tuple[int, float]]) -> list[tuple[int, float]]:
    end, out = 0.0, []
    for shard, width in share:
        end += width
        out.append((shard, end))
    return out


def reshard(docs: DataFrame, old_shard: Column, old_shards: int, shards: int = 16,
            keep: list[str] | None = None) -> DataFrame:
    """Rows (doc_id, size, text_crc32, old_shard, shard, slot, doc) with near-equal bytes per shard.

    ``doc`` holds the columns ``keep`` of the documents (all where not given).

    Sizes per old shard feed the flow; each old shard's line of bytes is cut
    into the planned blocks.  Long rows are laid first, in proportion; the
    short ones then fill what is left of every block, so that a block misses
    its planned size by less than a short row where there are enough of them.
    """
    doc = F.struct(*[docs[f"`{c}`"] for c in keep or docs.columns]).alias("doc")
    stored = materialize(
        docs.select("doc_id", utf8_bytes(body()).alias("bytes"),
                    F.crc32(body().cast("binary")).alias("text_crc32"),
                    old_shard.cast("int").alias("old_shard"), doc)
        .select("doc_id", (F.col("bytes") + 1).alias("size"), "text_crc32", "old_shard", "doc",
                F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")),
        "shard-rows", compression="zstd")
    base = stored.drop("doc")
    bins = (base.groupBy("old_shard", F.floor(F.log2("size")).cast("int").alias("bits"))
            .agg(F.sum("size").alias("bytes")).collect())  # at most old_shards x 64 rows
    sizes = [0] * old_shards
    for r in bins:
        sizes[r["old_shard"]] += int(r["bytes"])
    total = sum(sizes)
    flow = plan_transfers(sizes, equal_capacities(total, shards))
    bits = 0
    while bits < 63 and sum(int(r["bytes"]) for r in bins if r["bits"] < bits) * 6 < total:
        bits += 1
    rows = base.withColumn("long_row", (F.col("size") >= F.lit(1 << bits)).cast("int"))
    rows = prefix_sum(rows, "part", ["old_shard", "long_row"], [F.col("place")], "size", "start")
    rows = rows.withColumn("middle", F.col("start") + F.col("size") / 2)
    long_bytes = [0] * old_shards
    for r in bins:
        if r["bits"] >= bits:
            long_bytes[r["old_shard"]] += int(r["bytes"])
    order = [[i, *[j for j in range(shards) if j != i]] if i < shards else list(range(shards))
             for i in range(old_shards)]
    long_lines = {i: _blocks([(j, flow[i][j] * long_bytes[i] / sizes[i]) for j in order[i] if flow[i][j]])
                  for i in range(old_shards) if sizes[i]}
    placed = materialize(
        rows.withColumn("shard", F.when(F.col("long_row") == 1, _by_cuts(long_lines, "old_shard", F.col("middle")))),
        "shard-long")
    done = {(r["old_shard"], r["shard"]): int(r["bytes"]) for r in
            placed.where("long_row = 1").groupBy("old_shard", "shard").agg(F.sum("size").alias("bytes")).collect()}
    short_lines = {}
    for i in range(old_shards):
        if sizes[i] > long_bytes[i]:
            share = [(j, max(0, flow[i][j] - done.get((i, j), 0))) for j in order[i] if flow[i][j]]
            scale = (sizes[i] - long_bytes[i]) / max(1, sum(w for _, w in share))
            short_lines[i] = _blocks([(j, w * scale) for j, w in share])
    placed = placed.withColumn("shard", F.coalesce("shard", _by_cuts(short_lines, "old_shard", F.col("middle"))).cast("int"))
    one = placed.withColumn("one", F.lit(1))
    slots = materialize(prefix_sum(one, "part", ["shard"], [F.col("place")], "one", "slot")
                        .select("place", "doc_id", "size", "text_crc32", "old_shard", "shard", "slot"), "shard-slots")
    return slots.join(stored.select("place", "doc"), "place").drop("place")


def rewrite_affected(rows: DataFrame, path: str) -> list[int]:
    """Write the files of every shard that gains or loses a row or has no folder, partitioned by shard.

    ``rows`` is what reshard() returns, made from other files than those at
    ``path`` or from its scratch copy of them.  A shard whose rows all stay is
    left alone; one that ends empty loses its folder, after the write.
    Returns the affected shard numbers.
    """
    spark = rows.sparkSession
    flows = [(r["old_shard"], r["shard"]) for r in rows.select("old_shard", "shard").distinct().collect()]  # old x new at most
    filled = {new for _, new in flows}
    affected = ({n for flow in flows if flow[0] != flow[1] for n in flow}
                | {n for n in filled if not path_exists(spark, f"{path}/shard={n}")})
    (rows.where(F.col("shard").isin(sorted(affected & filled)))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", "zstd").partitionBy("shard").parquet(path))
    for n in sorted(affected - filled):
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/shard={n}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return sorted(affected)


def read_shards(rows: DataFrame, path: str) -> DataFrame:
    """The rows of the files at ``path``, of the schema of ``rows``."""
    return rows.sparkSession.read.schema(rows.schema).parquet(path).select(*rows.columns)
