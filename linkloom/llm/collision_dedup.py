"""Near-duplicate vectors by collision counting over sorted one-dimensional projections.

Vectors of one label are sorted along a first projection and cut into blocks
of bounded size.  Every pair of blocks whose ranges could hold a linked pair
meets in one task, which sorts many further projections, counts for every
query in how many query-centred windows the other vector lies, and verifies
by cosine in double precision the pairs whose count passes a threshold that
a linked pair reaches with probability ``recall``.  A task returns link
counts and a spanning forest, never pairs.

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component, and vectors with a null label, link with nothing;
equal vectors are one class with a multiplicity (each copy counts as a
link); vectors of different length never link; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import connected_components, materialize, null_safe, prefix_sum

BLOCK = 2048


def calibrated(projections: int, inside: float, recall: float) -> int:
    """Largest count that Binomial(projections, inside) reaches with probability ``recall``."""
    total = 0.0
    for count in range(projections, -1, -1):
        total += math.comb(projections, count) * inside ** count * (1 - inside) ** (projections - count)
        if total >= recall:
            return count
    return 0


def directions(dim: int, count: int, seed: int = 7) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((count, dim))


def collision_counts(a: np.ndarray, b: np.ndarray, width: float) -> np.ndarray:
    """counts[i, j]: projections (columns) in which b[j] lies in the window around a[i]."""
    counts = np.zeros((len(a), len(b)), dtype=np.uint8)
    for t in range(a.shape[1]):
        order = np.argsort(b[:, t], kind="stable")
        line = b[order, t]
        lo = np.searchsorted(line, a[:, t] - width, side="left")
        hi = np.searchsorted(line, a[:, t] + width, side="right")
        for i in range(len(a)):
            counts[i, order[lo[i]:hi[i]]] += 1
    return counts


def linked_pairs(x: np.ndarray, y: np.ndarray, threshold: float, projections: int, recall: float,
                 spread: float = 2.0) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) with cosine(x[i], y[j]) >= threshold among the counted candidates."""
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    axes = directions(x.shape[1], projections).T
    radius = math.sqrt(2 - 2 * threshold)
    need = calibrated(projections, math.erf(spread / math.sqrt(2)), recall)
    counts = collision_counts((x / nx[:, None]) @ axes, (y / ny[:, None]) @ axes, spread * radius)
    i, j = np.nonzero(counts >= need)
    keep = np.zeros(len(i), dtype=bool)
    for lo in range(0, len(i), 100_000):
        p, q = i[lo:lo + 100_000], j[lo:lo + 100_000]
        keep[lo:lo + 100_000] = np.einsum("ij,ij->i", x[p], y[q]) / (nx[p] * ny[q]) >= threshold
    return i[keep], j[keep]


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    root = np.arange(n)

    def find(u: int) -> int:
        while root[u] != u:
            root[u] = root[root[u]]
            u = root[u]
        return u

    for a, b in zip(i.tolist(), j.tolist()):
        ra, rb = find(a), find(b)
        if ra != rb:
            root[max(ra, rb)] = min(ra, rb)
    return np.array([find(u) for u in range(n)])


def near_duplicate_vectors(vectors: DataFrame, threshold: float = 0.93, projections: int = 32,
                           recall: float = 0.9999) -> DataFrame:
    """Per row: vec_id, n_links, component_id (least vec_id reachable), kept."""
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vector"))
    sound = (F.col("label").isNotNull() & F.col("vector").isNotNull()
             & ~F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
             & F.exists("vector", lambda v: v != 0))
    classes = materialize(
        rows.where(F.coalesce(sound, F.lit(False))).groupBy("label", "vector")
        .agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("cid", F.monotonically_increasing_id()).withColumn("dim", F.size("vector")), "classes")
    dims = [r["dim"] for r in classes.select("dim").distinct().collect()]  # the lengths in use

    def project(batches):
        axes = {d: directions(d, 1, seed=3)[0] for d in dims}
        for batch in batches:
            value = []
            for v in batch.column(1).to_pylist():
                v = np.array(v)
                value.append(float(v @ axes[len(v)] / np.linalg.norm(v)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value, pa.float64())], names=["cid", "line"])

    at = classes.select("cid", "vector").mapInArrow(project, "cid long, line double")
    ranged = materialize(
        classes.join(at, "cid").repartitionByRange("label", "dim", "line", "cid")
        .withColumn("part", F.spark_partition_id()).withColumn("one", F.lit(1)), "sorted-vectors")
    placed = (prefix_sum(ranged, "part", ["label", "dim"], [F.col("line"), F.col("cid")], "one", "rank")
              .withColumn("block", F.floor(F.col("rank") / BLOCK).cast("long")))
    placed = materialize(placed.select("label", "dim", "block", "cid", "copies", "line", "vector"), "blocks")
    spans = placed.groupBy("label", "dim", "block").agg(F.min("line").alias("lo"), F.max("line").alias("hi"))
    gap = 4 * math.sqrt(2 - 2 * threshold)
    left = spans.select("label", "dim", F.col("block").alias("b1"), F.col("hi").alias("hi1"))
    right = spans.select("label", "dim", F.col("block").alias("b2"), F.col("lo").alias("lo2"))
    pairs = (left.join(right, ["label", "dim"]).where((F.col("b1") <= F.col("b2")) & (F.col("lo2") - F.col("hi1") <= gap))
             .select("label", "dim", "b1", "b2"))
    sides = (pairs.select("*", F.explode(F.array_distinct(F.array("b1", "b2"))).alias("block")))
    met = placed.join(sides, ["label", "dim", "block"])

    def compare(table: pa.Table) -> pa.Table:
        block = table.column("block").to_numpy()
        order = np.argsort(block, kind="stable")
        cid = table.column("cid").to_numpy()[order]
        copies = table.column("copies").to_numpy()[order]
        block = block[order]
        flat = table.column("vector").combine_chunks()
        x = flat.values.to_numpy(zero_copy_only=False)
        x = x[flat.offsets[0].as_py():flat.offsets[len(flat)].as_py()].reshape(len(flat), -1)[order]
        cut = int(np.searchsorted(block, block[-1], side="left")) if len(block) else 0
        if cut == 0:  # a block with itself
            i, j = linked_pairs(x, x, threshold, projections, recall)
            once = i < j
            i, j = i[once], j[once]
        else:
            i, j = linked_pairs(x[:cut], x[cut:], threshold, projections, recall)
            j = j + cut
        links = np.zeros(len(cid), dtype=np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        root = _forest(len(cid), i, j)
        some = links > 0
        return pa.table({"cid": cid[some], "links": links[some], "root": cid[root[some]]})

    found = materialize(met.groupBy("label", "dim", "b1", "b2").applyInArrow(compare, "cid long, links long, root long"),
                        "links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    named = (classes.select("label", "vector", "cid", "least_id", "copies")
             .join(links, "cid", "left").join(parts.withColumnRenamed("node", "cid"), "cid", "left")
             .withColumn("component", F.coalesce("component", "cid")))
    smallest = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = (named.join(smallest, "component")
             .select(F.col("label").alias("label_"), F.col("vector").alias("vector_"), "component_id",
                     (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links_")))
    out = rows.join(named, null_safe(rows, named, [("label", "label_"), ("vector", "vector_")]), "left")
    return out.select("vec_id", F.coalesce("n_links_", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component_id", "vec_id").alias("component_id"),
                      (F.col("vec_id") == F.coalesce("component_id", "vec_id")).alias("kept"))
