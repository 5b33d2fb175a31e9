"""Helpers the operators of this package share: scratch tables, keys, prefix sums, components."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.session import scratch_path


BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20  # an Arrow batch is held several times over, by the executor and by its Python worker


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of about ``BATCH_BYTES`` at most in what runs inside; the session's own limit stands again after it."""
    own = spark.conf.get(BATCH_CONF)
    stated = own.strip().lower().removesuffix("b")
    if stated.isdigit() and int(stated) <= BATCH_BYTES:
        yield
        return
    spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, own)


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts the lineage so that a lost executor costs a re-read, not a
    recomputation, and pins values that depend on the physical layout.
    """
    path = scratch_path(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """One column name per wanted name, none of them taken in ``df`` (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        candidate = f"__{name}"
        while candidate.lower() in taken:
            candidate += "_"
        taken.add(candidate.lower())
        out.append(candidate)
    return out


def body(name: str = "text") -> Column:
    """The text with null read as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def utf8_bytes(col: Column) -> Column:
    return F.octet_length(col).cast("long")


def row_key(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a 64-bit content hash; (doc_id, hash) names a row.

    Rows equal in doc_id and text share the key and hence every decision.
    """
    return docs.withColumn(name, F.xxhash64(F.lit(11), body()))


def null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    cond = None
    for a, b in pairs:
        c = left[a].eqNullSafe(right[b])
        cond = c if cond is None else cond & c
    return cond


def prefix_sum(df: DataFrame, part: str, group: Sequence[str], order: Sequence[Column],
               value: str, out: str) -> DataFrame:
    """Exclusive running sum of ``value`` within ``group`` without gathering a group.

    Rows are summed inside (part, group), where ``part`` is the task that
    wrote the row, and shifted by the totals of earlier parts: the only
    ordered table per group has one row per part.
    """
    before = Window.partitionBy(part, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn(out, F.coalesce(F.sum(value).over(before), F.lit(0)).cast("long"))
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shift = (df.groupBy(part, *group).agg(F.sum(value).alias("__total"))
             .withColumn("__shift", F.coalesce(F.sum("__total").over(earlier), F.lit(0)).cast("long"))
             .drop("__total"))
    return (local.join(shift, [part, *group])
            .withColumn(out, F.col(out) + F.col("__shift")).drop("__shift"))


def connected_components(edges: DataFrame) -> DataFrame:
    """Columns (node, component) for undirected ``edges`` (a, b); component = least node reachable.

    Alternating large-star and small-star rounds; each round is a written
    table, and a hub's edges are never gathered (minimum by aggregation, then
    a join that adaptive execution can split).
    """
    stars = materialize(edges.where("a != b")
                        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                        "edges")
    seen = _signature(stars)
    while seen[0]:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
        stars = materialize(small.where("u != v")
                            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                            "stars")
        now = _signature(stars)
        if now == seen:
            break
        seen = now
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return int(row["n"]), int(row["x"] or 0)


class Shared:
    """An object of this package sent to the tasks as plain data, so that executors need no copy of it."""

    def __init__(self, spark, value: object):
        self.kind = type(value)
        self.state = spark.sparkContext.broadcast(None if value is None else dict(vars(value)))
        self.made = None

    def __getstate__(self):
        return {"kind": self.kind, "state": self.state, "made": None}

    @property
    def value(self):
        if self.made is None and self.state.value is not None:
            self.made = object.__new__(self.kind)
            self.made.__dict__.update(self.state.value)
        return self.made
