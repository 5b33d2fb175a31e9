"""Dense row numbers in a global order without a single-partition window.

``row_number() OVER (ORDER BY k)`` with no partition moves every row into one
task.  Instead the order columns alone are range-partitioned and sorted, their
lineage is cut with a reliable checkpoint so that partition contents are
fixed, the rows of each range are counted, and a row's number is its range's
offset plus its place there.  Rows with other columns meet their numbers in
one equi-join on the order columns; they are never sorted or checkpointed
themselves.  The offsets table has one row per partition, so broadcasting it
is bounded by the partition count.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint


def rank_keys(keys: DataFrame, order_cols: Sequence[str], out: str = "rn", start: int = 1,
              num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """``keys`` with ``out`` = ``start`` + 0-based position in ``order_cols`` order, and how many rows there are."""
    spark = keys.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c).asc_nulls_last() for c in order_cols]
    ordered = keys.repartitionByRange(n, *order).sortWithinPartitions(*order)
    tagged = reliable_checkpoint(ordered.withColumn("__pid", F.spark_partition_id())
                                 .withColumn("__mid", F.monotonically_increasing_id()))
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n")).collect()  # at most n rows
    offsets, acc = [], 0
    for r in sorted(counts, key=lambda r: r["__pid"]):
        offsets.append((r["__pid"], acc))
        acc += r["__n"]
    off_df = spark.createDataFrame(offsets or [(0, 0)], "__pid int, __off long")
    # position within the partition: monotonically_increasing_id is
    # (partition id << 33) + row index in that partition
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)
    return (tagged.join(F.broadcast(off_df), "__pid")
            .withColumn(out, F.col("__off") + local + F.lit(start))
            .drop("__pid", "__mid", "__off")), acc


def dense_rank_rows(df: DataFrame, order_cols: Sequence[str], out: str = "rn",
                    start: int = 1, num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = ``start`` + 0-based position of the row in ``order_cols`` order.

    ``order_cols`` must give a total order (unique): the numbers come back to
    the rows by these columns.
    """
    if set(df.columns) == set(order_cols):
        return rank_keys(df, order_cols, out, start, num_partitions)[0]
    names = [f"__order_{i}" for i in range(len(order_cols))]
    ranked, _ = rank_keys(df.select(*[F.col(c).alias(n) for c, n in zip(order_cols, names)]), names, out, start, num_partitions)
    same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(ranked[n]) for c, n in zip(order_cols, names)])
    return df.join(ranked, same).drop(*names)
