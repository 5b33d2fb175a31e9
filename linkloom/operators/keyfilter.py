"""A Bloom filter over a table's keys, kept beside it, that spares new keys the join with the stored ones.

The filter is blocked: a key's hash names one 64-bit word and four bits of it.
It is an ordinary table of (block, word), built and merged with ``bit_or``, so
it is read, joined and added to by Spark like any other table and no task or
driver holds it whole.  Blocks are grouped in slices; a batch reads the filter
once, about 2 bytes a stored key instead of the key itself.  A key whose bits
are not all set is certainly not stored; only the others meet the stored keys.

``<table>/_keys/blocks=<n>`` holds the words; every append adds those of its
own new keys.  Once a block would hold more than 16 keys on average, the next
append builds a larger filter from the stored keys (each key is read about
1.3 times for that over the table's life).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import list_names, path_exists

KEYS_PER_BLOCK = 4      # when a filter is built
FULL = 16               # keys a block, on average, from which a larger one is built
LEAST_BLOCKS = 1 << 14


def _place(key: str, blocks: int) -> list[Column]:
    h = F.xxhash64(F.lit(5), F.col(key))
    bits = F.xxhash64(F.lit(6), F.col(key))
    mask = F.lit(0).cast("long")
    for k in range(4):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"),
                                              F.shiftrightunsigned(bits, 6 * k).bitwiseAND(F.lit(63)).cast("int")))
    return [F.pmod(h, F.lit(blocks)).alias("block"), mask.alias("mask")]


def key_words(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, word) of the keys; null keys are left out."""
    return (keys.where(F.col(key).isNotNull()).select(*_place(key, blocks))
            .groupBy("block").agg(F.bit_or("mask").alias("word")))


def filter_blocks(spark: SparkSession, table_path: str) -> int:
    """Blocks of the newest filter of the table (0: none)."""
    root = f"{table_path.rstrip('/')}/_keys"
    if not path_exists(spark, root):
        return 0
    done = [n for n in list_names(spark, root) if n.startswith("blocks=") and path_exists(spark, f"{root}/{n}/_SUCCESS")]
    return max((int(n.removeprefix("blocks=")) for n in done), default=0)


def read_filter(spark: SparkSession, table_path: str, blocks: int) -> DataFrame:
    path = f"{table_path.rstrip('/')}/_keys/blocks={blocks}"
    return spark.read.schema("block long, word long").parquet(path).groupBy("block").agg(F.bit_or("word").alias("word"))


def add_to_filter(keys: DataFrame, stored: DataFrame | None, key: str, table_path: str, n_keys: int) -> None:
    """Add ``keys`` to the table's filter, or build one for ``n_keys`` keys over ``stored`` and ``keys``.

    Called before the rows are appended: a key in the filter that is not
    stored costs a comparison, a stored key missing from it would be a fault.
    """
    spark = keys.sparkSession
    blocks = filter_blocks(spark, table_path)
    if blocks and n_keys <= FULL * blocks:
        words = key_words(keys.select(key), key, blocks)
    else:
        blocks = max(LEAST_BLOCKS, 1 << max(0, -(-n_keys // KEYS_PER_BLOCK) - 1).bit_length())
        every = keys.select(key) if stored is None else keys.select(key).unionByName(stored.select(key))
        words = key_words(every, key, blocks)
    words.write.mode("append").parquet(f"{table_path.rstrip('/')}/_keys/blocks={blocks}")


def split_by_filter(rows: DataFrame, key: str, table_path: str) -> tuple[DataFrame, DataFrame] | None:
    """(rows whose key is certainly not stored, rows to compare), or None if the table has no filter."""
    spark = rows.sparkSession
    blocks = filter_blocks(spark, table_path)
    if not blocks:
        return None
    words = read_filter(spark, table_path, blocks).withColumnRenamed("block", "__block").withColumnRenamed("word", "__word")
    block, mask = _place(key, blocks)
    placed = rows.withColumn("__at", block).withColumn("__mask", mask)
    seen = placed.join(words, F.col("__at") == F.col("__block"), "left")
    maybe = F.col(key).isNotNull() & F.coalesce(F.col("__word").bitwiseAND(F.col("__mask")) == F.col("__mask"), F.lit(False))
    drop = ("__at", "__mask", "__block", "__word")
    return seen.where(~maybe).drop(*drop), seen.where(maybe).drop(*drop)
