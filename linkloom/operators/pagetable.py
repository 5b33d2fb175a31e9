"""The stored page table: upsert by url that reads and rewrites only the buckets it touches.

Pages are laid out by a hash of their url in a fixed number of buckets, which
the layout column's name states (``bucket_of_64=17``).  An upsert

1. writes the batch once as a scratch table with row numbers (its HTML is read
   again from there, not recomputed),
2. picks the last row per url from (url, seq, row number) alone,
3. finds ids by joining those keys with (url, id, meta_description) of the
   touched buckets, and numbers new urls from the table's stored mark,
4. writes the touched buckets anew: stored rows whose url is not in the batch,
   and the batch's rows.

HTML is never sorted by a window.  The new buckets are written under
``_pending`` first and then put in place by dynamic partition overwrite; a
pending write that was complete before a crash is put in place by the next
upsert, an incomplete one is dropped.  One writer at a time; readers see the
old or the new rows of each bucket.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import content_hash
from ..schemas import PAGE_SCHEMA
from ..session import list_names, path_exists, remove_path
from ..sources.tables import partition_columns
from .ids import rank_keys
from .keyed import reserve_ids, staged

BUCKETS = 64
_TAKEN = ["status_code", "title", "html_content", "content_length", "link_depth", "fetched_at", "content_hash"]


def bucket_of(url: Column, else_by: Column, buckets: int) -> Column:
    """Bucket of a url; rows without a url, which never conflict, are spread by ``else_by``."""
    return F.pmod(F.xxhash64(url, F.when(url.isNull(), else_by)), F.lit(buckets)).cast("int")


def _with_bucket(column: str) -> T.StructType:
    return T.StructType([*PAGE_SCHEMA.fields, T.StructField(column, T.IntegerType())])


def _bucket_column(spark: SparkSession, path: str, buckets: int) -> str:
    layout = partition_columns(spark, path)
    return layout[0] if layout else f"bucket_of_{buckets}"


def write_page_table(pages: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Store ``pages`` (the page table's columns) as a new table of ``buckets`` buckets."""
    column = f"bucket_of_{buckets}"
    (pages.select(*PAGE_SCHEMA.names, bucket_of(F.col("url"), F.col("id"), buckets).alias(column))
     .hint("rebalance", column).write.mode("errorifexists").partitionBy(column).parquet(path))


def read_page_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGE_SCHEMA).parquet(path).select(*PAGE_SCHEMA.names)


def _put_in_place(spark: SparkSession, path: str, column: str) -> None:
    """Finish writes that were complete, drop those that were not."""
    for name in sorted(list_names(spark, f"{path}/_pending")):
        pending = f"{path}/_pending/{name}"
        if path_exists(spark, f"{pending}/_SUCCESS"):
            (spark.read.schema(_with_bucket(column)).parquet(pending).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path))
        remove_path(spark, pending)


def last_rows(rows: DataFrame, seq_col: str) -> DataFrame:
    """url, seq and row number of the last row per url; rows without a url all count."""
    keys = rows.select("url", F.col(seq_col).alias("seq"), "__row")
    last = (keys.where("url is not null").groupBy("url").agg(F.max(F.struct("seq", "__row")).alias("w"))
            .select("url", "w.seq", "w.__row"))
    return last.unionByName(keys.where("url is null"))


def upsert_page_table(batch: DataFrame, path: str, seq_col: str, run_ts: Column | None = None,
                      buckets: int = BUCKETS) -> DataFrame:
    """Merge page items into the table at ``path`` (made if there is none) and return it.

    ``batch`` as in :func:`~linkloom.operators.keyed.upsert_pages`: the last
    item per url by ``seq_col`` (row order on ties) wins; matched rows take its
    seven values and keep ``id`` and ``meta_description``; NULL html is ''.
    """
    spark = batch.sparkSession
    path = path.rstrip("/")
    column = _bucket_column(spark, path, buckets)
    n = int(column.rpartition("_")[2])
    _put_in_place(spark, path, column)
    ts = run_ts if run_ts is not None else F.current_timestamp()
    rows = staged(batch.select(
        "url", seq_col, F.col("status_code").cast("int").alias("status_code"), F.col("title").cast("string").alias("title"),
        F.coalesce(F.col("html_content"), F.lit("")).alias("html_content"),
        F.col("content_length").cast("int").alias("content_length"), F.col("link_depth").cast("int").alias("link_depth"),
        ts.cast("timestamp").alias("fetched_at"), content_hash(F.col("html_content")).alias("content_hash"),
        F.monotonically_increasing_id().alias("__row")), "page-items")
    last = last_rows(rows, seq_col).withColumn(column, bucket_of(F.col("url"), F.col("__row"), n))
    touched = [r[0] for r in last.select(column).distinct().collect()]  # at most the number of buckets
    if not touched:
        return read_page_table(spark, path)
    exists = bool(partition_columns(spark, path))
    table = (spark.read.schema(_with_bucket(column)).parquet(path) if exists
             else spark.createDataFrame([], _with_bucket(column)))
    stored = table.where(F.col(column).isin(touched))
    known = stored.where("url is not null").select(F.col("url").alias("__url"), "id", "meta_description")
    named = staged(last.join(known, last["url"] == known["__url"], "left").drop("__url"), "page-ids")
    new, n_new = rank_keys(named.where("id is null").select("seq", "url", "__row"), ["seq", "url", "__row"], out="__rank")
    base = reserve_ids(spark, path, n_new, table if exists else None) if n_new else 0
    ids = named.where("id is not null").select("__row", "id", "meta_description", column).unionByName(
        new.join(named.select("__row", "meta_description", column), "__row")
        .select("__row", (F.col("__rank") + base).alias("id"), "meta_description", column))
    columns = [*PAGE_SCHEMA.names, column]
    fresh = rows.join(ids, "__row").select(*columns)
    kept = stored.join(last.where("url is not null").select("url"), "url", "left_anti").select(*columns)
    (kept.unionByName(fresh).hint("rebalance", column).write.partitionBy(column)
     .parquet(f"{path}/_pending/{uuid.uuid4().hex}"))
    _put_in_place(spark, path, column)
    return read_page_table(spark, path)
