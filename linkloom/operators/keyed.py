"""Keyed writes on plain tables.

Spark does not enforce keys, so the writers do:

* ``insert_if_absent`` (K4/J1): first row per key inside the batch, then a
  left-anti join against the stored keys, then dense new ids.  Applying it
  twice adds nothing.
* ``append_links`` is that as a table operation: the table's key filter
  spares certainly new keys the anti join, ids continue from a stored mark,
  and rows are written in the table's own layout.
* ``upsert_pages`` (K5/J2): last row per url inside the batch, then a merge
  by url (a left join of the stored rows with the batch, plus an anti join on
  the url column for new rows): matched rows take the batch's seven columns
  and keep ``id`` and ``meta_description``; new rows get new ids; untouched
  rows stay.  ``pagetable.upsert_page_table`` is the table operation.

The functions on DataFrames return DataFrames; ``write_snapshot`` and
``upsert_snapshot`` write a result as a new table version and
``latest_snapshot`` finds the newest complete one.  Joins are plain
equi-joins: AQE turns them into broadcast joins at run time when one side
turns out small, and keeps the shuffle join otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import content_hash
from ..session import list_names, path_exists, scratch_path
from ..sources.tables import apply_column_map, ensure_column, read_link_table, write_link_rows
from .dedupe import first_wins
from .ids import dense_rank_rows, rank_keys
from .keyfilter import add_to_filter, filter_blocks, read_filter, split_by_filter

def next_id_base(target: DataFrame | None, id_col: str = "id") -> int:
    """The largest stored id (0 for no table): one scalar to the driver."""
    if target is None:
        return 0
    m = target.agg(F.max(id_col)).collect()[0][0]
    return int(m or 0)


def insert_if_absent(batch: DataFrame, target: DataFrame | None, key: str,
                     order_cols: list[str], id_col: str | None = "id") -> DataFrame:
    """Rows of ``batch`` to append: first per key, key not yet stored, with new ids.

    NULL keys are never conflicts (as with a UNIQUE column) and all pass.
    """
    fresh = first_wins(batch, key, order_cols, keep_null_keys=True)
    if target is not None:
        fresh = fresh.join(target.select(key).where(F.col(key).isNotNull()), key, "left_anti")
    if id_col is None:
        return fresh
    base = next_id_base(target, id_col)
    return dense_rank_rows(fresh, order_cols, out=id_col, start=base + 1)


def stored_mark(spark: SparkSession, table_path: str, target: DataFrame | None) -> int:
    """The largest id given out for a table: its stored mark, or the largest stored id of a table without one."""
    marks = f"{table_path.rstrip('/')}/_ids"
    if path_exists(spark, f"{marks}/_SUCCESS"):
        return int(spark.read.schema("high long").parquet(marks).agg(F.max("high")).first()[0] or 0)
    return next_id_base(target)


def reserve_ids(spark: SparkSession, table_path: str, n: int, target: DataFrame | None) -> int:
    """Reserve ``n`` ids after the table's mark and return the one before the first.

    The mark is written before the rows, so ids are never given out twice; a
    write that fails in between leaves a gap, as a sequence does.
    """
    base = stored_mark(spark, table_path, target)
    _write_mark(spark, table_path, base + n)
    return base


def _write_mark(spark: SparkSession, table_path: str, high: int) -> None:
    spark.createDataFrame([(high,)], "high long").coalesce(1).write.mode("append").parquet(f"{table_path.rstrip('/')}/_ids")


def carry_marks(spark: SparkSession, table_path: str, out_path: str) -> None:
    """Give a new version of a table the old one's id mark and key filter (its keys are the same)."""
    if path_exists(spark, f"{table_path.rstrip('/')}/_ids/_SUCCESS"):
        _write_mark(spark, out_path, stored_mark(spark, table_path, None))
    blocks = filter_blocks(spark, table_path)
    if blocks:
        read_filter(spark, table_path, blocks).write.mode("append").parquet(f"{out_path.rstrip('/')}/_keys/blocks={blocks}")


def absent_places(places: DataFrame, target: DataFrame, key: str, table_path: str) -> DataFrame:
    """Rows of ``places`` (key and order columns) whose key is not stored; only keys the filter cannot rule out are compared."""
    stored = target.select(key).where(F.col(key).isNotNull())
    parts = split_by_filter(places, key, table_path)
    if parts is None:
        return places.join(stored, key, "left_anti")
    certain, open_ = parts
    return certain.unionByName(open_.join(stored, key, "left_anti"))


def add_link_rows(rows: DataFrame, places: DataFrame, target: DataFrame | None, table_path: str, settings) -> None:
    """Write those of ``rows`` that ``places`` names, with the next ids in (page_id, pos) order."""
    spark = rows.sparkSession
    key = settings.unique_key
    ranked, n = rank_keys(places.select("page_id", "pos", key), ["page_id", "pos"], out="__rank")
    if not n and target is not None:
        return
    base = reserve_ids(spark, table_path, n, target)
    add_to_filter(ranked, target, key, table_path, base + n)
    at = ranked.select(F.col("page_id").alias("__page"), F.col("pos").alias("__pos"), F.col(key).alias("__key"), "__rank")
    same = (rows["page_id"].eqNullSafe(at["__page"]) & rows["pos"].eqNullSafe(at["__pos"]) & rows[key].eqNullSafe(at["__key"]))
    new = rows.join(at, same).withColumn("id", F.col("__rank") + F.lit(base))
    write_link_rows(ensure_column(new, "pred_category"), table_path, settings.column_map)


def stored_links(spark: SparkSession, table_path: str, settings) -> DataFrame | None:
    """The link table, or None before its first rows."""
    if not any(n[0] not in "._" for n in list_names(spark, table_path)):
        return None
    return read_link_table(spark, table_path, settings.column_map)


def append_links(links: DataFrame, table_path: str, settings, run_ts: Column | None = None) -> None:
    """Append new links to the link table.

    The table is read and written with its declared columns only (id, the
    mapped columns, ``pred_category``) and in its own layout, so its files
    never differ in schema, stored labels outlive later appends, and a table
    laid out by category stays one.  The batch's rows are kept as a scratch
    table, since they come from parsing pages; ids and the comparison with the
    stored keys use the key and order columns alone.
    """
    key = settings.unique_key
    target = stored_links(links.sparkSession, table_path, settings)
    mapped = apply_column_map(links, settings.column_map, run_ts=run_ts, keep=["page_id", "pos"])
    rows = staged(first_wins(mapped, key, ["page_id", "pos"], keep_null_keys=True), "new-links")
    places = rows.select("page_id", "pos", key)
    if target is not None:
        places = absent_places(places, target, key, table_path)
    add_link_rows(rows, places, target, table_path, settings)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a scratch table and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _with_new_ids(items: DataFrame, seq_col: str, start: int) -> DataFrame:
    """``items`` (one per url, or per ``seq_col`` where url is null) with dense ids in ``seq_col`` order.

    Only (url, seq) is range-sorted and checkpointed; the pages themselves
    meet their ids in one equi-join.
    """
    ids = dense_rank_rows(items.select(F.col("url").alias("__url"), F.col(seq_col).alias("__seq")),
                          ["__seq", "__url"], out="id", start=start)
    return items.join(ids, F.col("url").eqNullSafe(F.col("__url")) & F.col(seq_col).eqNullSafe(F.col("__seq"))) \
        .drop("__url", "__seq")


def upsert_pages(batch: DataFrame, target: DataFrame | None, seq_col: str,
                 run_ts: Column | None = None) -> DataFrame:
    """K5: merge page items into the page table by url, last item wins.

    ``batch`` has ``url, status_code, title, html_content, content_length,
    link_depth`` (``meta_description`` is ignored, as in the original) and an
    arrival order ``seq_col``.  NULL html is stored as '' and hashed.
    """
    ts = run_ts if run_ts is not None else F.current_timestamp()
    last = first_wins(batch, "url", [seq_col], keep_null_keys=True, descending=True)
    html = F.coalesce(F.col("html_content"), F.lit(""))
    items = last.select(
        "url", seq_col,
        F.col("status_code").cast("int").alias("status_code"), F.col("title"),
        html.alias("html_content"),
        F.col("content_length").cast("int").alias("content_length"),
        F.col("link_depth").cast("int").alias("link_depth"),
        ts.cast("timestamp").alias("fetched_at"),
        content_hash(F.col("html_content")).alias("content_hash"))
    cols = ["id", "url", "status_code", "title", "meta_description", "html_content",
            "content_length", "link_depth", "fetched_at", "content_hash"]
    if target is None:
        new = _with_new_ids(items, seq_col, 1)
        return new.withColumn("meta_description", F.lit(None).cast("string")).select(*cols)

    # stored rows: a left join, so the page table is shuffled once; batch
    # rows that match take the seven new values, the rest keep theirs
    t = target.alias("t")
    b = items.alias("b")
    hit = F.col("b.url").isNotNull()
    updated = t.join(b, F.col("t.url") == F.col("b.url"), "left").select(
        F.col("t.id").alias("id"), F.col("t.url").alias("url"),
        *[F.when(hit, F.col(f"b.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
          for c in ["status_code", "title"]],
        F.col("t.meta_description").alias("meta_description"),
        *[F.when(hit, F.col(f"b.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
          for c in ["html_content", "content_length", "link_depth", "fetched_at", "content_hash"]],
    )
    # new urls (and NULL urls, which never conflict): anti join on the url column only
    stored_urls = target.select("url").where(F.col("url").isNotNull())
    inserted = items.join(stored_urls, "url", "left_anti")
    base = next_id_base(target)
    new = _with_new_ids(inserted, seq_col, base + 1) \
        .withColumn("meta_description", F.lit(None).cast("string")).select(*cols)
    return updated.select(*cols).unionByName(new)


def write_snapshot(df: DataFrame, table_root: str, version: int, mode: str = "errorifexists") -> str:
    """Write ``df`` as version ``version`` of a table kept as ``<root>/v=<n>``.

    A version folder is complete once Spark's commit has written its
    ``_SUCCESS`` marker; readers only take complete versions."""
    path = f"{table_root.rstrip('/')}/v={version:08d}"
    df.write.mode(mode).parquet(path)
    return path


def latest_snapshot(spark, table_root: str) -> tuple[int, str] | None:
    """(version, path) of the newest complete version under ``table_root``."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(table_root)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    best = None
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v=") and name[2:].isdigit():
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                v = int(name[2:])
                if best is None or v > best[0]:
                    best = (v, st.getPath().toString())
    return best


def upsert_snapshot(spark, batch: DataFrame, table_root: str, seq_col: str,
                    run_ts: Column | None = None) -> str:
    """K5 as a table operation: merge ``batch`` into the newest version and
    write the result as the next version (one writer at a time)."""
    cur = latest_snapshot(spark, table_root)
    target = spark.read.parquet(cur[1]) if cur else None
    merged = upsert_pages(batch, target, seq_col, run_ts=run_ts)
    return write_snapshot(merged, table_root, (cur[0] + 1) if cur else 0)
