"""Content hash (H1), change check between two crawls and history over many (H2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def content_hash(html: Column) -> Column:
    """SHA-256 hex of the UTF-8 HTML; NULL counts as ''."""
    return F.sha2(F.coalesce(html, F.lit("")), 256)


def page_changes(old: DataFrame, new: DataFrame, key: str = "url",
                 hash_col: str = "content_hash") -> DataFrame:
    """Compare two crawls by key: ``new``, ``changed``, ``same`` or ``gone`` per key.

    Only the key and hash columns are shuffled, one row per key and side (a
    repeated key counts with its greatest hash); NULL keys never match, a NULL
    hash is a stored value.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        return (df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("k"))
                .agg(F.max(hash_col).alias(f"{name}_hash"), F.lit(True).alias(f"in_{name}")))

    j = side(old, "old").join(side(new, "new"), "k", "full_outer")
    status = (F.when(F.col("in_old").isNull(), F.lit("new"))
              .when(F.col("in_new").isNull(), F.lit("gone"))
              .when(F.col("old_hash").eqNullSafe(F.col("new_hash")), F.lit("same"))
              .otherwise(F.lit("changed")))
    return j.select(F.col("k").alias(key), "old_hash", "new_hash", status.alias("change"))


def page_history(sightings: DataFrame, key: str = "url", crawl_col: str = "crawl",
                 hash_col: str = "content_hash") -> DataFrame:
    """How each page's content went over many crawls: one row per unbroken run of one hash.

    ``sightings`` has one row per page and crawl that found it (a repeated one
    counts with its greatest hash).  A run ends when the page comes back with
    another hash; a crawl that missed the page does not end it.  Columns:
    ``key, version`` (1, 2, ... per page), ``content_hash, first_seen,
    last_seen, n_seen, replaced_in`` (the crawl that brought the next version,
    NULL for the last).  NULL keys are left out; a NULL hash is a content.

    Only key, crawl and hash are shuffled, once; a page's rows, one per crawl,
    are read in order by one task.
    """
    rows = (sightings.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("k"), F.col(crawl_col).alias("c"))
            .agg(F.max(hash_col).alias("h")).repartition("k"))
    by_crawl = Window.partitionBy("k").orderBy("c")
    before = F.lag("h").over(by_crawl)
    starts = rows.withColumn("new", (F.row_number().over(by_crawl) == 1) | ~F.col("h").eqNullSafe(before))
    runs = starts.withColumn("version", F.sum(F.col("new").cast("int")).over(by_crawl).cast("int"))
    spans = runs.groupBy("k", "version").agg(F.first("h").alias("h"), F.min("c").alias("first_seen"), F.max("c").alias("last_seen"),
                                             F.count(F.lit(1)).alias("n_seen"))
    return spans.select(F.col("k").alias(key), "version", F.col("h").alias("content_hash"), "first_seen", "last_seen", "n_seen",
                        F.lead("first_seen").over(Window.partitionBy("k").orderBy("version")).alias("replaced_in"))
