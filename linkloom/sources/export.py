"""Sorted CSV export of (url, category) with a header.

The sort is a range-partitioned global sort, so the part files, read in name
order, are in url order (NULLs last, as the original database sorts them).
Writing one file would funnel everything through one task; ``single_file``
does that only on request.  Quoting follows the database's CSV form: NULL is
nothing, '' is ``""``, a quote is doubled; white space is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "quote": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}


def export_categories(df: DataFrame, path: str, url_col: str = "url",
                      category_col: str = "pred_category", single_file: bool = False) -> str:
    out = (df.select(F.col(url_col).alias("url"), F.col(category_col).alias("pred_category"))
           # the later keys let the range partitioner split a hot url over several files
           .orderBy(F.col("url").asc_nulls_last(), F.col("pred_category").asc_nulls_last(),
                    F.monotonically_increasing_id()))
    if single_file:
        out = out.coalesce(1)
    out.write.mode("errorifexists").options(**CSV_OPTIONS).csv(path)
    return path


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """Read an export back: an unquoted empty field is NULL, ``""`` is ''.

    Spark compares every field with ``nullValue`` ('' by default), which would
    turn both into NULL; a sentinel that never occurs keeps them apart."""
    return (spark.read.options(**CSV_OPTIONS).option("nullValue", "\u0000")
            .option("multiLine", True)  # a url may hold a line break
            .schema("url string, pred_category string").csv(path))
