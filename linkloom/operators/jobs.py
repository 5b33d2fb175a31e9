"""The three end-to-end batch jobs over stored tables.

* ``store_links``: pages -> links -> first sighting -> column map/defaults ->
  insert-if-absent into the link table (appends new files).
* ``classify_table``: label rows of the link table by the rules (only
  unlabelled rows by default), write the result as a new table version, and
  export the sorted (url, category) CSV.
* ``relabel_table``: ask the labeller about the residue and write a new
  table version with the answers.

Tables are Parquet folders; a rewrite goes to a new folder because a path
cannot be overwritten while it is being read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from ..sources.config import Settings
from ..sources.export import export_categories
from ..sources.tables import read_link_table
from .classify import classify_links
from .extract import run_links
from .keyed import append_links, carry_marks
from .relabel import Complete, apply_labels, label_residue, relabel_pass


def store_links(pages: DataFrame, table_path: str, root_domain: str,
                settings: Settings | None = None, run_ts: Column | None = None) -> DataFrame:
    """Append the new links of ``pages`` to the link table; returns the table."""
    s = settings or Settings()
    append_links(run_links(pages, root_domain), table_path, s, run_ts)
    return read_link_table(pages.sparkSession, table_path, s.column_map)


def classify_table(spark: SparkSession, table_path: str, out_path: str, csv_path: str | None,
                   settings: Settings, partition_by_category: bool = False) -> DataFrame:
    """Label the link table by the rules into a new table version (and CSV).

    ``partition_by_category`` lays the new version out by ``pred_category``
    (the counterpart of an index on it): reads that filter on the category
    only open the matching folders, and later appends keep the layout.
    """
    links = read_link_table(spark, table_path, settings.column_map)
    labelled = classify_links(links, settings.rules, url_col=settings.url_col,
                              only_nulls=settings.only_update_nulls)
    if partition_by_category:
        # one writer task per category folder would funnel a big category
        # through one task; cluster by (category, key) so files stay balanced
        labelled.repartitionByRange("pred_category", settings.unique_key) \
            .write.mode("errorifexists").partitionBy("pred_category").parquet(out_path)
    else:
        labelled.write.mode("errorifexists").parquet(out_path)
    carry_marks(spark, table_path, out_path)
    result = read_link_table(spark, out_path, settings.column_map)
    if csv_path:
        export_categories(result, csv_path, url_col=settings.url_col)
    return result


def relabel_table(spark: SparkSession, table_path: str, out_path: str, complete: Complete,
                  settings: Settings, cursor_path: str | None = None, **kw) -> DataFrame:
    """Relabel the residue of the link table into a new table version.

    With ``cursor_path``, a pass capped by the settings' ``max_batches`` goes on
    from where the last one ended and adds a row to ``<cursor_path>-report``
    (rows covered, prompts asked, rows left unasked).
    """
    links = read_link_table(spark, table_path, settings.column_map)
    options = dict(taxonomy=settings.taxonomy, batch_size=settings.batch_size, max_batches=settings.max_batches,
                   where=_extra_where(settings.where_other_sql), **kw)
    if cursor_path:
        labels, report = relabel_pass(links, complete, cursor_path, **options)
        report.coalesce(1).write.mode("append").parquet(f"{cursor_path}-report")
    else:
        labels = label_residue(links, complete, **options)
    apply_labels(links, labels).write.mode("errorifexists").parquet(out_path)
    carry_marks(spark, table_path, out_path)
    return read_link_table(spark, out_path, settings.column_map)


def _extra_where(sql: str) -> str | None:
    """A configured predicate is the selection (F5); an empty one, or the default
    written out, means the default residue filter (which Parquet can push down)."""
    norm = " ".join(sql.split()).lower()
    return None if norm in ("", "coalesce(pred_category, 'other') = 'other'") else sql

