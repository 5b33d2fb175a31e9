"""Table-level helpers: column map (K3), link scan (K7), ensure column (K8),
column defaults (K9), and the layout a stored table is kept in (K4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT_COLUMN_MAP
from ..schemas import LINK_SCHEMA
from ..session import list_names

RELABEL_SCAN_COLUMNS = ["id", "url", "anchor_text", "rel", "is_external"]


def ensure_column(df: DataFrame, name: str, dtype: str = "string") -> DataFrame:
    """K8: add ``name`` as NULL when the table does not have it yet."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(dtype))


def apply_column_map(df: DataFrame, column_map: Sequence[tuple[str, str]] = DEFAULT_COLUMN_MAP,
                     run_ts: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """K3 + K9: project to the mapped output columns, in the map's order.

    A missing source field becomes NULL; ``discovered_at`` falls back to the
    run timestamp and ``is_external`` to false, as the table defaults do.
    Columns in ``keep`` are passed through after the mapped ones.
    """
    ts = run_ts if run_ts is not None else F.current_timestamp()
    cols = []
    for dst, src in column_map:
        c = F.col(src) if src in df.columns else F.lit(None)
        if dst == "discovered_at":
            c = F.coalesce(c.cast("timestamp"), ts)
        elif dst == "is_external":
            c = F.coalesce(c.cast("boolean"), F.lit(False))
        cols.append(c.alias(dst))
    return df.select(*cols, *[F.col(k) for k in keep])


def link_table_schema(column_map: Sequence[tuple[str, str]] = DEFAULT_COLUMN_MAP) -> T.StructType:
    """The link table's columns: id, the mapped columns (text unless the link schema says otherwise), label."""
    known = {f.name: f.dataType for f in LINK_SCHEMA.fields}
    names = ["id", *[dst for dst, _ in column_map if dst not in ("id", "pred_category")], "pred_category"]
    return T.StructType([T.StructField(n, known.get(n, T.StringType())) for n in names])


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns a stored table is laid out by, read from its folder names (``column=value``), outermost first."""
    found: list[str] = []
    while True:
        folders = sorted(n for n in list_names(spark, path) if "=" in n and n[0] not in "._")
        if not folders:
            return found
        found.append(folders[0].partition("=")[0])
        path = f"{path.rstrip('/')}/{folders[0]}"


def read_link_table(spark: SparkSession, path: str,
                    column_map: Sequence[tuple[str, str]] = DEFAULT_COLUMN_MAP) -> DataFrame:
    """A link table by its declared schema, whatever it is laid out by; a folder without committed files is an empty table."""
    schema = link_table_schema(column_map)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def write_link_rows(rows: DataFrame, path: str, column_map: Sequence[tuple[str, str]] = DEFAULT_COLUMN_MAP) -> None:
    """Append rows to a link table, in the table's own layout.

    Files put beside ``column=value`` folders would never be read again, so a
    table laid out by category is appended to by category.
    """
    layout = partition_columns(rows.sparkSession, path)
    out = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in link_table_schema(column_map).fields])
    out.write.mode("append").partitionBy(*layout).parquet(path)
