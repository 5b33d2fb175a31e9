"""Page source (K1): stored pages with url + HTML, read in place of fetching; a batch job passes any page DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def stream_pages(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of page files arriving in ``path``."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)
