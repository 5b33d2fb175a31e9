"""Link extraction and keyed writes as a Structured Streaming query (S1..S4).

Pages arrive as files and are extracted map-only.  Which URLs were seen is
keyed streaming state: per normalised URL the least (page_id, pos) of the
micro-batch that brought it, so the first sighting survives inside a
micro-batch and later ones never pass.  A query with a new checkpoint takes
the URLs of the stored table as its initial state, so a replay adds nothing;
after that a micro-batch reads its pages and its state, never the table (S1,
S3).  Ids continue from the table's stored mark.

A failed batch fails the query, which then resumes from its checkpoint, rather
than dropping rows (S4).  Only the first micro-batch of a run can be one that
was written before, so that one alone is compared with the stored keys.

A table has one keeper of its keys: while a state-keeping stream runs, batch
jobs must not append to the same table (start the stream from a new checkpoint
afterwards).  ``seen="table"`` keeps no state and compares every micro-batch
with the stored keys instead, as ``append_links`` does, for tables that are
also written otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.extract import page_links, run_links
from ..operators.keyed import absent_places, add_link_rows, append_links, staged, stored_links
from ..sources.config import Settings
from ..sources.pages import stream_pages
from ..sources.tables import apply_column_map

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstSighting(StatefulProcessor):
    """Lets the first row of a key pass, by (page_id, pos) inside a micro-batch, and remembers its place."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.place = handle.getValueState("place", "page_id long, pos int")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.place.update((None, None))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if self.place.exists():
            return
        least = None
        for some in rows:
            first = some.sort_values(["page_id", "pos"]).iloc[:1]
            if least is None or (first["page_id"].iloc[0], first["pos"].iloc[0]) < (least["page_id"].iloc[0], least["pos"].iloc[0]):
                least = first
        if least is not None:
            self.place.update((int(least["page_id"].iloc[0]), int(least["pos"].iloc[0])))
            yield least

    def close(self) -> None:
        pass


def first_sightings(links_stream: DataFrame, seen: DataFrame, key: str = "normalized_url") -> DataFrame:
    """Rows of a stream of links whose ``key`` is neither in ``seen`` (first batch) nor passed before.

    Needs the RocksDB state store.  Rows without a key are dropped.
    """
    return (links_stream.where(F.col(key).isNotNull()).groupBy(key)
            .transformWithStateInPandas(statefulProcessor=FirstSighting(), outputStructType=links_stream.schema,
                                        outputMode="Append", timeMode="None",
                                        initialState=seen.where(F.col(key).isNotNull()).select(key).distinct().groupBy(key)))


def write_links_batch(batch: DataFrame, table_path: str, root_domain: str,
                      settings: Settings | None = None, run_ts: Column | None = None) -> None:
    """One micro-batch of pages -> new link rows appended to ``table_path``, as a batch job writes them."""
    append_links(run_links(batch, root_domain), table_path, settings or Settings(), run_ts)


def write_sightings(batch: DataFrame, table_path: str, settings: Settings | None = None, run_ts: Column | None = None,
                    again: bool = False) -> None:
    """Append one micro-batch of first sightings; ``again``: some of them may be stored already."""
    s = settings or Settings()
    rows = staged(apply_column_map(batch, s.column_map, run_ts=run_ts, keep=["page_id", "pos"]), "sightings")
    target = stored_links(batch.sparkSession, table_path, s)
    places = rows.select("page_id", "pos", s.unique_key)
    if again and target is not None:
        places = absent_places(places, target, s.unique_key, table_path)
    add_link_rows(rows, places, target, table_path, s)


def start_link_stream(spark: SparkSession, pages_path: str, schema, table_path: str,
                      checkpoint_path: str, root_domain: str,
                      max_files_per_trigger: int | None = None, available_now: bool = True,
                      settings: Settings | None = None, seen: str = "state",
                      watch: Callable[[str, int], None] | None = None):
    """Start the stream; returns the ``StreamingQuery``.

    ``seen``: "state" keeps the seen URLs in the state store, "table" compares
    every micro-batch with the stored table.  ``watch`` is called with
    "before" or "after" and the batch number around each write; what it raises
    fails the batch.
    """
    pages = stream_pages(spark, pages_path, schema, max_files_per_trigger)
    if seen == "table":
        return _started(pages.writeStream.foreachBatch(
            _watched(lambda df: write_links_batch(df, table_path, root_domain, settings), watch)), checkpoint_path, available_now)
    s = settings or Settings()
    links = page_links(pages, root_domain)
    source = dict(s.column_map)[s.unique_key]
    table = stored_links(spark, table_path, s)
    stored = (spark.createDataFrame([], links.select(source).schema) if table is None
              else table.select(F.col(s.unique_key).alias(source)))
    done: list[int] = []

    def write(batch: DataFrame) -> None:
        write_sightings(batch, table_path, s, again=not done)
        done.append(1)

    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKS)
    try:
        return _started(first_sightings(links, stored, source).writeStream.outputMode("append").foreachBatch(_watched(write, watch)),
                        checkpoint_path, available_now)
    finally:
        spark.conf.set(STATE_STORE, before) if before else spark.conf.unset(STATE_STORE)


def _watched(write: Callable[[DataFrame], None], watch: Callable[[str, int], None] | None):
    def run(batch: DataFrame, number: int) -> None:
        if watch:
            watch("before", number)
        write(batch)
        if watch:
            watch("after", number)
    return run


def _started(stream, checkpoint_path: str, available_now: bool):
    stream = stream.option("checkpointLocation", checkpoint_path)
    stream = stream.trigger(availableNow=True) if available_now else stream.trigger(processingTime="10 seconds")
    return stream.start()


def stream_seen_urls(links_stream: DataFrame, watermark_col: str | None = None,
                     delay: str = "1 hour") -> DataFrame:
    """Streaming distinct on the normalised URL (unbounded state), or
    within a watermark (bounded state) when an event-time column is given."""
    if watermark_col:
        return links_stream.withWatermark(watermark_col, delay) \
            .dropDuplicatesWithinWatermark(["normalized_url"])
    return links_stream.dropDuplicates(["normalized_url"])
