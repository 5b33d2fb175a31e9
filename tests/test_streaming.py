import os
import shutil
import tempfile

from linkloom.operators.dedupe import run_distinct_links
from linkloom.operators.extract import page_links
from linkloom.streaming.links import start_link_stream, stream_seen_urls


def test_stream_equals_batch_and_replay_adds_nothing(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    work = tempfile.mkdtemp(prefix="linkloom-stream-")
    src = os.path.join(work, "in")
    os.makedirs(src)
    # pages arrive as two files, one micro-batch each
    shutil.copy(f"{sf_dir}/pages.parquet", os.path.join(src, "part-1.parquet"))
    out = os.path.join(work, "links")
    q = start_link_stream(spark, src, pages.schema, out, os.path.join(work, "ck1"), "example.com",
                          max_files_per_trigger=1)
    q.awaitTermination()
    shutil.copy(f"{sf_dir}/pages.parquet", os.path.join(src, "part-2.parquet"))
    q = start_link_stream(spark, src, pages.schema, out, os.path.join(work, "ck1"), "example.com",
                          max_files_per_trigger=1)
    q.awaitTermination()
    # a replay from an empty checkpoint adds nothing either
    q = start_link_stream(spark, src, pages.schema, out, os.path.join(work, "ck2"), "example.com")
    q.awaitTermination()
    stored = spark.read.parquet(out)
    batch = run_distinct_links(page_links(pages, "example.com"))
    assert stored.count() == batch.count()
    assert sorted(r.normalized_url for r in stored.select("normalized_url").collect()) == \
        sorted(r.normalized_url for r in batch.select("normalized_url").collect())
    ids = stored.select("id").distinct().count()
    assert ids == stored.count()


def test_streaming_distinct_query(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    links = run_distinct_links(page_links(pages, "example.com"))
    work = tempfile.mkdtemp(prefix="linkloom-sdist-")
    links.write.parquet(os.path.join(work, "in"))
    stream = spark.readStream.schema(links.schema).parquet(os.path.join(work, "in"))
    q = (stream_seen_urls(stream).writeStream.format("memory").queryName("seen_urls")
         .option("checkpointLocation", os.path.join(work, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("seen_urls").count() == links.count()


def test_failed_batch_is_retried_not_lost(spark, sf_dir, monkeypatch):
    import pytest
    from pyspark.errors import StreamingQueryException

    import linkloom.streaming.links as L
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    work = tempfile.mkdtemp(prefix="linkloom-s4-")
    src = os.path.join(work, "in")
    os.makedirs(src)
    shutil.copy(f"{sf_dir}/pages.parquet", os.path.join(src, "part-1.parquet"))
    out, ck = os.path.join(work, "links"), os.path.join(work, "ck")
    real = L.write_links_batch

    def failing(batch, table_path, root_domain):
        raise RuntimeError("sink unavailable")
    monkeypatch.setattr(L, "write_links_batch", failing)
    q = start_link_stream(spark, src, pages.schema, out, ck, "example.com", seen="table")
    with pytest.raises(StreamingQueryException):
        q.awaitTermination()
    monkeypatch.setattr(L, "write_links_batch", real)
    q = start_link_stream(spark, src, pages.schema, out, ck, "example.com", seen="table")
    q.awaitTermination()
    expected = run_distinct_links(page_links(pages, "example.com")).count()
    assert spark.read.parquet(out).count() == expected


def test_state_reads_the_table_once_a_run_and_keeps_the_first_sighting(spark, sf_dir, monkeypatch):
    import linkloom.streaming.links as L
    from linkloom.operators.extract import run_links
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").orderBy("page_id")
    work = tempfile.mkdtemp(prefix="linkloom-state-")
    src, out, ck = (os.path.join(work, n) for n in ("in", "links", "ck"))
    for k in range(3):  # later files repeat earlier links
        pages.where(f"page_id >= {k * 50} and page_id < {k * 50 + 100}").coalesce(1).write.parquet(os.path.join(src, f"{k}"))
    compared, reals = [], L.absent_places
    monkeypatch.setattr(L, "absent_places", lambda *a: compared.append(1) or reals(*a))
    glob = os.path.join(src, "*")
    q = start_link_stream(spark, glob, pages.schema, out, ck, "example.com", max_files_per_trigger=1)
    q.awaitTermination()
    assert len(q.recentProgress) >= 3 and not compared  # a new table; later micro-batches never look at it
    assert L.STATE_STORE not in dict(spark.sparkContext.getConf().getAll())
    pages.where("page_id >= 150 and page_id < 250").coalesce(1).write.parquet(os.path.join(src, "3"))
    start_link_stream(spark, glob, pages.schema, out, ck, "example.com", max_files_per_trigger=1).awaitTermination()
    assert len(compared) == 1
    cols = ["normalized_url", "url", "anchor_text"]
    got = sorted((tuple(r) for r in spark.read.parquet(out).select(*cols).collect()), key=repr)
    assert got == sorted((tuple(r) for r in run_links(pages, "example.com").select(*cols).collect()), key=repr)
    ids = [r.id for r in spark.read.parquet(out).select("id").collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))
