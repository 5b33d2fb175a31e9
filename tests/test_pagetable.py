import os
import tempfile

import pytest
from pyspark.sql import functions as F

from linkloom.functions.hashing import page_history
from linkloom.operators import pagetable
from linkloom.operators.keyed import upsert_pages
from linkloom.schemas import PAGE_SCHEMA

BATCH = ("url string, seq int, status_code int, title string, html_content string, content_length int, link_depth int")


def ts():
    return F.lit("2024-01-01").cast("timestamp")


def files(path):
    return {os.path.join(d, n) for d, _, names in os.walk(path) for n in names if n.startswith("part-") and "_" not in os.path.relpath(d, path)[:1]}


@pytest.fixture
def table(spark):
    path = tempfile.mkdtemp(prefix="linkloom-pages-") + "/pages"
    rows = [(i + 1, f"u{i}", 200, "old", f"m{i}", f"<{i}>", 3, 0, None, "h") for i in range(40)]
    pagetable.write_page_table(spark.createDataFrame(rows, PAGE_SCHEMA), path, buckets=8)
    return path


def batch(spark, rows):
    return spark.createDataFrame(rows, BATCH)


def test_upsert_touches_only_its_buckets(spark, table):
    before = files(table)
    items = batch(spark, [("u3", 1, 201, "first", "<a>", 3, 1), ("u3", 2, 202, "last", "<b>", 3, 1)])
    out = pagetable.upsert_page_table(items, table, "seq", run_ts=ts())
    rows = {r.url: r for r in out.collect()}
    assert len(rows) == 40 and (rows["u3"].id, rows["u3"].title, rows["u3"].meta_description) == (4, "last", "m3")
    gone = before - files(table)
    assert gone and len({os.path.dirname(f) for f in gone}) == 1  # one bucket's files were replaced, no other name changed


def test_upsert_equals_the_merge_of_whole_tables(spark, table):
    items = batch(spark, [(f"u{i % 50}" if i % 7 else None, i, 200, f"t{i}", None if i % 5 == 0 else f"<{i}>", i, 1) for i in range(30, 90)])
    want = upsert_pages(items, pagetable.read_page_table(spark, table), "seq", run_ts=ts()).orderBy("id").collect()
    pagetable.upsert_page_table(items, table, "seq", run_ts=ts())
    got = pagetable.read_page_table(spark, table).orderBy("id").collect()
    strip = lambda rows: sorted(tuple(r[c] for c in PAGE_SCHEMA.names if c != "id") for r in rows if r.url is None)
    assert [tuple(r) for r in got if r.url] == [tuple(r) for r in want if r.url]
    assert strip(got) == strip(want) and len({r.id for r in got}) == len(got)
    again = pagetable.upsert_page_table(items.where("url is not null"), table, "seq", run_ts=ts())
    assert [tuple(r) for r in again.orderBy("id").collect()] == [tuple(r) for r in got]


def test_first_upsert_makes_the_table_and_ids_go_on(spark):
    path = tempfile.mkdtemp(prefix="linkloom-pages-") + "/pages"
    pagetable.upsert_page_table(batch(spark, [("a", 2, 200, "a", "<a>", 3, 0), ("b", 1, 200, "b", "<b>", 3, 0)]), path, "seq", ts(), buckets=4)
    pagetable.upsert_page_table(batch(spark, [("c", 1, 200, "c", "<c>", 3, 0)]), path, "seq", ts())
    assert {r.url: r.id for r in pagetable.read_page_table(spark, path).collect()} == {"b": 1, "a": 2, "c": 3}
    assert pagetable.partition_columns(spark, path) == ["bucket_of_4"]
    assert pagetable.upsert_page_table(batch(spark, []), path, "seq", ts()).count() == 3


def test_a_write_cut_off_before_its_place_is_finished_by_the_next(spark, table, monkeypatch):
    items = batch(spark, [("u1", 1, 201, "new", "<n>", 3, 1), ("v", 2, 200, "v", "<v>", 3, 1)])
    real = pagetable._put_in_place
    calls = []

    def cut_off(*args):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("lost")
        real(*args)
    monkeypatch.setattr(pagetable, "_put_in_place", cut_off)
    with pytest.raises(OSError):
        pagetable.upsert_page_table(items, table, "seq", run_ts=ts())
    monkeypatch.setattr(pagetable, "_put_in_place", real)
    os.makedirs(f"{table}/_pending/incomplete/bucket_of_8=0")
    pagetable.upsert_page_table(batch(spark, [("w", 1, 200, "w", "<w>", 3, 1)]), table, "seq", run_ts=ts())
    rows = {r.url: (r.id, r.title) for r in pagetable.read_page_table(spark, table).collect()}
    assert rows["u1"] == (2, "new") and rows["v"] == (41, "v") and rows["w"] == (42, "w") and len(rows) == 42
    assert not os.listdir(f"{table}/_pending")


def test_no_html_in_a_window_or_sort(spark, table):
    items = batch(spark, [("u3", 1, 201, "first", "<a>", 3, 1)]).withColumn("__row", F.monotonically_increasing_id())
    plan = pagetable.last_rows(items, "seq")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "html_content" not in plan.split("Aggregate", 1)[1].split("LogicalRDD")[0]


def test_page_history_runs(spark):
    rows = [("a", 1, "x"), ("a", 2, "x"), ("a", 4, "y"), ("a", 5, "x"), ("b", 2, None), ("b", 3, None), ("b", 5, "z"),
            (None, 1, "x"), ("c", 3, "q"), ("c", 3, "r")]
    got = sorted(map(tuple, page_history(spark.createDataFrame(rows, "url string, crawl int, content_hash string")).collect()))
    assert got == [("a", 1, "x", 1, 2, 2, 4), ("a", 2, "y", 4, 4, 1, 5), ("a", 3, "x", 5, 5, 1, None),
                   ("b", 1, None, 2, 3, 2, 5), ("b", 2, "z", 5, 5, 1, None), ("c", 1, "r", 3, 3, 1, None)]
