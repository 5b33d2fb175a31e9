from pyspark.sql import functions as F

from linkloom.functions.hashing import content_hash, page_changes
from linkloom.operators.ids import dense_rank_rows
from linkloom.operators.keyed import insert_if_absent, upsert_pages
from linkloom.session import reliable_checkpoint


def test_insert_if_absent_first_row_wins_and_is_repeatable(spark):
    target = spark.createDataFrame([(1, "A", "t0", 0)], "id long, normalized_url string, v string, seq int")
    batch = spark.createDataFrame([("B", "t1", 1), ("A", "t2", 2), ("B", "t3", 3)],
                                  "normalized_url string, v string, seq int")
    added = insert_if_absent(batch, target, "normalized_url", ["seq"])
    assert [(r.id, r.normalized_url, r.v) for r in added.collect()] == [(2, "B", "t1")]
    stored = target.unionByName(added.select(*target.columns))
    again = insert_if_absent(batch, stored, "normalized_url", ["seq"])
    assert again.count() == 0


def test_insert_if_absent_null_keys_pass(spark):
    batch = spark.createDataFrame([(None, 1), (None, 2), ("A", 3)], "k string, seq int")
    target = spark.createDataFrame([(1, None)], "id long, k string")
    assert insert_if_absent(batch, target, "k", ["seq"]).count() == 3


def test_upsert_last_wins_keeps_id_and_meta(spark):
    target = spark.createDataFrame(
        [(1, "U", 200, "old", "m", "<p>", 3, 0, None, None)],
        "id long, url string, status_code int, title string, meta_description string, html_content string,"
        " content_length int, link_depth int, fetched_at timestamp, content_hash string")
    batch = spark.createDataFrame(
        [("U", 1, 201, "new", None, 0, 1), ("V", 2, 200, "v", "<a>", 3, 1), ("V", 3, 200, None, None, 0, 2)],
        "url string, seq int, status_code int, title string, html_content string, content_length int, link_depth int")
    rows = {r.url: r for r in upsert_pages(batch, target, "seq", run_ts=F.lit("2024-01-01").cast("timestamp")).collect()}
    assert (rows["U"].id, rows["U"].title, rows["U"].meta_description, rows["U"].status_code) == (1, "new", "m", 201)
    assert rows["U"].html_content == "" and rows["U"].content_hash.startswith("e3b0c442")
    # the later V item wins, and its NULL title overwrites
    assert (rows["V"].id, rows["V"].title, rows["V"].meta_description, rows["V"].link_depth) == (2, None, None, 2)


def test_upsert_twice_equals_once(spark):
    batch = spark.createDataFrame([("U", 1, 200, "t", "<a>", 3, 0)],
                                  "url string, seq int, status_code int, title string, html_content string,"
                                  " content_length int, link_depth int")
    ts = F.lit("2024-01-01").cast("timestamp")
    once = reliable_checkpoint(upsert_pages(batch, None, "seq", run_ts=ts))
    twice = upsert_pages(batch, once, "seq", run_ts=ts)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_page_changes(spark):
    old = spark.createDataFrame([("a", "<1>"), ("b", "<2>"), ("c", "<3>")], "url string, html string")
    new = spark.createDataFrame([("a", "<1>"), ("b", "<x>"), ("d", "<4>")], "url string, html string")
    h = lambda df: df.select("url", content_hash(F.col("html")).alias("content_hash"))
    got = {r.url: r.change for r in page_changes(h(old), h(new)).collect()}
    assert got == {"a": "same", "b": "changed", "c": "gone", "d": "new"}


def test_dense_ids_are_a_permutation(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name")
    ids = dense_rank_rows(part, ["p_name", "p_partkey"], out="rn")
    n = part.count()
    assert ids.agg(F.min("rn"), F.max("rn"), F.countDistinct("rn")).first() == (1, n, n)
    plan = ids._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_upsert_snapshots_switch_versions(spark):
    import tempfile
    from linkloom.operators.keyed import latest_snapshot, upsert_snapshot
    root = tempfile.mkdtemp(prefix="linkloom-snap-") + "/pages"
    schema = ("url string, seq int, status_code int, title string, html_content string,"
              " content_length int, link_depth int")
    b1 = spark.createDataFrame([("U", 1, 200, "a", "<1>", 3, 0)], schema)
    b2 = spark.createDataFrame([("U", 1, 200, "b", "<2>", 3, 0), ("V", 2, 200, "v", "<3>", 3, 0)], schema)
    ts = F.lit("2024-01-01").cast("timestamp")
    upsert_snapshot(spark, b1, root, "seq", run_ts=ts)
    upsert_snapshot(spark, b2, root, "seq", run_ts=ts)
    v, path = latest_snapshot(spark, root)
    rows = {r.url: (r.id, r.title) for r in spark.read.parquet(path).collect()}
    assert v == 1 and rows == {"U": (1, "b"), "V": (2, "v")}


def test_upsert_null_urls_never_conflict(spark):
    target = spark.createDataFrame(
        [(1, None, 200, "t-null", "m", "<a>", 3, 0, None, None), (2, "U", 200, "old", "m", "<b>", 3, 0, None, None)],
        "id long, url string, status_code int, title string, meta_description string, html_content string,"
        " content_length int, link_depth int, fetched_at timestamp, content_hash string")
    batch = spark.createDataFrame(
        [(None, 1, 200, "b-null-1", "<c>", 3, 1), (None, 2, 200, "b-null-2", "<d>", 3, 1), ("U", 3, 200, "new", "<e>", 3, 1)],
        "url string, seq int, status_code int, title string, html_content string, content_length int, link_depth int")
    rows = upsert_pages(batch, target, "seq", run_ts=F.lit("2024-01-01").cast("timestamp")).collect()
    by_title = {r.title: r for r in rows}
    assert len(rows) == 4
    assert by_title["t-null"].id == 1 and by_title["new"].id == 2 and by_title["new"].url == "U"
    assert sorted(by_title[t].id for t in ("b-null-1", "b-null-2")) == [3, 4]
