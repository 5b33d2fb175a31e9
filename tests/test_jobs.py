import json
import os
import tempfile

from pyspark.sql import functions as F

from linkloom.config import rule_pack
from linkloom.operators.jobs import classify_table, relabel_table, store_links
from linkloom.plans.stubs import stub_complete
from linkloom.sources.config import parse_settings, read_settings


def _config(tmp):
    cfg = {"db": {"table": "links", "unique_key": "normalized_url", "buffer_size": 200},
           "columns": {"url": "url", "normalized_url": "normalized_url", "anchor_text": "anchor_text",
                       "rel": "rel", "is_external": "is_external", "discovered_at": "discovered_at"},
           "classification": {"url_col": "normalized_url", "only_update_nulls": True,
                              "patterns": [{"label": l, "pattern": p, "flags": f}
                                           for l, p, f in rule_pack("example.com")]},
           "relabel": {"select_where_other_sql": "COALESCE(pred_category, 'other') = 'other'",
                       "batch_size": 100, "max_batches": 0, "taxonomy": ["homepage", "other"]}}
    path = os.path.join(tmp, "cfg.json")
    with open(path, "w") as f:
        json.dump(cfg, f, indent=2)
    return path


def test_settings_keep_column_order():
    s = parse_settings('{"columns": {"b": "x", "a": "y"}}')
    assert s.column_map == [("b", "x"), ("a", "y")]
    assert s.unique_key == "normalized_url" and s.batch_size == 100


def test_three_jobs_end_to_end(spark, sf_dir):
    tmp = tempfile.mkdtemp(prefix="linkloom-jobs-")
    settings = read_settings(spark, _config(tmp))
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    table = os.path.join(tmp, "links")
    ts = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    first = store_links(pages, table, "example.com", settings, run_ts=ts)
    n = first.count()
    again = store_links(pages, table, "example.com", settings, run_ts=ts)
    assert again.count() == n                      # replay adds nothing
    assert first.select("id").distinct().count() == n
    assert first.columns == ["id", "url", "normalized_url", "anchor_text", "rel", "is_external",
                             "discovered_at", "pred_category"]
    classified = classify_table(spark, table, os.path.join(tmp, "v2"), os.path.join(tmp, "csv"), settings)
    assert classified.where("pred_category is null").count() == 0
    relabelled = relabel_table(spark, os.path.join(tmp, "v2"), os.path.join(tmp, "v3"), stub_complete,
                               settings, sleep=lambda s: None)
    cats = {r.pred_category for r in relabelled.select("pred_category").distinct().collect()}
    assert cats <= {"homepage", "other"} | {l for l, _, _ in settings.rules}
    assert relabelled.count() == n


def test_category_layout_prunes(spark, sf_dir):
    tmp = tempfile.mkdtemp(prefix="linkloom-layout-")
    settings = read_settings(spark, _config(tmp))
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    table = os.path.join(tmp, "links")
    store_links(pages, table, "example.com", settings)
    out = classify_table(spark, table, os.path.join(tmp, "v2"), None, settings, partition_by_category=True)
    q = spark.read.parquet(os.path.join(tmp, "v2")).where("pred_category = 'other'")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pred_category" in plan
    assert q.count() == out.where("pred_category = 'other'").count()


def test_column_defaults(spark):
    from linkloom.sources.tables import apply_column_map, ensure_column
    df = spark.createDataFrame([("u1", None, None), ("u2", True, "2024-01-05 00:00:00")],
                               "normalized_url string, is_external boolean, discovered_at string")
    cmap = [("link", "normalized_url"), ("is_external", "is_external"), ("discovered_at", "discovered_at"),
            ("missing", "no_such_field")]
    out = ensure_column(apply_column_map(df, cmap, run_ts=F.to_timestamp(F.lit("2024-02-01 00:00:00"))),
                        "pred_category")
    rows = {r.link: r for r in out.collect()}
    assert out.columns == ["link", "is_external", "discovered_at", "missing", "pred_category"]
    assert rows["u1"].is_external is False and str(rows["u1"].discovered_at) == "2024-02-01 00:00:00"
    assert rows["u2"].is_external is True and str(rows["u2"].discovered_at) == "2024-01-05 00:00:00"
    assert rows["u1"].missing is None and rows["u1"].pred_category is None
