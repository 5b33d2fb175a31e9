"""The link table keeps its columns over jobs and streams; sources refuse what they cannot read whole."""

import os
import time

import pytest
from pyspark.sql import functions as F

from linkloom.config import rule_pack
from linkloom.functions.hashing import page_changes
from linkloom.functions.html import anchors_of
from linkloom.functions.prompts import parse_label
from linkloom.functions.urls import with_normalized_url
from linkloom.operators.classify import rule_case
from linkloom.operators.jobs import classify_table, store_links
from linkloom.sources.config import Settings, read_config_text
from linkloom.sources.export import export_categories, read_export
from linkloom.streaming.links import write_links_batch


def _pages(spark, *names):
    return spark.createDataFrame([(i, f"https://shop.example/{n}", f'<a href="https://shop.example/{n}-p-{i}">x</a>') for i, n in enumerate(names)],
                                 "page_id long, url string, html string")


def test_labels_outlive_later_crawls_and_micro_batches(spark, tmp_path):
    v0, v1 = str(tmp_path / "v0"), str(tmp_path / "v1")
    settings = Settings(rules=rule_pack("shop.example"))
    first = store_links(_pages(spark, "a", "b"), v0, "shop.example", settings)
    assert "pred_category" in first.columns
    classify_table(spark, v0, v1, None, settings)
    store_links(_pages(spark, "a", "c"), v1, "shop.example", settings)
    write_links_batch(_pages(spark, "d"), v1, "shop.example", settings)
    got = spark.read.parquet(v1)
    assert got.columns == first.columns
    assert got.where("pred_category = 'product'").count() == 2 and got.where("pred_category is null").count() == 2
    assert got.where("discovered_at is null").count() == 0 and got.select("id").distinct().count() == 4


def test_stream_restarts_on_a_folder_without_committed_files(spark, tmp_path):
    os.makedirs(tmp_path / "links" / "_temporary")
    write_links_batch(_pages(spark, "a"), str(tmp_path / "links"), "shop.example")
    assert spark.read.parquet(str(tmp_path / "links")).count() == 1


def test_config_folder_with_two_files_is_refused(spark, tmp_path):
    for name in ("a.json", "b.json"):
        (tmp_path / name).write_text("{}")
    with pytest.raises(ValueError):
        read_config_text(spark, str(tmp_path))
    assert read_config_text(spark, str(tmp_path / "a.json")) == "{}"


def test_long_rule_lists_compile(spark):
    rules = [(f"r{i}", f"^x{i}$", []) for i in range(450)]
    got = spark.createDataFrame([("x0",), ("x449",), ("y",)], "url string").select(rule_case(F.col("url"), rules).alias("c"))
    assert [r.c for r in got.collect()] == ["r0", "r449", "other"]


def test_answers_of_any_shape_have_a_label():
    odd = ["[" * 100_000, '{"label": ' + "9" * 5000 + "}", "``" + "`", '```json\n{"label": "product"}\n```',
           'so: {"label": "product"} ok', '[1]', '{"label": ["product"]}', None]
    assert [parse_label(x, ["product", "other"]) for x in odd] == \
        ["other", "other", "other", "product", "product", "other", "other", "other"]


def test_bound_columns_of_two_frames_normalise(spark):
    for _ in range(2):
        df = spark.createDataFrame([("http://ex.example/a//b/../c", "q=1")], "base string, href string")
        assert with_normalized_url(df, df["base"], df["href"], out="n").first()["n"] == "http://ex.example/a/q=1"
    assert with_normalized_url(df, "base", "href", out="n").first()["n"] == "http://ex.example/a/q=1"


def test_stray_end_tags_cost_linear_time():
    began = time.perf_counter()
    assert len(anchors_of("<a href=x>y</a>" + "<p>" * 16_000 + "</x>" * 16_000)) == 1
    assert time.perf_counter() - began < 0.5


def test_export_keeps_line_breaks_and_splits_a_hot_url(spark, tmp_path):
    rows = spark.range(2000).select(F.when(F.col("id") % 2 == 0, "/").otherwise(F.concat(F.lit("/a\nb"), "id")).alias("url"),
                                    F.lit("x").alias("pred_category"))
    path = export_categories(rows, str(tmp_path / "csv"))
    back = read_export(spark, path)
    assert back.count() == 2000 and back.where("url = '/'").count() == 1000


def test_page_changes_takes_one_row_a_url(spark):
    old = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", None), ("c", None)], "url string, content_hash string")
    new = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", None), ("d", "1")], "url string, content_hash string")
    assert {r.url: r.change for r in page_changes(old, new).collect()} == {"a": "same", "b": "same", "c": "gone", "d": "new"}
