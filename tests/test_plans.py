from pyspark.sql import functions as F

from linkloom.operators.dedupe import run_distinct_links
from linkloom.operators.extract import page_links
from linkloom.operators.relabel import residue


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_extraction_is_map_only_and_parses_once(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    plan = _plan(page_links(pages, "example.com"))
    assert plan.count("ArrowEvalPython") == 1
    # the only exchange allowed is the round-robin spread of a tiny input
    assert "hashpartitioning" not in plan


def test_run_dedupe_limits_before_shuffle(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    plan = _plan(run_distinct_links(page_links(pages, "example.com")))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_residue_filter_reaches_parquet(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "other", "a", "h"), (2, "v", "x", "b", "h"), (3, "w", None, "c", "h")],
                               "id long, url string, pred_category string, anchor_text string, html string")
    df.write.parquet(str(tmp_path / "links"))
    scan = spark.read.parquet(str(tmp_path / "links"))
    r = residue(scan).select("id", "url")
    plan = _plan(r)
    assert "PushedFilters: [Or(IsNull(pred_category),EqualTo(pred_category,other))]" in plan
    # only the columns used are read (K7)
    assert "ReadSchema: struct<id:bigint,url:string,pred_category:string>" in plan
    assert sorted(x.id for x in r.collect()) == [1, 3]
