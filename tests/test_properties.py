from pyspark.sql import functions as F

from linkloom.config import rule_pack
from linkloom.operators.classify import classify_url, rule_case
from linkloom.operators.dedupe import run_distinct_links
from linkloom.operators.extract import page_links
from linkloom.plans.catalog import shop_links

RULES = rule_pack("shop.example")


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_run_distinct_ignores_partitioning(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    cols = ["normalized_url", "page_id", "pos", "url"]
    a = run_distinct_links(page_links(pages, "example.com")).select(*cols)
    shuffled = pages.repartition(7, F.rand(3))
    b = run_distinct_links(page_links(shuffled, "example.com")).select(*cols)
    assert _rows(a) == _rows(b)


def test_set_and_row_classifiers_agree_on_clean_urls(spark, sf_dir):
    links = shop_links(spark, sf_dir).where(F.col("url").isNotNull())
    diff = links.where(rule_case(F.col("url"), RULES) != classify_url(F.col("url"), RULES))
    assert diff.count() == 0


def test_hot_url_keeps_first_sighting(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    # every page links to the same place several times: one key holds a large share of all rows
    hot = '<a href="https://hot.example/x">h</a>' * 5
    skewed = pages.withColumn("html", F.concat(F.col("html"), F.lit(hot)))
    links = page_links(skewed, "example.com", dedupe_page=False)
    total = links.count()
    n_hot = links.where("normalized_url = 'https://hot.example/x'").count()
    assert n_hot == 5 * pages.count() and n_hot * 4 > total
    run = run_distinct_links(page_links(skewed, "example.com"))
    hot_rows = run.where("normalized_url = 'https://hot.example/x'").collect()
    first_page = pages.agg(F.min("page_id")).first()[0]
    assert len(hot_rows) == 1 and hot_rows[0].page_id == first_page
    # the row-wise run path gives the same first sighting and limits before its shuffle
    from linkloom.operators.extract import run_links
    rl = run_links(skewed, "example.com")
    rl_hot = rl.where("normalized_url = 'https://hot.example/x'").collect()
    assert [(r.page_id, r.pos) for r in rl_hot] == [(hot_rows[0].page_id, hot_rows[0].pos)]
    plan = rl._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
