from pyspark.sql import functions as F

from conftest import fixture_block
from linkloom.functions.urls import is_external, normalize_in_array, with_normalized_url

BASE = "https://www.shop.example/a/b?q=1#top"


def _golden_df(spark):
    rows = fixture_block("3.")
    return rows, spark.createDataFrame([(i, BASE, h) for i, (h, _) in enumerate(rows)],
                                       "i int, base string, href string")


def test_normalize_golden_rows(spark):
    rows, df = _golden_df(spark)
    got = {r.i: r.normalized_url for r in with_normalized_url(df, "base", "href").collect()}
    bad = [(rows[i][0], rows[i][1], got[i]) for i in range(len(rows)) if got[i] != rows[i][1]]
    assert not bad, bad


def test_normalize_golden_in_array(spark):
    rows, df = _golden_df(spark)
    packed = df.groupBy("base").agg(F.collect_list(F.struct("i", "href")).alias("a"))
    out = packed.select(F.explode(normalize_in_array(F.col("a"), F.col("base"))).alias("e"))
    got = {r.e.i: r.e.normalized_url for r in out.collect()}
    bad = [(rows[i][0], rows[i][1], got[i]) for i in range(len(rows)) if got[i] != rows[i][1]]
    assert not bad, bad


def test_normalize_idempotent(spark):
    _, df = _golden_df(spark)
    n1 = with_normalized_url(df, "base", "href", out="n").where("n is not null")
    n2 = with_normalized_url(n1, "n", "n", out="n2")
    assert n2.where("n <> n2").count() == 0


def test_is_external(spark):
    rows = fixture_block("4.")
    df = spark.createDataFrame([(u,) for u, _, _ in rows], "u string")
    got = df.select(is_external(F.col("u"), "shop.example").alias("p"),
                    is_external(F.col("u"), "shop.example", strict=True).alias("s")).collect()
    assert [(r.p, r.s) for r in got] == [(p, s) for _, p, s in rows]


def test_normalize_idempotent_generated(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st
    pieces = st.sampled_from(["/", "a", "B", ".", "..", "?", "&", "=", "#", ";", "%41", "%zz", "~", "*",
                              " ", "é", "utm_x=1", "id=2", "https://h.example", "//x.example", "HTTP:",
                              "mailto:", "a=1&&b", "/p?q=a+b"])
    hrefs = st.lists(st.lists(pieces, max_size=6).map("".join), min_size=50, max_size=50)

    # The original normaliser is idempotent only on well-formed results: an
    # authority-less "http:x" reference, or a path left ending in white space
    # when a fragment is cut, changes again on a second pass (in the original
    # too), so the property is checked on results with an authority and no
    # white space.
    ws = r"[\x00-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
    well_formed = F.col("n").rlike(r"^https?://[^/?#]+") & ~F.col("n").rlike(ws)

    @settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
    @given(hrefs)
    def check(batch):
        df = spark.createDataFrame([(BASE, h) for h in batch], "base string, href string")
        n1 = with_normalized_url(df, "base", "href", out="n").where(well_formed)
        n2 = with_normalized_url(n1, "n", "n", out="n2")
        assert n2.where("not (n <=> n2)").count() == 0
    check()


def test_nested_normalisation_plan_stays_small(spark):
    df = spark.createDataFrame([(BASE, "/x")], "base string, href string")
    n1 = with_normalized_url(df, "base", "href", out="n").where("n is not null")
    n2 = with_normalized_url(n1, "n", "n", out="n2").where("n2 is not null")
    plan = n2._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 400_000
