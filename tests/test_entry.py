import duckdb

import __spark_entry__ as E

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1 and set(df.columns) == {"pred_category", "n_links", "n_external", "n_internal"}


def test_every_query_has_an_oracle():
    from linkloom.plans.queries import QUERIES

    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


def test_queries_match_oracle_smoke(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name in ["links_extract", "links_dedupe_run", "classify_first_match", "upsert_pages",
                 "answer_parse", "relabel_counts", "links_forms", "links_markup", "rules_from_config",
                 "stream_distinct"]:
        df = E.queries()[name](spark, sf)
        cols = sorted(df.columns)
        got = sorted(tuple(str(r[c]) for c in cols) for r in df.collect())
        res = con.sql(E.oracle_sql()[name])
        idx = [res.columns.index(c) for c in cols]
        want = sorted(tuple(str(r[i]) for i in idx) for r in res.fetchall())
        assert got == want, name
