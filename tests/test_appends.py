import tempfile

from linkloom.operators import keyed, keyfilter
from linkloom.operators.extract import run_links
from linkloom.operators.jobs import classify_table, store_links
from linkloom.session import list_names
from linkloom.sources.config import Settings
from linkloom.sources.tables import partition_columns, read_link_table

RULES = [("even", "[02468]/?$", []), ("odd", "[13579]/?$", [])]


def test_appends_survive_the_category_layout(spark, sf_dir):
    settings = Settings(rules=RULES, url_col="normalized_url")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    root = tempfile.mkdtemp(prefix="linkloom-layout-")
    n = store_links(pages.where("page_id < 10"), f"{root}/a", "example.com", settings).count()
    classify_table(spark, f"{root}/a", f"{root}/b", None, settings, partition_by_category=True)
    want = run_links(pages.where("page_id < 20"), "example.com").count()
    for _ in range(2):
        got = store_links(pages.where("page_id < 20"), f"{root}/b", "example.com", settings)
        assert got.count() == want > n and got.select("id").distinct().count() == want
        assert got.where("pred_category is null").count() == want - n
    assert partition_columns(spark, f"{root}/b") == ["pred_category"]
    assert not [x for x in list_names(spark, f"{root}/b") if x.startswith("part-")]
    classify_table(spark, f"{root}/b", f"{root}/c", None, settings, partition_by_category=True)
    assert read_link_table(spark, f"{root}/c").where("pred_category is null").count() == 0


def test_filter_spares_new_keys_the_join_and_loses_none(spark):
    path = tempfile.mkdtemp(prefix="linkloom-filter-") + "/t"
    stored = spark.range(0, 30000).selectExpr("concat('https://x.example/', id) AS k")
    keyfilter.add_to_filter(stored.where("length(k) < 22"), None, "k", path, 10000)
    keyfilter.add_to_filter(stored.where("length(k) >= 22"), stored, "k", path, 30000)
    rows = spark.range(25000, 55000).selectExpr("concat('https://x.example/', id) AS k", "id").unionByName(
        spark.createDataFrame([(None, -1)], "k string, id long"))
    certain, open_ = keyfilter.split_by_filter(rows, "k", path)
    assert certain.join(stored, "k", "left_semi").count() == 0                      # nothing stored is called new
    assert certain.count() + open_.count() == 30001
    assert 5000 <= open_.count() < 5000 + 0.1 * 25000                              # few new keys meet the stored ones
    assert certain.where("k is null").count() == 1


def test_filter_grows_with_the_table(spark):
    path = tempfile.mkdtemp(prefix="linkloom-filter-") + "/t"
    small = spark.range(10).selectExpr("cast(id as string) AS k")
    assert keyfilter.split_by_filter(small, "k", path) is None
    keyfilter.add_to_filter(small, None, "k", path, 10)
    first = keyfilter.filter_blocks(spark, path)
    keyfilter.add_to_filter(spark.range(10, 20).selectExpr("cast(id as string) AS k"), small, "k", path, keyfilter.FULL * first + 1)
    assert keyfilter.filter_blocks(spark, path) > first
    both = spark.range(20).selectExpr("cast(id as string) AS k")
    assert keyfilter.split_by_filter(both, "k", path)[1].count() == 20


def test_ids_go_on_from_the_stored_mark_without_a_scan(spark, sf_dir, monkeypatch):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = tempfile.mkdtemp(prefix="linkloom-mark-") + "/t"
    store_links(pages.where("page_id < 5"), path, "example.com")

    def no_scan(*_):
        raise AssertionError("the largest id was looked for in the table")
    monkeypatch.setattr(keyed, "next_id_base", no_scan)
    table = store_links(pages.where("page_id < 9"), path, "example.com")
    n = table.count()
    assert sorted(r.id for r in table.select("id").collect()) == list(range(1, n + 1))
    # a new version of the table goes on from the old one's mark, and compares with its filter
    settings = Settings(rules=RULES, url_col="normalized_url")
    classify_table(spark, path, f"{path}-2", None, settings)
    assert keyfilter.filter_blocks(spark, f"{path}-2") == keyfilter.filter_blocks(spark, path) > 0
    table = store_links(pages.where("page_id < 12"), f"{path}-2", "example.com", settings)
    m = table.count()
    assert m > n and sorted(r.id for r in table.select("id").collect()) == list(range(1, m + 1))
