from pyspark.sql import functions as F

from linkloom.operators.relabel import apply_labels, label_residue, next_batch, relabel_counts
from linkloom.plans.stubs import FlakyStub, stub_complete

ROWS = [(1, "https://s.example/a-p-1", None, None, False, None),
        (2, "https://s.example/marka/x", "b", None, True, "other"),
        (3, "https://s.example/", None, "nofollow", False, None),
        (4, "https://s.example/zz", None, None, False, "other"),
        (5, "https://s.example/kept", None, None, False, "campaign")]
SCHEMA = "id long, url string, anchor_text string, rel string, is_external boolean, pred_category string"


def test_relabel_with_stub(spark):
    links = spark.createDataFrame(ROWS, SCHEMA)
    labels = label_residue(links, stub_complete, batch_size=2, sleep=lambda s: None)
    got = {r.id: r.pred_category for r in apply_labels(links, labels).collect()}
    assert got == {1: "product", 2: "brand", 3: "homepage", 4: "other", 5: "campaign"}
    counts = {r.batch_no: r.n_updated for r in relabel_counts(labels).collect()}
    assert counts == {1: 2, 2: 2}


def test_retry_without_waiting(spark):
    links = spark.createDataFrame(ROWS, SCHEMA).coalesce(1)
    waits = []
    labels = label_residue(links, FlakyStub(failures=2), batch_size=10, sleep=waits.append)
    got = {r.id: r.label for r in labels.collect()}
    assert got[1] == "product"


def test_gives_up_to_other(spark):
    links = spark.createDataFrame(ROWS, SCHEMA).coalesce(1)
    labels = label_residue(links, FlakyStub(failures=100), tries=3, sleep=lambda s: None)
    assert {r.label for r in labels.collect()} == {"other"}


def test_max_batches_caps_lowest_ids(spark):
    links = spark.createDataFrame(ROWS, SCHEMA)
    labels = label_residue(links, stub_complete, batch_size=1, max_batches=2, sleep=lambda s: None)
    assert sorted(r.id for r in labels.collect()) == [1, 2]


def test_next_batch_is_topk(spark):
    links = spark.createDataFrame(ROWS, SCHEMA)
    nb = next_batch(links, 2)
    assert [r.id for r in nb.collect()] == [1, 2]
    assert "TakeOrderedAndProject" in nb._jdf.queryExecution().executedPlan().toString()


def test_bounded_parallel_calls(spark):
    links = spark.createDataFrame(ROWS, SCHEMA)
    labels = label_residue(links, stub_complete, max_parallel_calls=2, sleep=lambda s: None)
    assert sorted(r.id for r in labels.collect()) == [1, 2, 3, 4]


def test_caller_predicate_is_the_selection(spark):
    from pyspark.sql import functions as F

    from linkloom.operators.relabel import residue, unasked
    links = spark.createDataFrame(ROWS, SCHEMA)
    assert sorted(r.id for r in residue(links).collect()) == [1, 2, 3, 4]
    done = links.withColumn("pred_category", F.lit("help"))
    assert sorted(r.id for r in residue(done, where="pred_category = 'help' AND id > 1").collect()) == \
        sorted(r.id for r in done.where("id > 1").collect())
    asked = label_residue(links, stub_complete, batch_size=1, max_batches=2, sleep=lambda s: None)
    assert unasked(links, asked).first()["n_unasked"] == 2


def test_only_the_poisoned_prompt_goes_without(spark):
    rows = [(i, f"https://shop.example/x-p-{i}" if i != 57 else "https://shop.example/poison", "a", None, False, None)
            for i in range(100)]
    links = spark.createDataFrame(rows, "id long, url string, anchor_text string, rel string, is_external boolean, "
                                        "pred_category string").coalesce(1)

    def complete(system, prompts):
        if any("poison" in p for p in prompts):
            raise RuntimeError("no answer")
        return ['{"label": "product"}'] * len(prompts)

    labels = label_residue(links, complete, batch_size=100, tries=2, sleep=lambda s: None)
    assert [r.id for r in labels.where("label = 'other'").collect()] == [57]
    assert labels.count() == 100


LINK = "id long, url string, anchor_text string, rel string, is_external boolean, pred_category string"


def test_equal_prompts_are_asked_once(spark):
    rows = [(i, f"https://s.example/p{i % 3}-p-1", "a", None, False, None) for i in range(60)]
    asked = spark.sparkContext.accumulator(0)

    def complete(system, prompts):
        asked.add(len(prompts))
        return ['{"label": "product"}'] * len(prompts)

    labels = label_residue(spark.createDataFrame(rows, LINK).repartition(5), complete, batch_size=7, sleep=lambda s: None)
    got = labels.collect()
    assert len(got) == 60 and {r.label for r in got} == {"product"} and asked.value == 3
    assert sorted(r.id for r in got if r.asked) == [0, 1, 2]
    assert {r.id: r.batch_no for r in got} == {i: i // 7 + 1 for i in range(60)}


def test_an_outage_fails_the_job_and_labels_nothing(spark):
    import pytest
    rows = [(i, f"https://s.example/{i}", "a", None, False, None) for i in range(40)]

    def complete(system, prompts):
        raise ConnectionError("down")

    with pytest.raises(Exception, match="got no answer"):
        label_residue(spark.createDataFrame(rows, LINK).coalesce(1), complete, tries=2, sleep=lambda s: None).collect()


def test_capped_passes_cover_the_residue_and_start_over(spark):
    import tempfile

    from linkloom.operators.relabel import read_cursor, relabel_pass
    rows = [(i, f"https://s.example/{i}", None, None, False, None if i % 2 else "other") for i in range(1, 21)]
    links, cursor = spark.createDataFrame(rows, LINK), tempfile.mkdtemp(prefix="linkloom-cursor-") + "/c"
    seen, left = [], []
    for _ in range(4):
        labels, report = relabel_pass(links, stub_complete, cursor, batch_size=4, max_batches=2, sleep=lambda s: None)
        seen.append(sorted(r.id for r in labels.collect()))
        links = apply_labels(links, labels)       # all answered "other": they stay in the residue
        left.append(report.first()["n_unasked"])
    assert seen == [list(range(1, 9)), list(range(9, 17)), [17, 18, 19, 20], list(range(1, 9))]
    assert left == [12, 4, 0, 12] and read_cursor(spark, cursor) == 8
    nothing = links.where("id < 0")
    assert relabel_pass(nothing, stub_complete, cursor, batch_size=4, max_batches=2, sleep=lambda s: None)[1].first()["n_rows"] == 0
