"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

import random

import pytest

import corpus_pipeline
from linkloom.llm import (collision_dedup, decontamination, html_template, line_dedup, order_minhash, packing,
                          secret_scan, sharding, suffix_dedup, toxicity)
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, key long, shard string, __key string"


def odd_rows():
    rng = random.Random(3)
    long_text = "\n".join(" ".join(rng.choice("abcdefgh") * rng.randint(1, 6) for _ in range(40)) for _ in range(300))
    texts = [None, "", "one two", long_text, long_text, "\n\n  \n", "x" * 5000, "same words here again and again " * 40,
             'token = "0123456789abcdef0123456789abcdef01234567" ok', "one two", "éß 中文 \U0001f600 " * 30]
    rows = [(i, t, "en", None if i % 3 else "s", None, i, "x", "y") for i, t in enumerate(texts)]
    return [*rows, rows[2], (None, "text without an id", None, None, 1, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(0, 0, 0), (4, 1, 1), (4, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, None), (2, ""), (3, "one two"), (3, "one two")], "item_id long, text string")


@pytest.fixture(scope="module")
def tables(spark, labels, benchmark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    labels.write.parquet(f"{path}/labels.parquet")
    benchmark.write.parquet(f"{path}/benchmark.parquet")
    return path


def operators(docs, labels, benchmark):
    import public_tokenizers

    return {
        "sharding": sharding.reshard(docs, F.pmod(F.xxhash64("source"), F.lit(3)), 3, 4),
        "lines": line_dedup.dedup_lines(docs, report=False),
        "secrets": secret_scan.scan_documents(docs),
        "near": order_minhash.group_documents(docs),
        "toxicity": toxicity.score_documents(docs, labels),
        "suffixes": suffix_dedup.cut_repeats(docs),
        "packing": packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")),
        "leaks": decontamination.find_leaks(docs, benchmark),
    }


def test_odd_rows_pass_every_operator(odd, labels, benchmark):
    got = {k: v.collect() for k, v in operators(odd, labels, benchmark).items()}
    n = odd.count()
    for name in ("sharding", "lines", "secrets", "near", "toxicity", "suffixes"):
        assert len(got[name]) == n, name
    assert sorted(r["size"] for r in got["sharding"] if r["doc_id"] in (0, 1)) == [1, 1]
    text = {r["doc_id"]: r["text"] for r in got["lines"]}
    assert text[0] is None and text[1] == "" and text[3] == odd_rows()[3][1] and text[4] == ""
    near = [(r["doc_id"], r["group_id"], r["kept"]) for r in got["near"]]
    assert (4, 3, False) in near and (9, 2, False) in near and sorted(x for x in near if x[0] == 2) == [(2, 2, False), (2, 2, True)]
    assert (1, 0, False) in near  # null reads as empty
    cut = {r["doc_id"]: (r["n_bytes"], r["n_removed"]) for r in got["suffixes"]}
    assert cut[6] == (5000, 5000) and cut[3][0] == cut[3][1] == cut[4][1] and cut[2] == (7, 0)
    assert sum(r["length"] for r in got["packing"] if r["doc_id"] == 0) == 1
    assert {(r["doc_id"], r["item_id"]) for r in got["leaks"]} == {(2, 3), (9, 3)}
    assert [r["n_hex"] for r in got["secrets"] if r["doc_id"] == 8] == [1]


def test_empty_tables_give_empty_results(empty, labels, benchmark, spark):
    for name, frame in operators(empty, labels.limit(0), benchmark.limit(0)).items():
        assert frame.count() == 0, name
    assert collision_dedup.near_duplicate_vectors(
        spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    assert html_template.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_stages_keep_the_columns(odd, empty, tables, spark):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, tables)
            assert out.columns == docs.columns
            assert out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, tables).count() >= docs.count()


def test_odd_vectors(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1),
            (7, [nan, 1.0], 1), (8, [1.0, None], 1), (9, [1.0], 1), (10, [], 1), (11, [1.0, 0.0], 1), (12, [0.0, 1.0], 1),
            (13, [float("inf"), 0.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"])
           for r in collision_dedup.near_duplicate_vectors(frame.withColumn("block", F.lit("x"))).collect()}
    assert {k: v for k, v in got.items() if v[0]} == {1: (2, 1, True), 2: (2, 1, False), 11: (2, 1, False)}
    assert all(v == (0, k, True) for k, v in got.items() if k not in (1, 2, 11))


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "http://a.example/", ""), (3, "http://a.example/1", "<p>no frame"),
            (4, "http://b.example/1", "<body><nav>m</nav><article><h1>T &amp; x</h1><p>a<b>b</b> c<p>d<div class='ad'>buy</div>"
                                      "<script>x</script><section id=comments><p>hi</section></article><footer>f</footer><p"),
            (4, "http://b.example/1", "<body><div class=menu>m</div></x></y><p>t")]
    got = [(r["page_id"], r["text"]) for r in html_template.extract_main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1))).collect()]
    assert sorted(got) == [(1, ""), (2, ""), (3, "no frame"), (4, "T & x\nab c\nd"), (4, "t")]


@pytest.mark.parametrize("seed", range(3))
def test_banded_distance_equals_dynamic_programming(seed):
    rng = random.Random(seed)
    for _ in range(150):
        a = [rng.choice("abc") for _ in range(rng.randint(0, 30))]
        b = [x for x in a if rng.random() > 0.1] + [rng.choice("abc")] * rng.randint(0, 2)
        if rng.random() < 0.3:
            b = [rng.choice("abc") for _ in range(rng.randint(0, 30))]
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        want = 1 - row[-1] / max(len(a), len(b), 1)
        for least in (0.8, 0.5, 0.2):
            got = order_minhash.edit_similarity(a, b, least)
            assert got == pytest.approx(want if want >= least - 1e-9 else 0.0), (a, b)


def test_min_cost_flow_moves_least():
    flow = sharding.plan_transfers([50, 10, 0], [20, 20, 20])
    assert flow == [[20, 10, 20], [0, 10, 0], [0, 0, 0]]
    with pytest.raises(ValueError):
        sharding.plan_transfers([5], [4])
