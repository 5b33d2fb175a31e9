"""The pipeline as a whole, every stage against brute force on what the stage before it kept."""

import collections
import zlib

import duckdb
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from linkloom.llm import decontamination, order_minhash, queries, toxicity, words

SF = "/root/testdata/sf0.001"


def test_run_equals_brute_force_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept[-1], SF)
        assert out.columns == columns
        kept.append(spark.createDataFrame(out.toPandas(), docs.schema))
    tables = [{r["doc_id"]: r["text"] for r in k.collect()} for k in kept]

    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    scores = {r["doc_id"]: r["predicted"] for r in toxicity.score_documents(kept[0].select("doc_id", "text"), labels).collect()}
    assert tables[1] == {d: t for d, t in tables[0].items() if not scores[d]}

    con = duckdb.connect()
    documents = kept[1].toPandas()
    con.register("documents", documents)
    want = {d: t for d, t, *_ in con.execute(queries.ORACLE_SQL["op2_line_dedup"]).fetchall()}
    assert tables[2] == want and all(r["n_chars"] == len(r["text"] or "") for r in kept[2].collect())

    ws = {d: words.words(t) for d, t in tables[2].items()}
    root = {d: d for d in ws}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(ws)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if tables[2][a] == tables[2][b] or ws[a] and ws[b] and order_minhash.edit_similarity(ws[a], ws[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert set(tables[3]) == {d for d in ids if find(d) == d} and len(tables[3]) < len(ids)

    number = collections.defaultdict(lambda: len(number))
    code = lambda t: np.array([number[w] for w in words.words(t)])
    items = [code(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {d for d, t in tables[3].items() if words.words(t)
              and any(decontamination.align(i, code(t))[0] >= 0.8 * 2 * len(i) - 1e-9 for i in items if len(i))}
    assert set(tables[4]) == set(tables[3]) - leaked and all(tables[4][d] == tables[3][d] for d in tables[4])

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    cover, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in corpus_pipeline.run(spark, SF).collect():
        cover[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(cover) == set(tables[4])
    for d, pieces in cover.items():
        own = np.array([*tokenizer.encode(tables[4][d] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        at = 0
        for start, length, crc in sorted(pieces):
            assert start == at and crc == zlib.crc32(own[start:start + length].tobytes())
            at += length
        assert at == len(own)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
