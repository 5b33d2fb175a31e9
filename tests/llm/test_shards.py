"""Resharding rewrites files: every document is in them once, whole, when shards are added and when they go."""

import os

from linkloom.llm import sharding
from pyspark.sql import functions as F

KEEP = ["doc_id", "text", "shard"]


def test_files_hold_every_document_once_after_growth_and_shrink(spark, tmp_path):
    texts = [(i, None if i == 7 else f"text {i} " * (i % 40), "a column of the documents") for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, shard string")
    path = str(tmp_path / "shards")
    rows = sharding.reshard(docs, F.pmod("doc_id", F.lit(4)), 4, 6)
    assert sharding.rewrite_affected(rows, path) == list(range(6))
    for old, new in ((6, 6), (6, 9), (9, 3)):
        stored = sharding.read_shards(rows, path)
        before = {n: sorted(os.listdir(f"{path}/shard={n}")) for n in range(old)}
        flat = stored.select("doc.doc_id", "doc.text", F.col("doc.shard"), F.col("shard").alias("lies_in"))
        rows = sharding.reshard(flat, F.col("lies_in"), old, new, keep=KEEP)
        affected = sharding.rewrite_affected(rows, path)
        got = sharding.read_shards(rows, path).collect()
        assert sorted(tuple(r["doc"]) for r in got) == sorted(texts), (old, new)
        assert sorted(d for d in os.listdir(path) if "=" in d) == [f"shard={n}" for n in range(new)]
        held = {n: [r for r in got if r["shard"] == n] for n in range(new)}
        assert all(sorted(r["slot"] for r in rs) == list(range(len(rs))) for rs in held.values())
        for n in set(range(min(old, new))) - set(affected):
            assert sorted(os.listdir(f"{path}/shard={n}")) == before[n]
