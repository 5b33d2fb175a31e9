"""Training-corpus pipeline over ``documents``: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkloom.llm import decontamination, line_dedup, order_minhash, packing, toxicity
from linkloom.session import scratch_path


def reject_toxic(spark, docs, sf_dir):
    """Documents the classifier does not call toxic."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))


def drop_repeated_lines(spark, docs, sf_dir):
    """Documents without later copies of repeated runs of lines; n_chars follows the text."""
    kept = line_dedup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_copies(spark, docs, sf_dir):
    """One document of each group of near copies."""
    return order_minhash.drop_near_duplicates(docs)


def drop_benchmark_leaks(spark, docs, sf_dir):
    """Documents that hold no test item."""
    return decontamination.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def pack_sequences(spark, docs, sf_dir):
    """Pieces of the documents packed into sequences."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", reject_toxic), ("line dedup", drop_repeated_lines), ("near dedup", drop_near_copies),
          ("decontamination", drop_benchmark_leaks), ("packing", pack_sequences)]

# SQL has no counterpart of the classifier, the sketches, the alignment or the tokeniser; tests use brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
