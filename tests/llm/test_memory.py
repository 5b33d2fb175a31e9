"""What a task holds at once is bounded, whatever it is given."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkloom.llm import common, order_minhash, suffix_dedup


@pytest.mark.parametrize("own", ["64MB", "1MB", "1000000"])
def test_written_steps_read_texts_in_small_batches(spark, own):
    before = spark.conf.get(common.BATCH_CONF)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    texts = spark.range(0, 6000, 1, 1).select(F.repeat(F.lit("x"), 4000).alias("text"))
    try:
        spark.conf.set(common.BATCH_CONF, own)
        n = [r["n"] for r in common.materialize(texts.mapInArrow(sizes, "n long"), "sizes").collect()]
        assert sum(n) == 6000 and max(n) * 4000 <= common.BATCH_BYTES + 4000
        with pytest.raises(ZeroDivisionError):
            with common.small_batches(spark):
                1 / 0
        assert spark.conf.get(common.BATCH_CONF).removesuffix("b") in (own, str(64 << 20), str(1 << 20))  # as it was
    finally:
        spark.conf.set(common.BATCH_CONF, before)


def test_contexts_of_one_lead_are_hashed_some_at_a_time():
    rng = random.Random(3)
    lead, n = rng.randbytes(200), 2000
    texts = [rng.randbytes(200) + lead + rng.randbytes(200) for _ in range(n)]
    texts[7] = texts[1990]
    table = pa.table({"doc_id": pa.array(range(n)), "key": pa.array(range(n)), "place": pa.array([200] * n, pa.int32()),
                      "lead": pa.array([5] * n), "salt": pa.array([0] * n, pa.int32()), "split": pa.array([False] * n),
                      "before": pa.array([200] * n, pa.int32()), "bytes": pa.array(texts, pa.binary())})
    powers = suffix_dedup.Powers()
    got = suffix_dedup.compare_runs(table, powers).to_pylist()
    assert [(r["doc_id"], r["start"], r["stop"]) for r in got] == [(7, 0, 600), (1990, 0, 600)]
    assert powers.n <= 1 << 18  # of 1200000 bytes


def test_picks_of_a_long_text_are_made_some_at_a_time(monkeypatch):
    kmers = np.random.default_rng(4).integers(0, 1 << 63, 60000, dtype=np.uint64)
    tracemalloc.start()
    got = order_minhash.order_minhash(kmers)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24e6
    monkeypatch.setattr(order_minhash, "_CELLS", 1 << 40)
    assert (got == order_minhash.order_minhash(kmers)).all()
