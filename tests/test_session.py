from linkloom.session import recommended_conf


def test_sizing_grows_with_input():
    tb = 1024 ** 4
    small = recommended_conf(10 * 1024 ** 3, 64)
    big = recommended_conf(100 * tb, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) > int(small["spark.sql.shuffle.partitions"])
    assert int(big["spark.sql.shuffle.partitions"]) >= 3 * 8000
    # 100 TB / 10 shuffled / 200 MB per partition
    assert int(big["spark.sql.shuffle.partitions"]) == (100 * tb // 10) // (200 * 1024 ** 2)
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 64 * 1024 ** 2
    # a small input is still split across all cores
    assert int(small["spark.sql.files.maxPartitionBytes"]) <= 10 * 1024 ** 3 // 64


def test_scratch_and_checkpoints_use_the_shared_folder(spark):
    from linkloom.session import reliable_checkpoint, scratch_path, shared_dir
    base = shared_dir(spark)
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    # Spark puts checkpoints in a unique folder under the configured one
    assert configured and configured.rstrip("/") in base
    p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p1 != p2 and p1.startswith(base)
    df = reliable_checkpoint(spark.range(10))
    assert df.count() == 10
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "LocalCheckpoint" not in plan
