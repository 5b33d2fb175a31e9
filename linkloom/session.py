"""Session and shared-folder helpers.

The library never picks a machine-local folder on a cluster: lineage cuts,
streaming checkpoints and scratch tables live under the folder the cluster
names in ``spark.checkpoint.dir``.  Only a local-mode session (tests, the
bench) gets a fresh temporary folder when that setting is absent.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings this workload relies on.  Anchor extraction ships whole
# HTML documents to Python workers; Arrow batches are bounded by bytes
# (``spark.sql.execution.arrow.maxBytesPerBatch``, 64 MB by default), so a
# batch of large pages stays bounded without a row-count setting.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoints go once nothing refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", app: str = "linkloom",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and scratch tables.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir).  When
    neither is set and the master is local, a fresh temporary folder is set
    as the checkpoint dir; on a cluster that is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not (sc.master == "local" or sc.master.startswith("local[")):  # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="linkloom-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder."""
    base = shared_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}") if "://" not in base \
        else f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def reliable_checkpoint(df):
    """Cut lineage with a reliable checkpoint in the shared folder (never local)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists (any Hadoop file system)."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (any Hadoop file system); none if there is no such folder."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [st.getPath().getName() for st in fs.listStatus(jpath)] if fs.exists(jpath) else []


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote (any Hadoop file system)."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def recommended_conf(input_bytes: int, total_cores: int, html_heavy: bool = True) -> dict[str, str]:
    """Partition sizing for a run over ``input_bytes`` of Parquet on ``total_cores``.

    * Input splits: 128 MB, or 64 MB for HTML-heavy page tables (the parser
      holds a batch of decoded pages in Python, several times the Parquet
      size), and never fewer splits than cores.
    * Shuffle partitions: enough for ~200 MB per partition of shuffled data
      (links are a few percent of the page bytes; 10 % is assumed) and at
      least 3 per core; AQE then coalesces small ones to the advisory size
      and splits skewed ones.
    """
    split = (64 if html_heavy else 128) * 1024 * 1024
    split = max(4 * 1024 * 1024, min(split, input_bytes // max(total_cores, 1) or split))
    shuffled = input_bytes // 10
    partitions = max(3 * total_cores, shuffled // (200 * 1024 * 1024))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
