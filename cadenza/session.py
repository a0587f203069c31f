"""Session construction and the shared checkpoint folder.

On a cluster the checkpoint folder comes from ``spark.checkpoint.dir`` (a
shared filesystem the cluster names).  Only a local-mode session without that
setting (tests, bench) gets a private scratch folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
    # delete reliable-checkpoint files once their DataFrames are garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", app: str = "cadenza", conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in {**LOCAL_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when unset.

    Order: the context's folder, then ``spark.checkpoint.dir`` from the
    session conf, then — local mode only — a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on the cluster")
    path = tempfile.mkdtemp(prefix="cadenza-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def checkpoint_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (stream state, staged tables)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def run_concurrently(tasks, parallelism: int = 8) -> list:
    """Run independent driver-side fits as concurrent Spark jobs (the way
    ``CrossValidator(parallelism=…)`` does): small fits do not fill the
    cluster alone.  Results keep the order of ``tasks``."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(lambda f: f(), tasks))


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared checkpoint folder, read again from
    there: survives executor loss as a reliable checkpoint does, but is stored
    by column and compressed, and a reader takes only the columns it needs."""
    path = checkpoint_dir(df.sparkSession, "cut")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
