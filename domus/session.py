"""Session construction and cluster-level helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every domus job relies on.  AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions; UTC
# keeps date arithmetic identical on every executor.
_BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # checkpoints go with the frames that read them
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(
    app: str = "domus",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Return (or create) a session with the settings domus expects.

    On a cluster, leave ``master`` and ``shuffle_partitions`` unset so the
    submit-time configuration wins.  Locally pass ``master="local[8]"`` and a
    partition count close to the core count.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only in local mode without the setting (tests) a private folder under the
    system temp directory is used; on a cluster the setting is required.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="domus-ckpt-")
    sc.setCheckpointDir(local)
    return local


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably in the shared checkpoint folder.

    Used inside iterative loops (elimination, permutation repeats, range
    indexing) so a lost executor re-reads the checkpoint instead of replaying
    a long lineage.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder as Parquet and read
    back: for narrow rows that many jobs read, where a checkpoint (whole rows,
    uncompressed, no column pruning) would take several times the disk."""
    path = f"{checkpoint_dir(df.sparkSession)}/rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove an own scratch folder that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
