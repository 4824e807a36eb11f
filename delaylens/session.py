"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_local_roots: dict[str, str] = {}


def get_session(app: str = "delaylens", cores: str | int = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench. On a cluster the session comes
    from spark-submit; no operator here depends on these settings."""
    builder = (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        # a call site per column costs more than the rest of building a plan
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """The one session setting the jobs rely on: naive timestamps are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the one the cluster names in spark.checkpoint.dir.

    Only a local-mode session without that setting gets a temporary folder of
    its own; a cluster without it is an error, because executors could not see
    the driver's disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        app = spark.sparkContext.applicationId
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="delaylens-")
        root = _local_roots[app]
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: for a result that
    several later steps read and that is costly to work out again."""
    path = shared_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Clears a folder of `shared_dir` that no later step reads."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give the context a checkpoint folder if none is set, so long iterative
    lineages (boosting) can be cut and survive a lost executor."""
    jsc = spark.sparkContext._jsc.sc()
    if not jsc.getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(os.path.join(shared_dir(spark, "checkpoints")))
