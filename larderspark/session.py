"""Session helpers: a local session for tests, scratch space, lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "larderspark", **conf: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(conf.pop("shuffle_partitions", cpus)))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LARDER_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    (tests, a laptop) a temporary folder is made and set for the session.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    current = context.getCheckpointDir()
    if configured:
        if current is None:
            context.setCheckpointDir(configured)
        return configured
    if current is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="larder-checkpoint-"))
        current = context.getCheckpointDir()
    return current


def scratch_root(spark: SparkSession) -> str:
    """This application's part of the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/larder-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in this application's scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all stored stages of this application: call it when its results are written.

    Frames that come from them can no longer be computed.
    """
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    It is computed once, survives lost executors, and every later branch reads
    only the columns it needs, with sizes the optimizer knows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
