"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the plans are written for. AQE coalesces small shuffles, splits skewed join partitions and turns a
# join into a broadcast once the measured side is below the threshold.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    # The cleaning projections are wide. The JVM never compiles a method beyond 8000 bytes of bytecode, so a stage
    # that would need one runs several times faster with one generated method per operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
# Those of them that matter for speed only and may be set on a running session.
RUNTIME = ("spark.sql.adaptive.forceOptimizeSkewedJoin", "spark.sql.codegen.hugeMethodLimit")


def build_session(app: str = "garimpo", cpus: int | None = None, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster pass SETTINGS to spark-submit instead."""
    cpus = cpus or os.cpu_count() or 8
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Give a session made elsewhere the settings it may still take, unless it was started with its own.

    A local session (tests, benchmarks) without `spark.checkpoint.dir` gets a folder of its own, removed when the process
    ends; on a cluster the folder must be named, see `shared_dir`. Python workers are told where this library is.
    """
    context = spark.sparkContext
    for key in RUNTIME:
        if context.getConf().get(key) is None:
            spark.conf.set(key, SETTINGS[key])
    if context.master.startswith("local[") and not _named(spark):
        folder = tempfile.mkdtemp(prefix="garimpo-")
        context.setCheckpointDir(folder)
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = context.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        context.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _named(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as `spark.checkpoint.dir` or the session's checkpoint folder names it."""
    folder = _named(spark)
    if not folder:
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for a table that cuts lineage."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """Write the frame as a table of the shared folder and go on from there.

    A lost executor then costs no recomputation, and the planner knows the size and may prune columns.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
