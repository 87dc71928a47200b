"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Dates and epoch seconds are read in UTC.
REQUIRED = {"spark.sql.session.timeZone": "UTC"}

# Set for a session made here; in any other they are the cluster's choice.
DEFAULTS = {
    # Skew join and partition coalescing need AQE.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a hot key of a join even where its output feeds a grouping on the
    # same key and the split costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles a method above 8000 bytes of bytecode, so a fused
    # stage beyond that runs interpreted; split projections are faster then.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.compression.codec": "zstd",
    # Call-site capture costs a stack walk per Column call and changes no result.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required settings to a running session and return it."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("vitalgrid")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    )
    for key, value in {**DEFAULTS, **REQUIRED}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """Make sure the session has a checkpoint folder, and return it.

    A cluster must name a shared one in ``spark.checkpoint.dir``; only a session in
    one process, as in tests, falls back to a folder on this machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    context.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame) -> tuple[DataFrame, str]:
    """The rows written once to the checkpoint folder and read back, and where.

    Cuts the lineage like a checkpoint, survives lost executors the same way,
    but computes the rows a single time and keeps them columnar.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/rows_{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path
