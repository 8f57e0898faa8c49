"""Session settings and the shared folder used for lineage cuts and written stages."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

# Runtime SQL settings the plans rely on; all may be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join input even when that costs one more exchange downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

# What a task reads from a shuffle is compressed: sorted rows take up to 25 times as much memory, so the default of 64 MB
# lets a task grow to 1.6 GB. A session that asks for less keeps it.
MOST_READ = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 64 << 20,
}


def build_session(app: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    for key, most in MOST_READ.items():
        if _bytes(spark, spark.conf.get(key)) > most:
            spark.conf.set(key, f"{most}b")
    return spark


def _bytes(spark: SparkSession, size: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def shared_dir(spark: SparkSession) -> str:
    """A folder every executor can reach: ``spark.checkpoint.dir`` of the session. A session of one machine may go without it and
    gets a folder in its warehouse; on a cluster that could be a folder of one machine, so it has to be named there."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages"


def new_stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for a written stage."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# written stages are read by the same job: the better packing costs less than the disk and the reads it saves
STAGE_CODEC = "zstd"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes in this block delete the shuffle files of their own query when they end.

    Spark keeps them until the driver happens to collect garbage, so a job of several stages would hold the files of all of them. What
    was written is read from its folder from then on, so nothing asks for them again. Other queries of the session keep their setting.
    """
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def cut_lineage(df: DataFrame, name: str = "stage", path: str | None = None) -> DataFrame:
    """Write a stage to the shared folder (or to ``path``, for a caller that clears it later) and read it back.

    The rows are fixed and survive the loss of executors; as columnar files they can be read by
    later branches one column at a time. Columns without a type are stored as text.
    """
    path = path or new_stage_path(df.sparkSession, name)
    void = [f.name for f in df.schema.fields if f.dataType.simpleString() == "void"]
    df = df.withColumns({c: F.col(c).cast("string") for c in void})
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", STAGE_CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
