"""Session settings, shared working folders and size measurement."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Above this many bytes no side of a join is broadcast by hand; Spark's own choice stands.
BROADCAST_LIMIT = 128 * 1024 * 1024


def local_session(app: str = "tidegate", cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks; a cluster brings its own settings."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> None:
    """Session settings the operators rely on, unless the session has its own.

    * Scans get a fixed lower bound of splits. Spark derives it from the executors alive at planning time,
      so two scans of a file could be split differently while executors come and go; line numbers rely on
      equal splits.
    * Generated methods stay below the size HotSpot compiles. A larger one (many ruled columns in one stage)
      would be interpreted, several times slower; Spark then splits the code by expression instead.
    * A task that writes rows of one or two days keeps a file open for each and sorts only what comes beyond these. Spark sorts
      all rows of a task by day otherwise, in memory that grows with them.
    """
    wanted = {"spark.sql.files.minPartitionNum": (None, str(spark.sparkContext.defaultParallelism)),
              "spark.sql.codegen.hugeMethodLimit": ("65535", "8000"),
              "spark.sql.maxConcurrentOutputFileWriters": ("0", "2")}
    for name, (default, value) in wanted.items():
        if spark.conf.get(name, None) in (None, default):
            spark.conf.set(name, value)


def work_dir(spark: SparkSession) -> str:
    """Shared folder named by the cluster; a temporary one only in local mode."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    named = named or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidegate-"))
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the working folder that no earlier run has used."""
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


# Folders that the innermost open scratch has to delete; None outside of any.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, so that later passes do not recompute it."""
    path = fresh_path(df.sparkSession, label)
    if _made.get() is not None:
        _made.get().append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what has been staged meanwhile; for work whose results are written elsewhere by then."""
    token = _made.set([])
    try:
        yield
    finally:
        paths = _made.get()
        _made.reset(token)
        for name in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def lasting(df: DataFrame, label: str) -> DataFrame:
    """A staged frame that outlives the open scratch."""
    token = _made.set(None)
    try:
        return staged(df, label)
    finally:
        _made.reset(token)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Meanwhile shuffle files are removed as soon as the write that made them ends, not when the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def row_bytes(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Upper estimate of a row's size in memory: the length of its text plus a fixed share per column."""
    names = set(columns or df.columns)
    fields = [f for f in df.schema.fields if f.name in names]
    total = F.lit(16 * (len(fields) + 1)).cast("long")
    for field in fields:
        name = "`" + field.name.replace("`", "``") + "`"
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(name), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0))
    return total


def measured_bytes(df: DataFrame, columns: Sequence[str] | None = None) -> int:
    """Size of a frame by one aggregation over it."""
    return df.agg(F.coalesce(F.sum(row_bytes(df, columns)), F.lit(0)).alias("n")).first()["n"]


def broadcast_if_small(df: DataFrame, size: int | None, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Broadcast hint for a side of measured size; without a measurement Spark decides."""
    return F.broadcast(df) if size is not None and size <= limit else df


def sized(df: DataFrame) -> DataFrame:
    """Measure a stored frame and hint a broadcast when it is small enough."""
    return broadcast_if_small(df, measured_bytes(df))
