"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.session import fresh_path


def texts(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The columns an operator reads, doc_id and text, and those it is to carry along; the rest stays behind, so that
    other columns may have any name."""
    carried = [F.col(f"`{c}`") for c in keep if c not in ("doc_id", "text")]
    return df.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), *carried)


def ddl(df: DataFrame, names: Sequence[str]) -> str:
    """Schema text of some columns of a frame."""
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, which may run where it is not installed; once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root, packed = Path(__file__).resolve().parents[1], io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    path = f"{fresh_path(spark, 'package')}/{root.name}.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    stream.write(packed.getvalue())
    stream.close()
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """Apply a function to the Arrow batches of each partition."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_groups(df: DataFrame, key: str, run: Callable, schema) -> DataFrame:
    """Apply a function to each group as one Arrow table; callers keep groups bounded."""
    ship(df.sparkSession)
    return df.groupBy(key).applyInArrow(run, schema)


# Tables written since a driver asked for a record of them; None while nobody does.
_scratch: list[str] | None = None


def release(spark: SparkSession, last: bool = False) -> None:
    """Delete what `stored` has written since the call before, and go on recording unless it is the last call.

    For a driver whose results up to here are all written elsewhere.
    """
    global _scratch
    for name in _scratch or ():
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _scratch = None if last else []


def stored(df: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = fresh_path(df.sparkSession, label)
    if _scratch is not None:
        _scratch.append(path)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_batch(**columns) -> pa.RecordBatch:
    """Record batch of arrays in the given order."""
    arrays = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns.values()]
    arrays = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in arrays]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))
