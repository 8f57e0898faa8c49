"""Helpers shared by the operators: row numbers of written stages, bounded bitmaps, batch settings."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.session import new_stage_path

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts can be long: hand them to Python in batches of few rows."""
    if int(spark.conf.get(BATCH_ROWS, "10000")) > rows:
        spark.conf.set(BATCH_ROWS, str(rows))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a stage to the shared folder and read it back: its rows are then fixed, also when
    executors are lost and tasks run again."""
    path = new_stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_numbers() -> Iterator[int]:
    """Numbers unique over all tasks of a stage; to be fixed by writing the stage."""
    return itertools.count(TaskContext.get().partitionId() << 33)


def map_texts(df: DataFrame, per_batch: Callable[[pa.RecordBatch], Iterable[dict]], schema: str) -> DataFrame:
    """Run ``per_batch`` over Arrow batches; it yields dictionaries of columns."""
    small_batches(df.sparkSession)
    empty = df.sparkSession.createDataFrame([], schema)
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(empty.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for out in per_batch(batch):
                    yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


class Bitmap:
    """A set filter of fixed size: 2**bits bits whatever the number of members.

    It never misses a member; it lets some others through, more of them the more members it has,
    so a join must follow. It is built by Spark and reaches the driver as at most 2**(bits - 6)
    long values.
    """

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    @classmethod
    def of(cls, df: DataFrame, value: str, bits: int = 24) -> Bitmap:
        slot = F.shiftrightunsigned(F.col(value), 64 - bits)
        rows = (df.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("w"))
                .agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("b")).collect())
        words = np.zeros(1 << (bits - 6), dtype=np.uint64)
        for w, b in rows:
            words[w] = np.uint64(b & 0xFFFFFFFFFFFFFFFF)
        return cls(words, bits)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes >> np.uint64(64 - self.bits)
        return (self.words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) != 0


def ragged(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from flat values and list lengths."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(name: str, taken: Iterable[str]) -> str:
    """A column name that none of the given columns has, whatever its case."""
    taken = {c.lower() for c in taken}
    while name.lower() in taken:
        name += "_"
    return name


def as_is(df: DataFrame) -> dict[str, Column]:
    """All columns of a frame by name."""
    return {c: F.col(f"`{c}`") for c in df.columns}


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """The frame with a column that is different in every row and the same whenever the frame is read, and its name.

    Rows of files are named by file and place. Other frames are written first.
    """
    name = fresh("row_name", df.columns)
    try:
        place = F.concat_ws("-", F.hex(F.xxhash64(F.col("_metadata.file_path"))), F.col("_metadata.row_index"))
        return df.withColumn(name, place), name
    except AnalysisException:
        return written(df.withColumn(name, F.monotonically_increasing_id().cast("string")), "numbered"), name
