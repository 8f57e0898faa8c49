"""Sources and sinks: scans, adjustment files, appends, replacements, snapshots and reports."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerloom.functions.scalars import blank_to_null
from ledgerloom.sources.versions import SNAPSHOT_COL, SNAPSHOT_PARTITION, SnapshotLog  # noqa: F401



def scan(spark: SparkSession, directory: str, table: str, cols: Sequence[str] | None = None,
         pred: Column | None = None) -> DataFrame:
    """Parquet scan; the predicate and the column list reach the reader."""
    df = spark.read.parquet(f"{directory}/{table}.parquet")
    if pred is not None:
        df = df.where(pred)
    return df.select(*cols) if cols else df


def query(spark: SparkSession, text: str, views: Mapping[str, DataFrame]) -> DataFrame:
    """Run SQL text over named frames."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)


def jdbc_query(spark: SparkSession, url: str, text: str, properties: Mapping[str, str],
               split_on: str | None = None, bounds: tuple[int, int] | None = None,
               splits: int = 1) -> DataFrame:
    """Run a SQL text in a database; with ``split_on`` the result is read by parallel tasks."""
    reader = spark.read.format("jdbc").option("url", url).options(**properties)
    if split_on is None:
        return reader.option("query", text).load()
    low, high = bounds
    return (
        reader.option("dbtable", f"({text}) q").option("partitionColumn", split_on)
        .option("lowerBound", low).option("upperBound", high).option("numPartitions", splits).load()
    )


def named_view(name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Register a query under a name and return it as read through that name."""
    df = build()
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def normalise_headers(names: Sequence[str]) -> list[str]:
    """Lower-case headers; the separators ``' \\ '``, ``' / '``, blank and newline become ``_``."""
    out = []
    for name in names:
        name = name.lower()
        for separator in (" \\ ", " / ", " ", "\n"):
            name = name.replace(separator, "_")
        out.append(name)
    return out


def adjustment_frame(raw: DataFrame, key: str, n_cols: int | None = None) -> DataFrame:
    """Normalise a manual-adjustment frame: first columns, headers, blanks to null, rows with a key."""
    df = raw.select(*[F.col(f"`{c}`") for c in raw.columns[:n_cols]])
    df = df.toDF(*normalise_headers(df.columns))
    strings = {f.name: blank_to_null(f.name) for f in df.schema.fields if f.dataType.simpleString() == "string"}
    return df.withColumns(strings).where(F.col(key).isNotNull())


def ingest_adjustments(spark: SparkSession, path: str, key: str, n_cols: int | None = None,
                       fmt: str = "csv", schema: StructType | None = None, one_line: bool = False) -> DataFrame:
    """Manual adjustments from files. A CSV field may hold line ends, so one task reads a whole file; ``one_line`` says that none
    does, and a large file is then read by several tasks."""
    reader = spark.read.schema(schema) if schema else spark.read
    raw = reader.csv(path, header=True, multiLine=not one_line, escape='"') if fmt == "csv" else reader.format(fmt).load(path)
    return adjustment_frame(raw, key, n_cols)


def append(df: DataFrame, path: str) -> None:
    """Append by column name. A frame whose names or types differ from the target's is refused."""
    target = _existing(df.sparkSession, path)
    if target is not None:
        kinds = lambda frame: {f.name: f.dataType for f in frame.schema.fields}
        ours, theirs = kinds(df), kinds(target)
        wrong = sorted(c for c in {*ours, *theirs} if ours.get(c) != theirs.get(c))
        if wrong:
            raise ValueError(f"cannot append to {path}: names or types differ in {', '.join(wrong)}")
        df = df.select(*target.columns)
    df.write.mode("append").parquet(path)


def replace(df: DataFrame, path: str) -> None:
    """Full replacement of a plain folder of files: the frame is written beside the target and then takes its place.

    The frame may read its own target. For readers that know a plain folder only: between the two renames there is no target.
    :func:`ledgerloom.sources.versions.publish` has no such moment.
    """
    spark = df.sparkSession
    new, old = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}", f"{path.rstrip('/')}.old-{uuid.uuid4().hex}"
    df.write.parquet(new)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    store = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    there = store.exists(hadoop(path))
    for source, goal in ([(path, old)] if there else []) + [(new, path)]:
        if not store.rename(hadoop(source), hadoop(goal)):
            raise OSError(f"cannot rename {source} to {goal}")
    if there:
        store.delete(hadoop(old), True)
    spark.catalog.refreshByPath(path)


def snapshot_append(df: DataFrame, path: str, run_ts: datetime, stamp: str = SNAPSHOT_COL,
                    within: Sequence[str] = (), covers: Sequence[Sequence[str]] = ()) -> DataFrame:
    """Append with one load stamp for the whole write, and return the log.

    One folder per value of ``within`` (a channel) and stamp, so reading the newest load of a channel prunes all others. Writing a stamp
    again replaces its rows instead of doubling them, also those of channels without rows in the second run; see
    :class:`ledgerloom.sources.versions.SnapshotLog`, which also reads the newest load alone.
    """
    return SnapshotLog(df.sparkSession, path, within).append(df, run_ts, covers, stamp)


def report_frame(df: DataFrame) -> DataFrame:
    """All columns as text, null as empty text."""
    return df.select([F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])


def export_report(df: DataFrame, path: str) -> bool:
    """Full-refresh CSV export; an empty result clears the target and writes no data row."""
    text = report_frame(df)
    text.write.mode("overwrite").option("emptyValue", "").csv(path, header=True)
    return not df.sparkSession.read.csv(path, header=True).isEmpty()


def cutoff_delete(header: DataFrame, line: DataFrame, line_doc: str, header_doc: str, date_col: str,
                  cutoff) -> tuple[DataFrame, DataFrame]:
    """Drop documents dated on or after the cut-off, and their lines. Undated documents stay."""
    late = F.col(date_col) >= F.lit(cutoff)
    dropped = header.where(late).select(F.col(header_doc).alias(line_doc))
    kept = header.where(~late | F.col(date_col).isNull())
    return kept, line.join(dropped, line_doc, "left_anti")


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise
