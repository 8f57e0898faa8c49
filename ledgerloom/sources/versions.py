"""Tables that a dying job cannot break: immutable data folders, and a manifest that says which of them count.

A write puts its rows into a folder of its own and is then made valid by one small file, ``_manifest/<n>.json``, the complete
state after the n-th write. The file is written beside its place and renamed to it without overwriting. So a job that dies at any step leaves
the state before or after its write; of two jobs that finish at the same time the second reads the first one's state and tries again. Readers
look at the manifest alone, a short list of files however long the history is, and read the folders that it names.

Two kinds of tables use it. :func:`publish` replaces the rows of a table, :func:`current` reads them. A snapshot log (:class:`SnapshotLog`) keeps
all loads; each names its stamp and its partitions, so the newest load of a channel is known without listing any folder.
Folders that no state names any more are left to :func:`vacuum`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerloom.session import STAGE_CODEC, shuffles_freed

SNAPSHOT_COL = "data_updated_time"
SNAPSHOT_PARTITION = "load_stamp"
KEPT_STATES = 10
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class Manifest:
    """The numbered states of a table, on any file system that the session knows."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table = spark, table.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        conf = spark._jsc.hadoopConfiguration()
        self._store = self._path(self.table).getFileSystem(conf)
        self._context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._store.getUri(), conf)
        self._folder = self._path(f"{self.table}/_manifest")

    def _numbers(self) -> list[int]:
        if not self._store.exists(self._folder):
            return []
        names = [f.getPath().getName() for f in self._store.listStatus(self._folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self) -> tuple[int, dict]:
        """Number and content of the newest state; 0 and nothing for a table that was never written."""
        while numbers := self._numbers():
            try:
                stream = self._store.open(self._path(f"{self.table}/_manifest/{numbers[-1]:012d}.json"))
            except Exception as error:
                # cleared by a writer since it was listed: newer states are there
                if "FileNotFound" in str(error) and self._numbers() != numbers:
                    continue
                raise
            try:
                return numbers[-1], json.loads(bytes(stream.readAllBytes()).decode())
            finally:
                stream.close()
        return 0, {}

    def commit(self, change: Callable[[dict], dict]) -> dict:
        """Apply ``change`` to the newest state. If another writer was faster, to that one's."""
        for _ in range(100):
            number, state = self.read()
            state = change(state)
            if self._put(number + 1, state):
                for old in self._numbers()[:-KEPT_STATES]:
                    self._store.delete(self._path(f"{self.table}/_manifest/{old:012d}.json"), False)
                return state
        raise RuntimeError(f"{self.table}: other writers were faster 100 times")

    def _put(self, number: int, state: dict) -> bool:
        draft = self._path(f"{self.table}/_manifest/.draft-{uuid.uuid4().hex}")
        self._store.mkdirs(self._folder)
        stream = self._store.create(draft, False)
        stream.write(bytearray(json.dumps(state).encode()))
        stream.close()
        options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            self._context.rename(draft, self._path(f"{self.table}/_manifest/{number:012d}.json"), options)
            return True
        except Exception as error:
            self._store.delete(draft, False)
            if "FileAlreadyExists" in str(error):
                return False
            raise

    def folders(self) -> list[str]:
        """Data folders that lie below the table."""
        if not self._store.exists(self._path(self.table)):
            return []
        return [f.getPath().getName() for f in self._store.listStatus(self._path(self.table)) if not f.getPath().getName().startswith(("_", "."))]

    def partitions(self, folder: str, depth: int) -> list[list[str]]:
        """Values of the first ``depth`` partition columns of a written folder."""
        found = [([], self._path(f"{self.table}/{folder}"))]
        for _ in range(depth):
            found = [([*values, unquote(status.getPath().getName().partition("=")[2])], status.getPath())
                     for values, path in found if self._store.exists(path)
                     for status in self._store.listStatus(path) if status.isDirectory() and "=" in status.getPath().getName()]
        return sorted(values for values, _ in found)

    def delete(self, folder: str) -> None:
        self._store.delete(self._path(f"{self.table}/{folder}"), True)


def publish(df: DataFrame, table: str) -> DataFrame:
    """Replace the rows of a table; the frame may read the table itself."""
    spark, folder = df.sparkSession, f"v-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.parquet(f"{table.rstrip('/')}/{folder}")
    Manifest(spark, table).commit(lambda state: {"folder": folder, "schema": df.schema.json()})
    return current(spark, table)


def current(spark: SparkSession, table: str) -> DataFrame | None:
    """The rows of a published table, None if it was never published."""
    _, state = Manifest(spark, table).read()
    if not state:
        return None
    schema = StructType.fromJson(json.loads(state["schema"]))
    return spark.read.schema(schema).parquet(f"{table.rstrip('/')}/{state['folder']}")


def vacuum(spark: SparkSession, table: str) -> list[str]:
    """Delete the data folders that the newest state doesn't name. Call it when no job writes or reads the table."""
    manifest = Manifest(spark, table)
    _, state = manifest.read()
    named = {state.get("folder"), *[f"load={load['id']}" for load in state.get("loads", [])]}
    strays = [f for f in manifest.folders() if f not in named]
    for folder in strays:
        manifest.delete(folder)
    return strays


class SnapshotLog:
    """A log of loads. A load has one stamp and one folder, with a partition for each value of ``within`` (a channel)."""

    def __init__(self, spark: SparkSession, path: str, within: Sequence[str] = ()):
        self.spark, self.path, self.within = spark, path.rstrip("/"), list(within)
        self.manifest = Manifest(spark, path)

    def append(self, df: DataFrame, run_ts: datetime, covers: Sequence[Sequence[str]] = (), stamp: str = SNAPSHOT_COL) -> DataFrame:
        """Add a load and return the log.

        A load takes the place of the loads with the same stamp that share a partition with it, whole: it is their second run, so what it
        has no rows of is gone. ``covers`` lists further partitions that the job speaks for (one value for each column of
        ``within``), so that a run without any row of them replaces theirs, too. Jobs for other channels may use the same stamp.
        """
        load, name = uuid.uuid4().hex, run_ts.strftime("%Y%m%d%H%M%S%f")
        stamped = df.withColumn(stamp, F.lit(run_ts)).withColumn(SNAPSHOT_PARTITION, F.lit(name))
        with shuffles_freed(self.spark):
            stamped.write.partitionBy(*self.within, SNAPSHOT_PARTITION).option("compression", STAGE_CODEC).parquet(f"{self.path}/load={load}")
        parts = [values[:-1] for values in self.manifest.partitions(f"load={load}", len(self.within) + 1)]
        # without partitions a load speaks for everything under its stamp
        spoken_for = [list(map(str, c)) for c in covers] + parts if self.within else [[]]

        def change(state: dict) -> dict:
            kept = [old for old in state.get("loads", []) if old["stamp"] != name or not any(p in spoken_for for p in old["covers"])]
            new = {"id": load, "stamp": name, "parts": parts, "covers": spoken_for}
            schema = stamped.schema.json()
            return {"loads": sorted([*kept, new], key=lambda entry: entry["stamp"]), "schema": schema}

        self.manifest.commit(change)
        return self.read()

    def read(self) -> DataFrame:
        """All rows of all valid loads."""
        _, state = self.manifest.read()
        return self._frame(state, state.get("loads", []))

    def newest(self, *partitions: Sequence[str | None]) -> DataFrame:
        """The newest load that has rows of the given partitions (of any, if none is given), whole: what else was written in one go with
        them is there as well. Only its folder is touched."""
        _, state = self.manifest.read()
        wanted = [[NULL_PARTITION if v is None else str(v) for v in p] for p in partitions]
        fitting = [load for load in state.get("loads", []) if any(p in load["parts"] for p in wanted) or not wanted and load["parts"]]
        return self._frame(state, [load for load in fitting if load["stamp"] == fitting[-1]["stamp"]] if fitting else [])

    def _frame(self, state: dict, loads: list[dict]) -> DataFrame:
        schema = StructType.fromJson(json.loads(state["schema"])) if state else StructType()
        folders = [f"{self.path}/load={load['id']}" for load in loads if load["parts"]]
        if not folders:
            return self.spark.createDataFrame([], schema)
        # the given schema keeps codes in folder names from being read as numbers
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*folders).select(*schema.names)
