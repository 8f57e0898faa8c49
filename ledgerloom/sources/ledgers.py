"""Ledgers that are asked "is this key posted?" every day, laid out by key so that the answer doesn't move the history.

Beside its rows a ledger keeps an index: the distinct keys, bucketed and sorted by key. An anti or semi join of the day's
rows with it shuffles the day's rows alone; the index is read in place, bucket by bucket. As the index has each key once, no
bucket is larger because a key has many rows. An append adds a small index of its keys beside the others; all have the same buckets, so the
day's rows are shuffled once however many there are, and :meth:`KeyedLedger.compact` makes them one again. Rows and indexes
become valid by one manifest (see :mod:`ledgerloom.sources.versions`), which also knows how many rows and null keys there are, as
``NOT IN`` needs it.

A null key is not part of the index: it equals nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerloom.sources.versions import Manifest


class KeyedLedger:
    """Rows with a key. ``buckets`` counts when the ledger is first written: size it for the index, not for a day."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 200):
        self.spark, self.path, self.key, self._buckets = spark, path.rstrip("/"), key, buckets
        self.manifest = Manifest(spark, path)

    # ---- writing
    def replace(self, df: DataFrame) -> KeyedLedger:
        """All rows anew; the frame may read the ledger itself."""
        part = self._write(df, self._buckets)
        self.manifest.commit(lambda state: {"key": self.key, "buckets": self._buckets, "schema": df.schema.json(), "parts": [part]})
        return self

    def append(self, df: DataFrame) -> KeyedLedger:
        """More rows, by column name. A frame with other columns is refused."""
        _, state = self.manifest.read()
        if not state:
            return self.replace(df)
        names = StructType.fromJson(json.loads(state["schema"])).names
        if sorted(names) != sorted(df.columns):
            raise ValueError(f"cannot append to {self.path}: columns differ: {sorted(set(names) ^ set(df.columns))}")
        part = self._write(df.select(*names), state["buckets"])
        self.manifest.commit(lambda newest: {**newest, "parts": [*newest["parts"], part]})
        return self

    def compact(self) -> KeyedLedger:
        """One index instead of many; the rows stay where they are. Parts appended meanwhile are kept beside it."""
        _, state = self.manifest.read()
        if len(state.get("parts", [])) < 2:
            return self
        keys = self._index(state, state["parts"][0])
        for part in state["parts"][1:]:
            keys = keys.union(self._index(state, part))
        index = self._write_index(keys, state["buckets"])
        done = state["parts"]
        whole = {"rows": [f for p in done for f in p["rows"]], "index": index, "count": sum(p["count"] for p in done), "nulls": sum(p["nulls"] for p in done)}
        self.manifest.commit(lambda newest: {**newest, "parts": [whole, *[p for p in newest["parts"] if p not in done]]})
        return self

    def _write(self, df: DataFrame, buckets: int) -> dict:
        folder = f"rows-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        rows = self.spark.read.schema(df.schema).parquet(f"{self.path}/{folder}")
        count, nulls = rows.agg(F.count(F.lit(1)), F.count_if(F.col(self.key).isNull())).first()
        return {"rows": [folder], "index": self._write_index(rows.select(self.key), buckets), "count": count, "nulls": nulls}

    def _write_index(self, keys: DataFrame, buckets: int) -> str:
        folder = f"index-{uuid.uuid4().hex}"
        distinct = keys.where(F.col(self.key).isNotNull()).distinct().repartition(buckets, self.key)   # one file per bucket
        distinct.write.bucketBy(buckets, self.key).sortBy(self.key).option("path", f"{self.path}/{folder}").saveAsTable(self._name(folder))
        return folder

    # ---- reading
    @staticmethod
    def _name(folder: str) -> str:
        return folder.replace("-", "_")

    def _index(self, state: dict, part: dict) -> DataFrame:
        """An index as a bucketed table; a session that has not seen it yet is told of its layout."""
        name = self._name(part["index"])
        if not self.spark.catalog.tableExists(name):
            kind = StructType.fromJson(json.loads(state["schema"]))[self.key].dataType.simpleString()
            self.spark.sql(f"create table {name} (`{self.key}` {kind}) using parquet clustered by (`{self.key}`) sorted by (`{self.key}`) "
                           f"into {state['buckets']} buckets location '{self.path}/{part['index']}'")
        return self.spark.table(name)

    def indexes(self) -> list[DataFrame]:
        """Distinct keys, one bucketed frame per write since the last compaction."""
        _, state = self.manifest.read()
        return [self._index(state, part) for part in state.get("parts", [])]

    def rows(self) -> DataFrame | None:
        _, state = self.manifest.read()
        if not state:
            return None
        folders = [f"{self.path}/{f}" for part in state["parts"] for f in part["rows"]]
        return self.spark.read.schema(StructType.fromJson(json.loads(state["schema"]))).parquet(*folders)

    def facts(self) -> tuple[int, int]:
        """Number of rows and of null keys, from the manifest."""
        _, state = self.manifest.read()
        parts = state.get("parts", [])
        return sum(p["count"] for p in parts), sum(p["nulls"] for p in parts)

    # ---- asking
    def exclude(self, df: DataFrame, key: str | None = None) -> DataFrame:
        """Rows whose key is not in the ledger; rows without a key stay."""
        key = key or self.key
        for index in self.indexes():
            df = df.join(index.withColumnRenamed(self.key, key), key, "left_anti")
        return df

    def not_in(self, df: DataFrame, key: str | None = None) -> DataFrame:
        """``key NOT IN (select key from ledger)`` with SQL's rules for nulls, known before any row is read."""
        key = key or self.key
        count, nulls = self.facts()
        if nulls:
            return df.limit(0)
        return self.exclude(df if not count else df.where(F.col(key).isNotNull()), key)
