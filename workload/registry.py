"""Registry of queries: each key has a Spark callable and, where SQL can say it, an oracle text.

Stand-in tables (``standins.py``) give the driver tables the shape the operators expect. Their SQL
is plain enough for both engines; the operators and the oracle texts are written independently.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.session import tune
from ledgerloom.sources.io import scan
from workload.standins import BASE, STANDINS

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


class Tables(dict):
    """Driver tables and stand-ins of one scale directory, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = tune(spark), sf_dir

    def __missing__(self, name: str) -> DataFrame:
        if name in BASE:
            df = scan(self.spark, self.sf_dir, name)
        else:
            text = STANDINS[name]
            df = self.spark.sql(text, **{dep: self[dep] for dep in _placeholders(text)})
        self[name] = df
        return df

    def pick(self, **names: str) -> dict[str, DataFrame]:
        return {role: self[name] for role, name in names.items()}


def _placeholders(text: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", text)))


def present(df: DataFrame) -> DataFrame:
    """Comparable output: decimals as doubles, dates and timestamps as text."""
    out = []
    for field in df.schema.fields:
        kind, col = field.dataType.simpleString(), F.col(f"`{field.name}`")
        if kind.startswith("decimal"):
            col = col.cast("double")
        elif kind == "date":
            col = col.cast("string")
        elif kind.startswith("timestamp"):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        out.append(col.alias(field.name))
    return df.select(out)


def oracle(body: str) -> str:
    """Prefix a query body with the stand-ins it names, in dependency order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in STANDINS and name not in ordered:
            for dep in _placeholders(STANDINS[name]):
                add(dep)
            ordered.append(name)

    for name in STANDINS:
        if re.search(rf"\b{name}\b", body):
            add(name)
    ctes = [f"{n} as ({STANDINS[n].format(**{d: d for d in _placeholders(STANDINS[n])})})" for n in ordered]
    body = body.strip()
    if body[:5].lower() == "with ":
        ctes.append(body[5:])
        return "with " + ",\n".join(ctes)
    return ("with " + ",\n".join(ctes) + "\n" if ctes else "") + body


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under a key, with its oracle text."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate key {name}")
        QUERIES[name] = lambda spark, sf_dir: present(fn(Tables(spark, sf_dir)))
        if sql is not None:
            ORACLE[name] = oracle(sql)
        return fn

    return register
