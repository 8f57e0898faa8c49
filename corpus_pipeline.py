"""Corpus pipeline: each stage applies one operator to the documents that its predecessor kept.

1. toxicity: documents that score one half or more are dropped;
2. near_dedup: of each group of near copies (Jaccard similarity of five-word shingles from 0.80 on) the first document stays;
3. decontaminate: documents that hold a window of a benchmark item are dropped;
4. secrets: found secrets are replaced by a mark (``n_chars`` follows where the text changed);
5. mix: each document is repeated as often as its source's target asks for, and dropped where that is never;
   ``copy`` counts the repeats from 1 and ``taken_words`` are the words of all of them.

The first four return the columns of ``documents``, whatever these are. A stage keeps or drops rows by a row number that is
fixed in a written table, not by ids, so repeated and null ids are handled like any others; ties go to the row that stands first in its file.
Null, empty and very long texts are handled as each operator states: none of them is toxic, a near copy of another or hit for being so.
An empty table of documents gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import decontam, mixing, near_dedup, secret_scan, toxicity
from ledgerloom.llm.common import as_is, fresh, numbered, written
from ledgerloom.session import new_stage_path

NEAR_PERCENT = 80      # similarity that links two documents

#: The stages learn a classifier and estimate similarities: SQL cannot express them.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # labels of the rows that the operator's query may learn from
    allowed = F.pmod(F.crc32(F.col("id").cast("string")), F.lit(5)) != 0
    lexicon = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), allowed)
    score, verdict = fresh("score", docs.columns), fresh("predicted", docs.columns)
    scored = toxicity.score(docs, lexicon, as_is(docs), name=score, verdict=verdict)
    return scored.where(F.col(verdict) == 0).select(*as_is(docs).values())


def drop(rows: DataFrame, number: str, dropped: DataFrame) -> DataFrame:
    """The rows whose number isn't listed. The list is written, so Spark knows its size when it plans the join."""
    listed = written(dropped, "dropped")
    return rows.join(listed.withColumnRenamed(listed.columns[0], number), number, "left_anti")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str, percent: int = NEAR_PERCENT) -> DataFrame:
    rows, number = numbered(docs)
    # the kept row of a group is the first in this order
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.col(number).alias("name"))
    groups = near_dedup.near_groups(rows.select(key.alias("doc_id"), "text"), percent=percent)
    return drop(rows, number, groups.where("not kept").select("doc_id.name")).select(*as_is(docs).values())


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, number = numbered(docs)
    hits = decontam.contaminated(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), doc_id=number)
    return drop(rows, number, hits).select(*as_is(docs).values())


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(docs, keep=docs.columns).where("copies > 0")
    copies = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return mixed.select(*[F.col(f"`kept_{c}`").alias(c) for c in docs.columns],
                        copies.alias(fresh("copy", docs.columns)), F.col("taken").alias(fresh("taken_words", docs.columns)))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", one_of_each_group),
    ("decontaminate", without_benchmark),
    ("secrets", without_secrets),
    ("mix", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_stage_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
