"""Ledgers laid out by key: answers as plain joins give them, and plans that leave the ledger where it is."""

import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import incremental as inc
from ledgerloom.sources.ledgers import KeyedLedger
from ledgerloom.sources.versions import Manifest
from tests.conftest import rows


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def ledger_sides_with_exchange(plan):
    """Scans of an index that have an exchange between them and the join (the initial plan of an adaptive one is left out)."""
    plan = plan.split("== Initial Plan ==")[0]
    lines, found = plan.splitlines(), []
    for i, line in enumerate(lines):
        if "index_" in line and "Scan" in line:
            depth = len(re.match(r"[\s:+*|-]*", line).group(0))
            for above in reversed(lines[:i]):
                at = len(re.match(r"[\s:+*|-]*", above).group(0))
                if at < depth:
                    depth = at
                    if "Join" in above:
                        break
                    if "Exchange" in above:
                        found.append(above)
                        break
    return found


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def posted(spark, path):
    ledger = KeyedLedger(spark, path, "doc", 4)
    ledger.replace(spark.createDataFrame([("a", 1), ("a", 2), ("hot", 3)] + [("hot", 4)] * 50, "doc string, n int"))
    return ledger.append(spark.createDataFrame([(7, "c"), (8, "a")], "n int, doc string"))


def test_excluded_as_by_a_plain_join_without_moving_the_ledger(spark, tmp_path, no_broadcast):
    ledger = posted(spark, str(tmp_path / "l"))
    day = spark.createDataFrame([(d, i) for i, d in enumerate(["a", "b", "c", "d", None, "hot", "b"])], "doc string, i int").repartition(3)
    out = inc.exclude_posted(day, "doc", ledger)
    assert rows(out) == rows(inc.exclude_posted(day, "doc", (ledger.rows(), "doc"))) == [(None, 4), ("b", 1), ("b", 6), ("d", 3)]
    plan = executed(out)
    assert plan.count("index_") >= 2 and ledger_sides_with_exchange(plan) == []
    # the day's rows are dealt once for both indexes
    assert plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning(doc") <= 1
    ledger.compact()
    assert len(ledger.indexes()) == 1 and rows(ledger.exclude(day)) == rows(out)
    assert rows(ledger.indexes()[0]) == [("a",), ("c",), ("hot",)] and ledger.rows().count() == 55


def test_not_in_and_promotion_match_plain_frames(spark, tmp_path, no_broadcast):
    header = spark.createDataFrame([("a", 0), ("b", 0), ("c", 2), (None, 0)], "external_doc_no string, is_processed int")
    line = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2), ("c", 3)], "document_no string, n int")
    final_h = KeyedLedger(spark, str(tmp_path / "h"), "external_doc_no", 4).replace(spark.createDataFrame([("a",)], "external_doc_no string"))
    final_l = KeyedLedger(spark, str(tmp_path / "n"), "document_no", 4).replace(spark.createDataFrame([("a",)], "document_no string"))
    keyed = inc.promote(header, line, final_h, final_l)
    plain = inc.promote(header, line, final_h.rows(), final_l.rows())
    for got, want in zip(keyed, plain):
        assert rows(got) == rows(want)
        assert ledger_sides_with_exchange(executed(got)) == []
    final_h.append(spark.createDataFrame([(None,)], "external_doc_no string"))
    assert inc.not_in(header, "external_doc_no", final_h).count() == inc.not_in(header, "external_doc_no", final_h.rows()).count() == 0


def test_an_empty_ledger_lets_null_keys_pass(spark, tmp_path):
    day = spark.createDataFrame([("a",), (None,)], "doc string")
    empty = KeyedLedger(spark, str(tmp_path / "e"), "doc", 4).replace(day.limit(0))
    assert rows(inc.not_in(day, "doc", empty)) == [(None,), ("a",)]
    assert rows(inc.exclude_posted(day, "doc", empty)) == [(None,), ("a",)]


def test_another_session_and_a_killed_append(spark, tmp_path, monkeypatch):
    ledger = posted(spark, str(tmp_path / "l"))
    # a new session has no such table in its catalog
    for _, state in [ledger.manifest.read()]:
        for part in state["parts"]:
            spark.sql(f"drop table {ledger._name(part['index'])}")
    assert rows(KeyedLedger(spark, str(tmp_path / "l"), "doc").exclude(spark.createDataFrame([("a",), ("x",)], "doc string"))) == [("x",)]
    with monkeypatch.context() as m:
        m.setattr(Manifest, "_put", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            ledger.append(spark.createDataFrame([("z", 1)], "doc string, n int"))
    assert ledger.facts() == (55, 0) and rows(ledger.exclude(spark.createDataFrame([("z",)], "doc string"))) == [("z",)]
    with pytest.raises(ValueError, match="differ"):
        ledger.append(spark.range(1).withColumn("other", F.lit(1)))
