"""Tables by manifest: a job that dies between any two steps leaves a readable table, and a second run of a load replaces it whole."""

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import io
from ledgerloom.sources.versions import Manifest, SnapshotLog, current, publish, vacuum
from tests.conftest import rows

DAY = datetime(2024, 1, 1)


class Killed(Exception):
    pass


def kill(*_args, **_kwargs):
    raise Killed


def test_publish_may_read_its_table_and_keeps_types(spark, tmp_path):
    table = str(tmp_path / "t")
    assert current(spark, table) is None
    publish(spark.range(5).withColumn("d", F.lit(None).cast("decimal(18,2)")), table)
    out = publish(current(spark, table).where("id > 2"), table)
    assert rows(out, "id") == [(3,), (4,)] and dict(out.dtypes)["d"] == "decimal(18,2)"
    assert len(vacuum(spark, table)) == 1 and rows(current(spark, table), "id") == [(3,), (4,)]


@pytest.mark.parametrize("step", ["_put", "commit"])
def test_a_killed_replacement_leaves_the_old_rows(spark, tmp_path, monkeypatch, step):
    table = str(tmp_path / "t")
    publish(spark.range(3), table)
    reader = current(spark, table)
    with monkeypatch.context() as m:
        m.setattr(Manifest, step, kill)
        with pytest.raises(Killed):
            publish(spark.range(10, 12), table)
    assert rows(current(spark, table)) == rows(reader) == [(0,), (1,), (2,)]
    publish(spark.range(20, 21), table)
    assert rows(current(spark, table)) == [(20,)] and len(vacuum(spark, table)) == 2


def test_a_job_killed_while_it_writes_data_leaves_the_old_rows(spark, tmp_path):
    table = str(tmp_path / "t")
    publish(spark.range(3), table)
    with pytest.raises(Exception, match="broken"):
        publish(spark.range(9).withColumn("id", F.when(F.col("id") == 8, F.raise_error(F.lit("broken"))).otherwise(F.col("id"))), table)
    assert rows(current(spark, table)) == [(0,), (1,), (2,)]


def test_of_two_writers_the_second_sees_the_first(spark, tmp_path, monkeypatch):
    log = SnapshotLog(spark, str(tmp_path / "log"), ["channel"])
    one = lambda c: spark.createDataFrame([(c, 1)], "channel string, n int")
    log.append(one("A"), DAY)
    put, raced = Manifest._put, []

    def slow(self, number, state):
        if not raced:
            raced.append(True)
            SnapshotLog(spark, str(tmp_path / "log"), ["channel"]).append(one("B"), DAY)
        return put(self, number, state)

    monkeypatch.setattr(Manifest, "_put", slow)
    log.append(one("C"), DAY)
    assert rows(log.read(), "channel") == [("A",), ("B",), ("C",)]


def test_a_second_run_without_rows_of_a_channel_shows_none(spark, tmp_path):
    path = str(tmp_path / "log")
    both = spark.createDataFrame([("A", 1), ("B", 2), (None, 3)], "channel string, n int")
    io.snapshot_append(both, path, DAY, within=["channel"])
    io.snapshot_append(both, path, DAY + timedelta(1), within=["channel"])
    log = io.snapshot_append(both.where("channel = 'A'"), path, DAY + timedelta(1), within=["channel"])
    assert rows(log.where("load_stamp like '20240102%'"), "channel", "n") == [("A", 1)]
    # another channel's job under the same stamp is another load
    log = io.snapshot_append(both.where("channel = 'B'"), path, DAY + timedelta(1), within=["channel"])
    assert rows(log.where("load_stamp like '20240102%'"), "channel", "n") == [("A", 1), ("B", 2)]
    # a run without any row speaks for what it covers
    log = io.snapshot_append(both.where("n > 5"), path, DAY + timedelta(1), within=["channel"], covers=[["B"]])
    assert rows(log.where("load_stamp like '20240102%'"), "channel", "n") == [("A", 1)]
    newest = SnapshotLog(spark, path, ["channel"]).newest(["B"])
    assert rows(newest.where("channel = 'B'"), "n", "load_stamp") == [(2, "20240101000000000000")]
    assert rows(SnapshotLog(spark, path, ["channel"]).newest([None]).where("channel is null"), "n") == [(3,)]
    assert SnapshotLog(spark, path, ["channel"]).newest(["Z"]).count() == 0


def test_a_killed_load_is_not_seen(spark, tmp_path, monkeypatch):
    log = SnapshotLog(spark, str(tmp_path / "log"), ["channel"])
    frame = spark.createDataFrame([("A", 1), ("B", 2)], "channel string, n int")
    log.append(frame, DAY)
    with monkeypatch.context() as m:
        m.setattr(Manifest, "_put", kill)
        with pytest.raises(Killed):
            log.append(frame, DAY + timedelta(1))
    assert rows(log.newest(["A"]), "channel", "n") == [("A", 1), ("B", 2)] and log.read().count() == 2
    assert len(vacuum(spark, log.path)) == 1 and log.read().count() == 2


def test_newest_load_does_not_depend_on_the_number_of_old_loads(spark, tmp_path):
    log = SnapshotLog(spark, str(tmp_path / "log"), ["channel"])
    log.append(spark.createDataFrame([("A", 1)], "channel string, n int"), DAY)

    def took():
        best = []
        for _ in range(3):
            start = time.perf_counter()
            frame = log.newest(["A"])
            assert frame.count() == 1 and len(frame.inputFiles()) == 1
            best.append(time.perf_counter() - start)
        return min(best)

    few = took()
    old = [{"id": f"gone{i}", "stamp": f"2023{i:016d}", "parts": [["A"]], "covers": [["A"]]} for i in range(1000)]
    # their folders don't even exist: nothing of them is touched
    log.manifest.commit(lambda state: {**state, "loads": old + state["loads"]})
    assert took() < 3 * few + 0.5
    assert len(log.manifest._numbers()) == 2


def test_old_states_are_cleared(spark, tmp_path):
    table = str(tmp_path / "t")
    for i in range(14):
        Manifest(spark, table).commit(lambda state, i=i: {"folder": str(i)})
    assert Manifest(spark, table).read() == (14, {"folder": "13"}) and len(Manifest(spark, table)._numbers()) == 10
