from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.incremental import latest_snapshot
from ledgerloom.session import cut_lineage, new_stage_path, shared_dir
from ledgerloom.sources import io
from tests.conftest import rows


def test_headers():
    assert io.normalise_headers(["Order Date", "A / B", "A \\ B", "Line\nNo"]) == ["order_date", "a_b", "a_b", "line_no"]


def test_adjustments_keep_rows_with_a_key(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('Doc No,"Line / No",Amount,Extra\na,1,5,x\nb,,6,x\n\nc,3,,x\n')
    out = io.ingest_adjustments(spark, str(path), "line_no", 3)
    assert out.columns == ["doc_no", "line_no", "amount"]
    # a row without key in the middle does not cut the rows after it
    assert rows(out) == [("a", "1", "5"), ("c", "3", None)]


def test_append_is_by_name(spark, tmp_path):
    path = str(tmp_path / "t")
    io.append(spark.createDataFrame([(1, "x")], "a int, b string"), path)
    io.append(spark.createDataFrame([("y", 2)], "b string, a int"), path)
    assert rows(spark.read.parquet(path), "a", "b") == [(1, "x"), (2, "y")]


def test_append_refuses_other_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    io.append(spark.range(2), path)
    for other in (spark.range(1).withColumn("x", F.lit(1)), spark.range(1).withColumnRenamed("id", "no"), spark.range(1).select(F.col("id").cast("int"))):
        with pytest.raises(ValueError, match="differ"):
            io.append(other, path)
    assert spark.read.parquet(path).count() == 2


def test_snapshot_of_one_stamp_is_repeatable_per_channel(spark, tmp_path):
    path = str(tmp_path / "log")
    rows_ = spark.createDataFrame([("1", 5), ("02", 6), (None, 7)], "channel string, n int")
    for stamp in (datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 2)):
        log = io.snapshot_append(rows_, path, stamp, within=["channel"])
    assert log.count() == 6 and rows(log.select("channel").distinct()) == [(None,), ("02",), ("1",)]
    newest = latest_snapshot(log, io.SNAPSHOT_PARTITION, F.col("channel") == "02")
    assert rows(newest, "n") == [(6,)]


def test_replace_may_read_its_target(spark, tmp_path):
    path = str(tmp_path / "t")
    io.replace(spark.range(5), path)
    io.replace(spark.read.parquet(path).where("id > 2"), path)
    assert rows(spark.read.parquet(path)) == [(3,), (4,)]


def test_snapshot_log_prunes_to_the_newest_load(spark, tmp_path):
    path = str(tmp_path / "log")
    io.snapshot_append(spark.range(3), path, datetime(2024, 1, 1, 5))
    log = io.snapshot_append(spark.range(3, 5), path, datetime(2024, 1, 2, 5))
    newest = latest_snapshot(log, io.SNAPSHOT_PARTITION)
    assert rows(newest, "id") == [(3,), (4,)]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_stamp" in plan


def test_export_clears_and_reports_empty(spark, tmp_path):
    path = str(tmp_path / "r")
    full = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert io.export_report(full, path)
    text = "".join(sorted(p.read_text() for p in (tmp_path / "r").glob("part-*")))
    assert "null" not in text and "a,b" in text
    assert not io.export_report(full.where("a > 5"), path)


def test_cutoff_keeps_undated_documents(spark):
    header = spark.createDataFrame([("a", date(2024, 1, 1)), ("b", date(2024, 2, 1)), ("c", None)], "doc string, d date")
    line = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1), ("z", 1)], "no string, n int")
    h, l = io.cutoff_delete(header, line, "no", "doc", "d", date(2024, 2, 1))
    assert rows(h, "doc") == [("a",), ("c",)] and rows(l, "no") == [("a",), ("c",), ("z",)]


def test_stage_is_written_below_the_shared_folder(spark):
    df = cut_lineage(spark.range(4).withColumn("v", F.lit(None)), "unit")
    assert all(shared_dir(spark).split(":")[-1] in f for f in df.inputFiles())
    assert dict(df.dtypes)["v"] == "string" and df.count() == 4
    assert new_stage_path(spark, "x") != new_stage_path(spark, "x")


def test_named_view_and_query(spark):
    df = io.named_view("tiny_view", lambda: spark.range(3))
    assert df.count() == 3
    assert io.query(spark, "select sum(id) as s from nums", {"nums": spark.range(4)}).first()["s"] == 6


def test_a_cluster_has_to_name_its_shared_folder():
    class Session:
        class conf:
            get = staticmethod(lambda name, default=None: default if name == "spark.checkpoint.dir" else "/warehouse/")

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session)
    Session.sparkContext.master = "local[4]"
    assert shared_dir(Session) == "/warehouse/_stages"


def test_one_line_files_are_split(spark, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text("Line No,Note\n" + "".join(f'{i},"a, {i}"\n' for i in range(5000)))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "16384")
    try:
        whole, split = [io.ingest_adjustments(spark, str(path), "line_no", one_line=x) for x in (False, True)]
        assert whole.rdd.getNumPartitions() == 1 < split.rdd.getNumPartitions()
        assert sorted(split.collect()) == sorted(whole.collect()) and split.count() == 5000
    finally:
        spark.conf.set(key, before)
