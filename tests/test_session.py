import time

from ledgerloom.session import FREE_SHUFFLES, _bytes, cut_lineage, shuffles_freed, tune


def test_tune_bounds_what_a_task_reads_from_a_shuffle(spark):
    session = spark.newSession()
    for key, most in (("spark.sql.adaptive.advisoryPartitionSizeInBytes", 16 << 20), ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", 64 << 20)):
        session.conf.set(key, "256m")
        tune(session)
        assert _bytes(session, session.conf.get(key)) == most
        session.conf.set(key, "8m")     # a session that asks for less keeps it
        tune(session)
        assert session.conf.get(key) == "8m"


def test_written_stages_leave_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    data = lambda: {f for f in disk.getAllFiles().mkString("|").split("|") if f.endswith(".data")}
    before, setting = data(), spark.conf.get(FREE_SHUFFLES)
    df = spark.range(1000).selectExpr("id % 7 as k", "id").repartition(4, "k")
    stage = cut_lineage(df, "freed")
    for _ in range(50):
        if not data() - before:
            break
        time.sleep(0.1)
    assert not data() - before and stage.count() == 1000 and df.count() == 1000
    assert spark.conf.get(FREE_SHUFFLES) == setting


def test_the_setting_returns_when_a_write_fails(spark):
    setting = spark.conf.get(FREE_SHUFFLES)
    try:
        with shuffles_freed(spark):
            assert spark.conf.get(FREE_SHUFFLES) == "true"
            raise ValueError("a write that fails")
    except ValueError:
        pass
    assert spark.conf.get(FREE_SHUFFLES) == setting
