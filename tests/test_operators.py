import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from ledgerloom.operators import aggs, derive, incremental as inc, joins, skew, windows
from ledgerloom.session import cut_lineage as cut
from tests.conftest import rows


# ---- numbering and skew ----------------------------------------------------------------------
def skewed(spark):
    """One document with a third of the rows, many identical copies, and a null document."""
    rng = random.Random(5)
    data = [("hot", rng.randint(0, 20), "x") for _ in range(300)]
    data += [("hot", 3, "copy")] * 200 + [(None, rng.randint(0, 5), "n") for _ in range(50)]
    data += [(f"d{i % 90}", rng.randint(0, 50), "y") for i in range(900)]
    return spark.createDataFrame(data, "doc string, a int, b string").repartition(7)


def test_line_numbers_match_window(spark):
    """One route for a hot, a null and an all-equal document that lie over several slices."""
    equal = spark.createDataFrame([("same", 7, "z")] * 700, "doc string, a int, b string")
    df = skewed(spark).unionByName(equal)
    order = [F.col("a").asc_nulls_first(), F.col("b")]
    got = windows.line_numbers(df, "doc", order)
    want = df.withColumn("line_no", F.row_number().over(Window.partitionBy("doc").orderBy(*order)).cast("long") * 10000)
    cols = ["doc", "a", "b", "line_no"]
    assert rows(got, *cols) == rows(want, *cols)
    placed = skew._ranged(df, [F.col("doc"), *order])
    slices = {r["doc"]: r["n"] for r in placed.groupBy("doc").agg(F.countDistinct("_slice").alias("n")).collect()}
    assert slices["hot"] > 1 and slices["same"] > 1


def test_line_numbers_of_scanned_rows(spark, tmp_path):
    """Rows read from files are numbered alike without the first of the two writes."""
    skewed(spark).write.parquet(f"{tmp_path}/rows")
    df = spark.read.parquet(f"{tmp_path}/rows").where("a < 40")
    order = [F.col("a").asc_nulls_first(), F.col("b")]
    got = windows.line_numbers(df, "doc", order, scanned=True)
    assert rows(got, "doc", "a", "b", "line_no") == rows(windows.line_numbers(df, "doc", order), "doc", "a", "b", "line_no")


def test_hot_document_is_spread(spark):
    df = skewed(spark).where("doc = 'hot'")
    placed = skew.global_positions(df, [F.col("a"), F.col("b")], partitions=4)
    sizes = [r["count"] for r in placed.groupBy("_slice").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 300          # the 200 copies do not stay together
    assert rows(placed, "_pos") == sorted(((i,) for i in range(500)), key=lambda r: (True, str(r[0])))


def test_dense_rank_global(spark):
    df = skewed(spark)
    got = windows.dense_rank_global(df, "doc", partitions=3)
    want = df.withColumn("rank", F.dense_rank().over(Window.orderBy(F.col("doc").asc_nulls_last())).cast("long"))
    assert rows(got, "doc", "a", "b", "rank") == rows(want, "doc", "a", "b", "rank")
    ranks = sorted(r[0] for r in got.select("rank").distinct().collect())
    assert ranks == list(range(1, len(ranks) + 1))


def test_allocate_sums_to_total_and_guards_zero(spark):
    data = [("i1", Decimal("100.00"), Decimal("30.00"), 1), ("i1", Decimal("100.00"), Decimal("10.00"), 2),
            ("i2", Decimal("50.00"), Decimal("1.00"), 0), (None, Decimal("9.00"), Decimal("3.00"), 3)]
    df = spark.createDataFrame(data, "inv string, total decimal(18,2), cost decimal(18,2), qty int")
    out = {(r["inv"], r["qty"]): r["allocated"] for r in windows.allocate(df, "inv", "total", "cost", "qty").collect()}
    assert out[("i1", 1)] == 20 and out[("i1", 2)] == 40
    assert out[("i2", 0)] is None
    assert out[(None, 3)] == 6


# ---- joins -----------------------------------------------------------------------------------
def test_contains_join_equals_brute_force(spark):
    rng = random.Random(11)
    lists = [",".join(str(rng.randint(0, 600)) for _ in range(rng.randint(1, 4))) for _ in range(60)] + [None, ""]
    days = [date(2024, 1, 1 + i % 28) for i in range(200)]
    left = [(i, rng.choice(lists), days[i]) for i in range(200)]
    right = [(str(rng.randint(0, 600)), date(2024, 1, a), date(2024, 1, a + 5)) for a in [rng.randint(1, 20) for _ in range(80)]]
    right += [("", date(2024, 1, 1), date(2024, 1, 3)), (None, date(2024, 1, 1), date(2024, 1, 30)), ("1", date(2024, 1, 1), date(2024, 1, 30))]
    a = spark.createDataFrame(left, "id int, hay string, day date")
    b = spark.createDataFrame(right, "needle string, low date, high date")
    got = rows(joins.contains_join(a, b, "hay", "needle", ("day", "low", "high")), "id", "needle", "low")
    want = []
    for i, hay, day in left:
        hits = [(i, n, low) for n, low, high in right if hay is not None and n is not None and n in hay and low <= day <= high]
        want += hits or [(i, None, None)]
    assert got == sorted(want, key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_token_join_is_strict(spark):
    a = spark.createDataFrame([(1, "512,7"), (2, "12")], "id int, hay string")
    b = spark.createDataFrame([("12",), ("7",)], "needle string")
    assert rows(joins.token_join(a, b, "hay", "needle"), "id", "needle") == [(1, "7"), (2, "12")]
    assert rows(joins.contains_join(a, b, "hay", "needle"), "id", "needle") == [(1, "12"), (1, "7"), (2, "12")]


@pytest.mark.parametrize("bucket", [None, 1, 30, 400])
def test_interval_join_bounds_and_overlaps(spark, bucket):
    a = spark.createDataFrame([(1, "s", date(2024, 1, 10)), (2, "s", date(2024, 1, 20)), (3, "s", date(2024, 3, 1)), (4, "z", date(2024, 1, 1))],
                              "id int, sku string, day date")
    b = spark.createDataFrame([("s", date(2024, 1, 1), date(2024, 1, 10), 1), ("s", date(2024, 1, 10), date(2024, 1, 20), 2),
                               ("s", date(2024, 1, 15), date(9999, 12, 31), 3)], "sku string, low date, high date, price int")
    out = joins.interval_join(a, b, [("sku", "sku")], "day", "low", "high", bucket_days=bucket)
    assert rows(out, "id", "price") == [(1, 1), (1, 2), (2, 2), (2, 3), (3, 3), (4, None)]
    assert out.columns.count("sku") == 1


def test_contains_join_long_texts_and_needles(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abé\U0001F600\n") for _ in range(n))
    texts = [word(n) for n in (0, 1, 3, 8, 255, 256, 257, 263, 264, 600, 5000, 100_000)] + ["a" * 3000, "a" * 700 + "b", None]
    cut = lambda s, n: s[(k := rng.randrange(max(1, len(s) - n + 1))):k + n]
    needles = {cut(rng.choice([t for t in texts if t]), n) for n in (1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 40, 300) for _ in range(6)}
    needles |= {texts[9], texts[10] + "a", "zz", "", "a" * 699 + "b", "b" + "a" * 20, texts[8][248:], texts[8][-1:], texts[7][255:]}
    a = spark.createDataFrame(list(enumerate(texts)), "id int, hay string")
    b = spark.createDataFrame([(n,) for n in [*needles, None]], "needle string")
    got = rows(joins.contains_join(a, b, "hay", "needle", how="inner"), "id", "needle")
    want = [(i, n) for i, t in enumerate(texts) if t is not None for n in needles if n in t]
    assert sorted(got) == sorted(want)


def test_contains_candidates_join_no_more_pieces_than_a_text_has_places(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(joins, "cut_lineage", lambda df, name: seen.append(df) or df)
    text = "".join(random.Random(4).choice("abcdefgh,") for _ in range(20_000))
    a = spark.createDataFrame([(text,)], "hay string")
    b = spark.createDataFrame([(text[i:i + 8 + i % 40],) for i in range(0, 19_000, 5)], "needle string")
    assert joins.contains_candidates(a, "hay", b, "needle").count() == b.distinct().count()
    assert seen[0].count() <= len(text)


def interval_case():
    """A key with nine tenths of the rows, open and short intervals, bounds that touch, repeated and null rows."""
    rng = random.Random(9)
    day = lambda n: date.fromordinal(date(2020, 1, 1).toordinal() + n)
    left = [(i, "hot" if i % 10 else rng.choice(["a", "b", None]), day(rng.randrange(1500)) if i % 97 else None, i % 2) for i in range(3000)]
    spans = [("hot", day(n), day(n + rng.randrange(9)), n) for n in range(0, 1500, 4)] + [("hot", day(0), day(5000), -1), ("hot", day(700), day(700), -2)] * 2
    spans += [("a", day(100), day(900), 7), ("b", day(1400), day(0), 8), (None, day(0), day(2000), 9), ("a", None, day(9), 10), ("a", day(0), None, 11), ("c", day(0), day(2000), 12)]
    return left, spans


@pytest.mark.parametrize("how", ["left", "inner"])
def test_ranged_interval_join_equals_brute_force(spark, how):
    left, spans = interval_case()
    a = spark.createDataFrame(left, "id int, sku string, day date, price int").repartition(5)
    b = spark.createDataFrame(spans, "sku string, low date, high date, cost int")
    got = rows(joins.ranged_interval_join(a, b, [("sku", "sku")], "day", "low", "high", how, partitions=7), "id", "price", "cost")
    want = []
    for i, sku, d, price in left:
        hits = [(i, price, c) for s, low, high, c in spans if None not in (sku, d, s, low, high) and s == sku and low <= d <= high]
        want += hits or ([(i, price, None)] if how == "left" else [])
    assert got == sorted(want, key=lambda r: tuple((v is not None, str(v)) for v in r))
    assert joins.ranged_interval_join(a, b.limit(0), [("sku", "sku")], "day", "low", "high", how).count() == (3000 if how == "left" else 0)


def test_ranged_interval_join_spreads_a_hot_key(spark, monkeypatch):
    written = []
    monkeypatch.setattr(joins, "cut_lineage", lambda df, name: written.append(cut(df, name)) or written[-1])
    left, spans = interval_case()
    a = spark.createDataFrame(left, "id int, sku string, day date, price int").repartition(5)
    b = spark.createDataFrame(spans, "sku string, low date, high date, cost int")
    joins.ranged_interval_join(a, b, [("sku", "sku")], "day", "low", "high", partitions=8)
    held = written[0].where("_k0 = 'hot' and _kind = 1").groupBy(skew.slice_of()).count().collect()
    assert len(held) >= 6 and max(r["count"] for r in held) < 2700 / 3


def test_fallback_join(spark):
    a = spark.createDataFrame([("R61J-1",), ("ABCD-9",), ("ZZZZ",), (None,)], "sku string")
    dim = spark.createDataFrame([("R61J-1", "full"), ("R61J", "parent"), ("ABCD", "parent2")], "k string, v string")
    out = joins.fallback_join(a, dim, "k", "v", [F.col("sku"), F.left("sku", F.lit(4))], "hit", F.lit("Not found"))
    assert rows(out) == [(None, "Not found"), ("ABCD-9", "parent2"), ("R61J-1", "full"), ("ZZZZ", "Not found")]


def test_rate_join_needs_the_exact_day(spark):
    a = spark.createDataFrame([(1, "USD", date(2024, 1, 1)), (2, "USD", date(2024, 1, 2)), (3, None, date(2024, 1, 1))], "id int, ccy string, day date")
    fx = spark.createDataFrame([("USD", date(2024, 1, 1), 1.5)], "ccy string, day date, rate double")
    assert rows(joins.rate_join(a, fx, "ccy", "day", "ccy", "day", "rate"), "id", "to_usd") == [(1, 1.5), (2, None), (3, None)]


def test_reconcile_keeps_source_only_and_drops_booked_only(spark):
    src = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("posted", 4)], "s string, x int")
    bk = spark.createDataFrame([("a", 1), ("b", 5), ("only", 9)], "b string, y int")
    posted = spark.createDataFrame([("posted",), ("b",)], "s string")
    out = joins.reconcile(src, bk, [("s", "b")], ("x", "y"), posted, "s")
    assert rows(out, "s", "b") == [("b", "b"), ("c", None)]
    other = joins.reconcile(src, bk, [("s", "b")], ("x", "y"), posted, "s", guard="differs")
    assert rows(other, "s", "b") == [(None, None)][:0] + [("c", None), ("posted", None)]
    with_null = joins.reconcile(src, bk, [("s", "b")], ("x", "y"), posted.union(spark.createDataFrame([(None,)], "s string")), "s")
    assert rows(with_null, "s", "b") == [("b", "b")]


def test_constant_dim_refuses_a_large_table(spark, monkeypatch):
    monkeypatch.setattr(joins, "MOST_CONSTANT", 5)
    one, dim = spark.range(1), spark.range(6).selectExpr("id as v")
    assert joins.constant_dim(one, dim, F.col("v") < 5, ["v"]).count() == 5
    with pytest.raises(Exception, match="more than 5 rows"):
        joins.constant_dim(one, dim, F.col("v") < 6, ["v"]).collect()


def test_constant_dim(spark):
    a = spark.range(3).select("id")
    dim = spark.createDataFrame([("A", "x"), ("B", "y")], "code string, cid string")
    assert rows(joins.constant_dim(a, dim, F.col("code") == "B", ["cid"])) == [(0, "y"), (1, "y"), (2, "y")]
    assert rows(joins.constant_dim(a, dim, F.col("code") == "none", ["cid"]), "cid") == [(None,)] * 3


# ---- incremental -----------------------------------------------------------------------------
@pytest.mark.parametrize("listed, expected", [
    ([("a",)], [("b",)]), ([("a",), (None,)], []), ([], [(None,), ("a",), ("b",)]), ([(None,)], []),
])
def test_not_in_follows_sql(spark, listed, expected):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    other = spark.createDataFrame(listed, "k string")
    assert rows(inc.not_in(df, "k", other)) == expected
    df.createOrReplaceTempView("t_rows")
    other.createOrReplaceTempView("t_list")
    assert rows(spark.sql("select k from t_rows where k not in (select k from t_list)")) == expected


def test_not_in_does_not_broadcast_the_list(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df, other = spark.range(10).toDF("k"), spark.range(5).toDF("k")
        plan = inc.not_in(df, "k", other)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastNestedLoopJoin" not in plan and "BroadcastHashJoin" not in plan


def test_latest_snapshot_within_channel(spark):
    log = spark.createDataFrame([("A", 1), ("A", 2), ("A", 2), ("B", 3)], "ch string, ts int")
    assert rows(inc.latest_snapshot(log, "ts")) == [("B", 3)]
    # an empty batch of A beside a newer batch of B must not hide A's own newest load
    assert rows(inc.latest_snapshot(log, "ts", F.col("ch") == "A")) == [("A", 2), ("A", 2)]


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, ts int")
    out = inc.latest_per_key(df, ["k"], [F.col("ts").desc()])
    assert rows(out) == [("a", 2), ("b", 1)]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_composite_anti_keeps_null_keys(spark):
    a = spark.createDataFrame([("1", "x"), ("1", None), ("2", "y")], "d string, r string")
    b = spark.createDataFrame([("1", "x"), ("1", None)], "d string, r string")
    assert rows(inc.composite_anti(a, b, ["d", "r"])) == [("1", None), ("2", "y")]


def test_promote_twice_adds_nothing(spark):
    daily_h = spark.createDataFrame([("a", 0), ("b", 2), ("c", 0)], "external_doc_no string, is_processed int")
    daily_l = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1), ("c", 1)], "document_no string, n int")
    final_h = spark.createDataFrame([("c", 0)], "external_doc_no string, is_processed int")
    final_l = spark.createDataFrame([("c", 1)], "document_no string, n int")
    h, l = inc.promote(daily_h, daily_l, final_h, final_l)
    assert rows(h, "external_doc_no") == [("a",)] and rows(l) == [("a", 1), ("a", 2)]
    again_h, again_l = inc.promote(daily_h, daily_l, final_h.unionByName(h), final_l.unionByName(l))
    assert again_h.isEmpty() and again_l.isEmpty()


def test_incremental_matches_null_with_null(spark):
    a = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    assert rows(inc.incremental(a, spark.createDataFrame([("a",), (None,)], "k string"), "k")) == [("b",)]


def test_rollover_and_status_flip(spark):
    schema = "doc string, region string, posting_date date, document_date date, amount int, is_processed int, stamp timestamp"
    d, ts1, ts2 = date(2024, 5, 1), datetime(2024, 5, 1), datetime(2024, 5, 2)
    history = spark.createDataFrame([("h1", "r", d, d, 5, 0, ts1), ("h2", "r", date(2024, 6, 1), d, 5, 0, ts1)], schema)
    log = spark.createDataFrame([("h1", "r", d, d, 5, 3, ts2), ("n1", "r", d, d, 7, 3, ts2), ("n2", "r", d, d, 0, 3, ts2), ("old", "r", d, d, 7, 3, ts1)], schema)
    out = inc.rollover(history, log, ["doc", "region"], date(2024, 5, 20), "stamp")
    assert rows(out, "doc", "is_processed") == [("h1", 2), ("n1", 3)]
    final = inc.status_flip(out, history.where("doc = 'h1'"), ["doc", "region"], date(2024, 5, 25))
    assert rows(final, "doc", "is_processed") == [("h1", 0), ("n1", 3)]


# ---- aggregations ----------------------------------------------------------------------------
def test_unique_or_unknown(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("b", "y"), ("c", None), ("d", None), ("d", "z")], "k string, v string")
    assert rows(aggs.unique_or_unknown(df, "k", "v")) == [("a", "x"), ("d", "z")]


def test_nonzero_sum_drops_zero_and_null_groups(spark):
    df = spark.createDataFrame([("z", 1), ("z", -1), ("n", None), ("k", 2), ("k", None)], "k string, v int")
    assert rows(aggs.nonzero_sum(df, ["k"], "v", "s")) == [("k", 2)]


def test_mixed_owner_two_and_three(spark):
    header = spark.createDataFrame([("a", "M"), ("a", "S"), ("b", "M"), ("b", "S"), ("b", "X"), ("c", "S"), ("c", "X"), ("d", "S"), ("e", None), ("e", "M")],
                                   "doc string, owner string")
    out = aggs.drop_secondary_owners(header, "doc", "owner", "M", ["S"])
    assert rows(out) == [("a", "M"), ("b", "M"), ("b", "X"), ("c", "S"), ("c", "X"), ("d", "S"), ("e", None), ("e", "M")]


def test_completeness(spark):
    df = spark.createDataFrame([("a", "S"), ("a", "C"), ("b", "C"), ("c", "S"), ("c", "K"), ("d", None), ("d", "S")], "doc string, st string")
    assert rows(aggs.completeness(df, "doc", "st", ["S"], ["C"]), "doc") == [("a",)]


def test_group_constant_on_empty_input(spark):
    empty = spark.createDataFrame([], "v int")
    assert aggs.group_constant(empty, "x", "label", F.max("v")).isEmpty()
    assert empty.agg(F.max("v")).count() == 1


def test_string_lists(spark):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", "x"), ("a", None), ("b", None)], "k string, v string")
    out = df.groupBy("k").agg(aggs.string_distinct("v", ",").alias("d"), aggs.string_list("v", "|").alias("l"))
    assert rows(out) == [("a", "x,y", "x|x|y"), ("b", None, None)]


def test_ordered_lists_equal_string_list(spark, monkeypatch):
    rng = random.Random(2)
    data = [("hot", f"v{rng.randrange(90_000)}") for _ in range(200_000)] + [("n", None), ("n", None), (None, "x"), (None, "a"), ("hot", None)]
    df = spark.createDataFrame(data, "k string, v string").repartition(6)
    got = {r.k: r.l for r in aggs.ordered_lists(df, ["k"], "v", " | ", "l").collect()}
    assert got == {"hot": " | ".join(sorted(v for k, v in data if k == "hot" and v)), "n": None, None: "a | x"}
    assert aggs.ordered_lists(df.limit(0), ["k"], "v", ",", "l").collect() == []


# ---- derivations -----------------------------------------------------------------------------
def test_owner_route_partitions_rows(spark):
    df = spark.createDataFrame([("M",), ("X",), (None,), ("S",)], "o string")
    own, obh = derive.owner_route(df, "o", ["M", "S"])
    assert rows(own) == [("M",), ("S",)] and rows(obh) == [("X",)]


def test_doc_number_for_unknown_owner(spark):
    df = spark.createDataFrame([("i", "M"), ("i", "X"), ("i", None)], "d string, o string")
    out = df.select(derive.doc_number("d", "o", ["M"]).alias("a"), derive.doc_number("d", "o", ["M"], keep_unknown=True).alias("b"))
    assert rows(out) == [(None, "i-OBH-"), ("i", "i"), ("i-OBH-X", "i-OBH-X")]


def test_obh_expand(spark):
    df = spark.createDataFrame([("X", "S1", "ITEM", "pcs", Decimal("2.50"), None, Decimal("4"), Decimal("10.00"))],
                               "owner string, no string, type string, uom string, unit_price decimal(18,2), discount decimal(18,2), quantity decimal(18,0), amount decimal(18,2)")
    cols = ["type", "no", "uom", "unit_price", "quantity", "amount"]
    gl = ("G/L Account", "33890101", None, Decimal("2.50"), 1, Decimal("10.00"))
    assert rows(derive.obh_expand(df, "owner", F.lit(False), "33890101"), *cols) == [gl]
    zero = rows(derive.obh_expand(df, "owner", F.lit(True), "33890101"), *cols)
    assert zero == [gl, ("ITEM", "S1", "pcs", Decimal("0.00"), 4, Decimal("0.00"))]
    priced = rows(derive.obh_expand(df, "owner", F.lit(True), "33890101", zero_price=False), *cols)
    assert priced[1][3] == Decimal("2.50") and priced[1][5] == 0


def test_update_where_is_ordered(spark):
    df = spark.createDataFrame([("a",)], "v string")
    assert rows(derive.update_where(df, [("v", F.col("v") == "a", F.lit("b")), ("v", F.col("v") == "b", F.lit("c"))])) == [("c",)]


def test_unpivot_keeps_rate_tested_zero_amounts(spark):
    df = spark.createDataFrame([(1, Decimal("0.02"), Decimal("0.00"), Decimal("0.03"), Decimal("0.00"))],
                               "id int, r1 decimal(6,4), a1 decimal(10,2), r2 decimal(6,4), a2 decimal(10,2)")
    out = derive.unpivot_rates(df, [("r1", "a1", "by amount", "a1"), ("r2", "a2", "by rate", "r2")], ["id"])
    assert rows(out, "id", "note") == [(1, "by rate")]


def test_lookup_splits_a_hot_key(spark):
    """The hot key of the left side must not stay in one task, with a grouped right side."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(60000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.rand(1).alias("v")).repartition(8)
        side = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        for how in ("left", "left_anti"):
            out = skew.lookup(df, side.where("k <> '1'"), ["k"], how).where("v >= 0")
            count = len(out.collect())
            assert count == (60000 if how == "left" else 1)
            assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_lookup_ignores_null_keys(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    right = spark.createDataFrame([("a", 5), (None, 6)], "k string, w int")
    assert rows(skew.lookup(left, right, ["k"]), "k", "v", "w") == [(None, 2, None), ("a", 1, 5)]
    assert rows(skew.lookup(left, right, ["k"], "left_anti")) == [(None, 2)]
    assert rows(skew.lookup(left, right, ["k"], "left_semi")) == [("a", 1)]


def test_numbers_from_places_count_only_the_keys_that_slices_open_with(spark, tmp_path):
    base = [(write, key) for write in ("a", "b") for key in [None] * 300 + ["hot"] * 900 + [f"k{i}" for i in range(200)]]
    df = spark.createDataFrame(base, "write string, doc string")
    for write in ("a", "b"):
        placed = skew.in_order(df.where(F.col("write") == write), [F.col("doc")], 7)
        placed.write.mode("append").parquet(f"{tmp_path}/load")
    out = skew.numbers_from_places(spark.read.parquet(f"{tmp_path}/load"), ["doc"], "_place", "n", writes=["write"])
    got = out.groupBy("write", "doc").agg(F.count("*").alias("rows"), F.min("n").alias("low"), F.max("n").alias("high"), F.countDistinct("n").alias("numbers"))
    assert all(r.low == 1 and r.rows == r.high == r.numbers for r in got.collect()) and got.count() == 404
    assert out._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange") >= 3


def test_reconcile_drops_booked_only_rows_before_the_posted_list(spark):
    source = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "source_doc string, source_amount int")
    booked = spark.createDataFrame([("a", 1), ("b", 5), *[(f"only{i}", i) for i in range(50)]], "booked_doc string, booked_amount int")
    posted = spark.createDataFrame([("b",), ("z",)], "doc string")
    for guard, kept in (("missing", [("b", 2), ("c", 3)]), ("differs", [(None, 4), ("c", 3)])):
        out = joins.reconcile(source, booked, [("source_doc", "booked_doc")], ("source_amount", "booked_amount"), posted, "doc", guard)
        assert rows(out, "source_doc", "source_amount") == kept
        plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
        listed, full = (next(i for i, line in enumerate(plan) if f"Join {kind}" in line) for kind in ("LeftOuter", "FullOuter"))
        assert any("Filter" in line for line in plan[listed:full])
