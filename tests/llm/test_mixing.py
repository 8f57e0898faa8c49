from fractions import Fraction

from pyspark.sql import functions as F

from ledgerloom.llm import mixing
from tests.llm.data import empty, frame, messy


def targets(sizes, weights=(3, 1, 2)):
    """The stated rule, round by round, in exact fractions."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    out, free, left = {}, set(order), Fraction(3 * sum(sizes.values()), 2)
    while True:
        part = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if part[s] > 2 * sizes[s]}
        if not over:
            return {**out, **part}
        for s in over:
            out[s] = Fraction(2 * sizes[s])
            left -= 2 * sizes[s]
        free -= over


def test_targets_and_takings(spark):
    rows = messy()
    got = mixing.mix(frame(spark, rows), keep=["size", "kept", "doc_id"]).collect()
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").encode().split())
    goal, taken = targets(sizes), {}
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - float(goal[r.source])) < 1e-6
        assert r.taken == r["copies"] * r["size"] <= 2 * r["size"] and r.kept_doc_id == r.doc_id and r.kept_size == 3
        taken[r.source] = taken.get(r.source, 0) + r.taken
    largest = {}
    for _, t, _, s in rows:
        largest[s] = max(largest.get(s, 0), len((t or "").encode().split()))
    assert all(abs(taken[s] - float(goal[s])) <= largest[s] / 2 + 1 for s in sizes)
    again = mixing.mix(frame(spark, rows).repartition(7), keep=["size", "kept", "doc_id"]).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_importance_changes_the_odds_only(spark):
    rows = [(i, "w " * 10, "en", "ab"[i % 2]) for i in range(2000)]
    df = frame(spark, rows).withColumn("good", F.when(F.col("doc_id") < 1000, 3).otherwise(1))
    out = mixing.mix(df, weights=(1, 9), share=(1, 2), importance="good").where("source = 'a'")
    share = {r[0]: r[1] for r in out.groupBy((F.col("doc_id") < 1000).alias("g")).agg(F.avg("copies")).collect()}
    assert 2.2 < share[True] / share[False] < 4 and abs(out.agg(F.sum("taken")).first()[0] - 1000) <= 10


def chances(sizes, left):
    """Inclusion probabilities in proportion to the worth, certain documents taken out one round after the other."""
    worth, certain = [int(16 * n ** 0.5) for n in sizes], set()
    while True:
        free = [i for i in range(len(sizes)) if i not in certain]
        rate = (left - sum(sizes[i] for i in certain)) / sum(worth[i] * sizes[i] for i in free)
        over = {i for i in free if worth[i] * rate > 1 + 1e-12}
        if not over:
            return [1.0 if i in certain else worth[i] * rate for i in range(len(sizes))]
        certain |= over


def test_inclusion_frequencies_match_unequal_chances(spark):
    """One source for each of 500 seeds: the ids differ, and the random numbers with them."""
    sizes = [1, 2, 3, 5, 8, 12, 20, 30, 45, 60] * 6 + [400, 900]
    rows = [(1000 * s + i, "w " * n, "en", f"s{s:03}") for s in range(500) for i, n in enumerate(sizes)]
    out = mixing.mix(frame(spark, rows), weights=(1,), share=(4, 5)).collect()
    expected = chances(sizes, 0.8 * sum(sizes))
    assert expected[-1] == expected[-2] == 1.0 and max(expected[:-2]) < 1 and min(expected) < 0.3
    taken = [0] * len(sizes)
    for r in out:
        taken[r.doc_id % 1000] += r["copies"]
    assert taken[-1] == taken[-2] == 500
    for n in set(sizes):
        here = [i for i, x in enumerate(sizes) if x == n]
        assert abs(sum(taken[i] for i in here) / 500 / len(here) - expected[here[0]]) < 0.05
    # the words stay near the target in every source
    words = {}
    for r in out:
        words[r.source] = words.get(r.source, 0) + r.taken
    assert max(abs(w - 0.8 * sum(sizes)) for w in words.values()) <= 30


def test_order_differs_from_that_of_the_random_numbers(spark):
    rows = [(i, "w " * (1 + i * 7 % 90), "en", "a") for i in range(400)]
    df = frame(spark, rows).withColumn("u", mixing.uniform("doc_id", "text", "mix"))
    out = mixing.mix(df, weights=(1,), share=(1, 2), keep=["u"]).collect()
    assert max(r.kept_u for r in out if r["copies"]) > 2 * min(r.kept_u for r in out if not r["copies"])
    flat = mixing.mix(df.withColumn("same", F.lit(2)), weights=(1,), share=(1, 2), keep=["u"], importance="same").collect()
    assert max(r.kept_u for r in flat if r["copies"]) <= min(r.kept_u for r in flat if not r["copies"])


def test_edge_tables(spark):
    assert mixing.mix(empty(spark)).collect() == []
    only_empty = mixing.mix(frame(spark, [(1, None, None, None), (2, "", None, "a")])).collect()
    assert [(r["size"], r.target, r.taken) for r in only_empty] == [(0, 0.0, 0)] * 2
    one = mixing.mix(frame(spark, [(1, "a b", None, None)])).collect()
    assert one[0].target == 3.0 and one[0].taken in (2, 4)
