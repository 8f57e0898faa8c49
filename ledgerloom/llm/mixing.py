"""Mixing sources to target weights by Pareto order sampling, with DataFrame functions only.

*Targets.* Sources in code-point order, null last, get the given weights in turn and share ``share`` of all
words. A target stops at ``most`` times the source's own size; the excess is shared anew by weight among the
others until none is above. That fixed point has a closed form: order the sources by size over weight; the
first ones are capped, and the rest get their weight's part of what is left.

*Certain copies.* A source whose target is ``r`` times its size takes floor(r) whole copies of every document.

*Chances.* What is left of the target is filled by a sample with unequal inclusion probabilities. A document's worth is the root of its
size, or its ``importance`` if that is given, as a whole number of steps. Probabilities are in proportion to it and such that the expected words
are what is left. Where that would be above 1 the document is certain, and its excess goes to the others of the source, until none is above.
This fixed point is read off the sums of words for each worth, from the largest down; there are at most as many rows as steps.

*Sampling.* Documents are taken in Pareto order: rank by the odds of a random number over the odds of the inclusion probability,
until the words reach what is left. The random number comes from the id and the text alone, so reruns and other partitionings agree.

The order is cut without sorting a source in one task: certain documents come first, the others' ranks are counted in ``SLOTS`` slots a source,
sums of words locate, in two levels of 256, the slot where the target is reached, and only the documents in that slot are ordered.

Defined results: a null or empty text has size 0 and takes 0 words; a null source is a source; equal rows count
each for itself; a source of size 0 has target 0. Extra columns stay where ``keep`` names them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.common import written
from ledgerloom.operators.skew import lookup

WEIGHTS = (3, 1, 2)
SHARE = (3, 2)        # 150 % of all words, as a fraction of whole numbers
MOST = 2
SLOTS = 1 << 16
STEPS = 1 << 16       # steps of a given importance, up to the largest of the source
ROOT_STEPS = 16       # steps of the root of a size: 16 for one word


def word_count(text: str) -> Column:
    r"""Number of ``[^\x20\x09-\x0D]+`` in a text; null counts 0."""
    return F.coalesce(F.expr(rf"regexp_count(`{text}`, '[^\\x20\\x09-\\x0D]+')"), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    One row per source: the windows below order sources, not documents.
    """
    turn = Window.orderBy(F.col("source").isNull(), "source")
    nth = F.row_number().over(turn) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(nth, F.lit(len(weights))) + 1).cast("int"))
    all_ = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = sizes.withColumn("weight", weight.cast("long"))
    t = t.withColumn("total", F.sum("source_size").over(all_)).withColumn("weights", F.sum("weight").over(all_))
    first = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    up, down = share
    # left * down words and the weights of the sources not capped before this one, in whole numbers
    t = (t.withColumn("left", F.lit(up) * F.col("total") - F.lit(down * most) * F.coalesce(F.sum("source_size").over(first), F.lit(0)))
         .withColumn("rest", F.col("weights") - F.coalesce(F.sum("weight").over(first), F.lit(0))))
    capped = F.col("weight") * F.col("left") >= F.lit(down * most) * F.col("source_size") * F.col("rest")
    t = t.withColumn("capped", capped)
    free = ~F.col("capped")
    t = t.withColumn("free_left", F.max(F.when(free, F.struct("rest", "left"))).over(all_))
    open_ = F.col("weight") * F.col("free_left.left") / (F.lit(down) * F.col("free_left.rest"))
    return t.select("source", "source_size", F.when(F.col("capped"), (F.lit(most) * F.col("source_size")).cast("double")).otherwise(open_).alias("target"))


def uniform(doc_id: str, text: str, seed: str) -> Column:
    """A number in (0, 1) from 52 bits of a digest of seed, id and text."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")), F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def inclusion_rates(worths: DataFrame) -> DataFrame:
    """(s, highest, rest, weighted) for each source, from its words by worth: documents worth more than ``highest`` are certain, the
    others' probability is worth * rest / weighted."""
    above = Window.partitionBy("source").orderBy(F.desc("worth")).rowsBetween(Window.unboundedPreceding, -1)
    up_to = Window.partitionBy("source").orderBy("worth").rowsBetween(Window.unboundedPreceding, 0)
    rest = F.col("left") - F.coalesce(F.sum("words").over(above), F.lit(0))
    t = worths.where("left > 0 and words > 0 and worth > 0").select(
        "source", "worth", rest.alias("rest"), F.sum(F.col("worth") * F.col("words")).over(up_to).alias("weighted"))
    t = t.where(F.col("worth") * F.col("rest") <= F.col("weighted")).groupBy("source").agg(F.max(F.struct("worth", "rest", "weighted")).alias("w"))
    return t.select(F.col("source").alias("s"), F.col("w.worth").alias("highest"), "w.rest", "w.weighted")


def reached(slots: DataFrame) -> DataFrame:
    """The slot of each source in which the words, from ``start`` on, reach what is left; ``before`` are the words below it."""
    below = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    sums = slots.withColumn("before", F.col("start") + F.coalesce(F.sum("words").over(below), F.lit(0)))
    return sums.where((F.col("before") < F.col("left")) & (F.col("before") + F.col("words") >= F.col("left")))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST, seed: str = "mix",
        keep: Sequence[str] = (), importance: str | None = None, doc_id: str = "doc_id", text: str = "text",
        source: str = "source") -> DataFrame:
    """Per row of ``docs``: doc_id, source, size, source_size, target, copies, taken (copies * size), and the columns of ``keep``."""
    given = F.greatest(F.coalesce(F.col(f"`{importance}`").cast("double"), F.lit(0.0)), F.lit(0.0)) if importance else F.lit(None).cast("double")
    base = written(docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), word_count(text).alias("size"),
        uniform(doc_id, text, seed).alias("u"), given.alias("given"),
        F.struct(*[F.col(f"`{c}`") for c in keep] or [F.lit(1).alias("none")]).alias("kept")), "mix")
    sources = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.max("given").alias("top"))
    targets = source_targets(sources.select("source", "source_size"), weights, share, most)
    plan = targets.join(sources.select(F.col("source").alias("s"), "top"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    ratio = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    whole = F.floor(ratio)
    plan = written(plan.select(
        F.col("source").alias("s"), "source_size", "target", "top", whole.alias("whole"),
        F.when(ratio > whole, F.col("target") - whole * F.col("source_size")).otherwise(0.0).alias("left")), "mix-plan")
    worth = F.ceil(STEPS * F.col("given") / F.nullif(F.col("top"), F.lit(0.0))) if importance else F.floor(ROOT_STEPS * F.sqrt("size"))
    docs_ = base.join(plan, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("worth", F.coalesce(worth, F.lit(0)).cast("long"))
    rates = inclusion_rates(docs_.groupBy("source", "worth").agg(F.sum("size").alias("words"), F.first("left").alias("left")))
    docs_ = docs_.join(rates, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    certain = (F.col("left") > 0) & (F.col("worth") > F.col("highest"))
    chance = F.when(certain, 1.0).otherwise(F.coalesce(F.col("worth") * F.col("rest") / F.col("weighted"), F.lit(0.0)))
    odds = F.col("u") / (1 - F.col("u"))
    rank = F.when(chance >= 1, 0.0).when(chance > 0, odds * (1 - chance) / chance).otherwise(F.lit(float("inf")))
    docs_ = docs_.withColumn("rank", rank).drop("worth", "highest", "rest", "weighted")
    place = F.when(F.col("rank") == F.lit(float("inf")), 1.0).otherwise(F.col("rank") / (1 + F.col("rank")))
    # slot 0 is for the certain ones
    slot = F.when(F.col("rank") == 0, 0).otherwise(1 + F.least(F.floor(F.col("place") * (SLOTS - 1)), F.lit(SLOTS - 2)))
    docs_ = docs_.withColumn("place", place).withColumn("slot", slot.cast("int"))

    counted = written(docs_.groupBy("source", "slot").agg(F.sum("size").alias("words"), F.first("left").alias("left")), "mix-slots")
    coarse = counted.groupBy("source", F.shiftright("slot", 8).alias("slot")).agg(F.sum("words").alias("words"), F.first("left").alias("left"))
    group = reached(coarse.withColumn("start", F.lit(0).cast("long"))).select(F.col("source").alias("s"), F.col("slot").alias("group"), F.col("before").alias("start"))
    fine = counted.join(group, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("slot", 8) == F.col("group"))).drop("s")
    # slots below the cut are taken, slots above it are not
    cut = reached(fine).select(F.col("source").alias("s"), F.col("slot").alias("cut"), "before")
    full = plan.select(F.col("s").alias("source"), "left")
    ends = written(full.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").select(
        F.col("source").alias("s"), F.coalesce("cut", F.when(F.col("left") > 0, SLOTS).otherwise(-1)).alias("cut"), F.coalesce("before", F.lit(0)).alias("before")), "mix-cuts")
    docs_ = docs_.join(ends, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    order = Window.partitionBy("source").orderBy("place", "u", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    sure = F.col("slot") == 0
    at_cut = docs_.where((F.col("slot") == F.col("cut")) & ~sure).withColumn("reached", F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0)))
    # a document is taken if at least half of it lies below what is left
    at_cut = at_cut.withColumn("more", (2 * F.col("reached") + F.col("size") <= 2 * F.col("left")).cast("long")).drop("reached")
    others = docs_.where((F.col("slot") != F.col("cut")) | sure).withColumn("more", (sure | (F.col("slot") < F.col("cut"))).cast("long"))
    copies = F.least(F.col("whole") + F.col("more"), F.lit(most)).cast("long")
    return others.unionByName(at_cut).withColumn("copies", F.when(F.col("size") == 0, 0).otherwise(copies).cast("long")).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
        *[F.col(f"kept.`{c}`").alias(f"kept_{c}") for c in keep])
