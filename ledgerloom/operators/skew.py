"""Helpers that keep one hot key from landing in one task.

Joins leave skew to adaptive execution, which splits a hot join partition. A window cannot be
split that way, so rows are numbered in range slices of bounded size and the slices are chained by
one offset each. There is one route for every key, however many rows it has.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.session import cut_lineage

def lookup(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equality join to a side that was grouped by the same keys, in a form that can be split.

    With plain equality the grouped side keeps its partitioning, its aggregate sits between the
    join and the shuffle, and adaptive execution then leaves a hot key of the left side whole.
    Null-safe keys make the small side shuffle once more, after which a hot key is split. Null
    keys do not match.
    """
    on = list(on)
    named = right.where(reduce(Column.__and__, [F.col(k).isNotNull() for k in on])).withColumnsRenamed(
        {k: f"_on_{k}" for k in on})
    condition = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_on_{k}")) for k in on])
    joined = left.join(named, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_on_{k}" for k in on])


def in_order(df: DataFrame, order: Sequence[Column], partitions: int | None = None, ties: bool = True,
             out: str = "_place") -> DataFrame:
    """Sort rows over range slices and add ``out``: number of the slice and place in it, as one long value.

    Nothing is written here. The value holds for the rows as they are written from this frame, in one pass: write it with them and read
    it back. With ``ties`` even equal rows are spread, by the task that they come from. That is known again when a task runs
    once more, so the rows of a lost task go where they went before.
    """
    count = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = list(order)
    if ties:
        df = df.withColumn("_tie", F.spark_partition_id())
        keys.append(F.col("_tie"))
    ranged = df.repartitionByRange(count, *keys).sortWithinPartitions(*keys)
    return ranged.drop("_tie").withColumn(out, F.monotonically_increasing_id())


def slice_of(place: str = "_place") -> Column:
    return F.shiftright(place, 33)


def in_slice(place: str = "_place") -> Column:
    return F.col(place).bitwiseAND(F.lit((1 << 33) - 1))


def _ranged(df: DataFrame, order: Sequence[Column], partitions: int | None = None, ties: bool = True) -> DataFrame:
    """Add ``_slice`` and ``_in_slice``, the 0-based place of every row in its slice of the total order. The ranged rows are
    written out, so that slices and places stay fixed if executors are lost."""
    ranged = cut_lineage(in_order(df, order, partitions, ties), "positions")
    return ranged.withColumn("_slice", slice_of()).withColumn("_in_slice", in_slice()).drop("_place")


def numbers_from_places(rows: DataFrame, keys: Sequence[str], place: str, out: str, writes: Sequence[str] = (),
                        weight: Column | None = None, keep_slice: bool = False) -> DataFrame:
    """Row numbers per key from the places that the rows of a written frame stand at (see :func:`in_order`).

    Rows of a key are neighbours in the order. They are counted inside each slice, and the rows of a key that began in an earlier slice
    are moved on by what that slice holds of it: one key per slice at most. ``writes`` name the write that a row
    comes from, where there are several. A row stands for ``weight`` rows (one, if not given) and gets the number of the first of them. With
    ``keep_slice`` its slice stays as ``_slice``; the result is partitioned and sorted by it, the writes and the keys.
    """
    keys = [*writes, *keys]
    stands_for = F.lit(1) if weight is None else weight
    part = slice_of(place)
    # only the key that a slice opens with can have begun before it: the rows of these keys alone are counted
    named = rows.select(part.alias("_s"), F.col(place).alias("_at"), stands_for.alias("_w"), *[F.col(k).alias(f"_k_{k}") for k in keys])
    start = named.groupBy("_s", *[F.col(f"_k_{w}").alias(f"_w_{w}") for w in writes]).agg(F.min("_at").alias("_first"))
    first = reduce(Column.__and__, [F.col(f"_k_{w}").eqNullSafe(F.col(f"_w_{w}")) for w in writes], F.col("_at") == F.col("_first"))
    opens = named.join(F.broadcast(start.drop("_s")), first).select(*[F.col(f"_k_{k}").alias(f"_o_{k}") for k in keys]).distinct()
    opened = reduce(Column.__and__, [F.col(f"_k_{k}").eqNullSafe(F.col(f"_o_{k}")) for k in keys])
    held = named.join(F.broadcast(opens), opened).groupBy("_s", *[f"_k_{k}" for k in keys]).agg(F.sum("_w").alias("_n"))
    before = Window.partitionBy(*[f"_k_{k}" for k in keys]).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    moved = held.withColumn("_moved", F.sum("_n").over(before)).where("_moved > 0").drop("_n")
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], F.col("_slice") == F.col("_s"))
    rows = rows.withColumn("_slice", part)
    inside = Window.partitionBy("_slice", *keys).orderBy(place)
    first_of = F.row_number().over(inside) if weight is None else (
        F.sum(stands_for).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - stands_for + 1)
    rows = rows.withColumn("_inside", first_of)
    numbered = rows.join(F.broadcast(moved), same, "left")      # one row per slice at most
    number = (F.col("_inside") + F.coalesce("_moved", F.lit(0))).cast("long")
    return numbered.withColumn(out, number).drop(*([] if keep_slice else ["_slice"]), "_inside", "_moved", "_s", *[f"_k_{k}" for k in keys])


def global_positions(df: DataFrame, order: Sequence[Column], partitions: int | None = None,
                     ties: bool = True) -> DataFrame:
    """Add ``_slice`` and ``_pos``, the 0-based position of every row in the total order.

    Only one row per range is used to turn positions inside a slice into global ones.
    """
    placed = _ranged(df, order, partitions, ties)
    sizes = placed.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.join(F.broadcast(offsets), "_slice")   # one row per range partition
        .withColumn("_pos", F.col("_offset") + F.col("_in_slice"))
        .drop("_offset", "_in_slice")
    )


def row_number_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str) -> DataFrame:
    """``row_number() over (partition by keys order by order)`` that survives a hot key.

    Rows are sorted by keys and order over range slices and written once; numbers follow from the places. Equal rows are spread
    over slices as well.
    """
    keys = list(keys)
    placed = cut_lineage(in_order(df, [*[F.col(k) for k in keys], *order]), "positions")
    return numbers_from_places(placed, keys, "_place", out).drop("_place")


def with_group_totals(df: DataFrame, keys: Sequence[str], totals: dict[str, Column]) -> DataFrame:
    """Add group totals to every row, as ``agg over (partition by keys)`` with null keys as a group.

    Pre-aggregated map-side and joined back on one row per key: a hot group never has to be held
    by one task, and adaptive execution may split its rows in the join.
    """
    keys = list(keys)
    sums = df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in totals.items()])
    sums = sums.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    condition = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return df.join(sums, condition, "left").drop(*[f"_k_{k}" for k in keys])
