"""Aggregations. All are combinable map-side, so a hot group costs its partial rows only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.scalars import ColumnLike, as_col
from ledgerloom.operators.skew import in_order, lookup
from ledgerloom.session import cut_lineage


def completeness(df: DataFrame, doc: str, status: str, ok: Sequence[str], cancelled: Sequence[str]) -> DataFrame:
    """Documents whose lines are all settled or cancelled, with at least one settled."""
    counts = df.groupBy(doc).agg(
        F.count(F.lit(1)).alias("line_count"),
        F.count_if(F.col(status).isin(*ok)).alias("success_line"),
        F.count_if(F.col(status).isin(*cancelled)).alias("cancelled_line"),
    )
    return counts.where("success_line + cancelled_line = line_count and success_line <> 0")


def unique_or_unknown(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with exactly one distinct non-null value. Minimum and maximum decide it, so no distinct
    values have to be gathered."""
    bounds = df.groupBy(key).agg(F.min(value).alias(value), F.max(value).alias("_max"))
    return bounds.where(F.col(value) == F.col("_max")).drop("_max")


def string_distinct(name: str, separator: str) -> Column:
    """Distinct values in ascending order, joined; nulls are skipped and an empty group is null.

    Spark makes the pairs of group and value distinct before it lists them, over all tasks.
    """
    text = f"cast(`{name}` as string)"
    return F.expr(f"listagg(distinct {text}, '{separator}') within group (order by {text})")


def distinct_lists(df: DataFrame, keys: Sequence[str], lists: Mapping[str, tuple[str, str]],
                   counts: Mapping[str, str] | None = None) -> DataFrame:
    """Several lists like :func:`string_distinct` per group: ``lists`` names column and separator of each,
    ``counts`` the output for the number of entries of a list.

    The frame is read once; triples of group, list and value are made distinct over all tasks before
    they are listed.
    """
    entries = [F.struct(F.lit(out).alias("_what"), F.col(name).cast("string").alias("_value")) for out, (name, _) in lists.items()]
    pairs = df.select(*keys, F.explode(F.array(*entries)).alias("_p")).select(*keys, "_p.*").distinct()
    value = lambda out: f"case when _what = '{out}' then _value end"
    listed = [F.expr(f"listagg({value(out)}, '{sep}') within group (order by {value(out)})").alias(out) for out, (_, sep) in lists.items()]
    counted = [F.count(F.expr(value(out))).alias(name) for out, name in (counts or {}).items()]
    return pairs.groupBy(*keys).agg(*listed, *counted)


def string_list(name: str, separator: str) -> Column:
    """All values in ascending order (a stated order makes the result repeatable). One task sorts a group: for
    groups without a bound see :func:`ordered_lists`."""
    text = f"cast(`{name}` as string)"
    return F.expr(f"listagg({text}, '{separator}') within group (order by {text})")


def ordered_lists(df: DataFrame, keys: Sequence[str], value: str, separator: str, out: str) -> DataFrame:
    """:func:`string_list` per group for groups of any size: one row of ``keys`` and ``out`` each.

    Rows are sorted by group and value over range slices and written. Partial lists hold at most 65,536 neighbouring rows, and
    the partial lists of a group are joined in their order; no task sorts a whole group. The joined text itself is one row
    and has to stay below 2 GB.
    """
    picked = df.select(*keys, F.col(value).cast("string").alias("_value"))
    placed = cut_lineage(in_order(picked, [F.col(c) for c in (*keys, "_value")]), "lists")
    parts = placed.groupBy(*keys, F.shiftright("_place", 16).alias("_part")).agg(string_list("_value", separator).alias("_text"))
    listed = F.collect_list(F.when(F.col("_text").isNotNull(), F.struct("_part", "_text")))
    whole = parts.groupBy(*keys).agg(F.array_sort(listed).alias("_parts"))
    return whole.select(*keys, F.when(F.size("_parts") > 0, F.array_join("_parts._text", separator)).alias(out))


def group_constant(df: DataFrame, label: str, name: str, *aggs: Column) -> DataFrame:
    """``GROUP BY 'literal'``: no row on empty input, unlike a global aggregate."""
    return df.groupBy(F.lit(label).alias(name)).agg(*aggs)


def nonzero_sum(df: DataFrame, keys: Sequence[str], value: ColumnLike, out: str, scale: int = 2) -> DataFrame:
    """Group sums, rounded, without groups whose unrounded sum is zero or null."""
    sums = df.groupBy(*keys).agg(F.sum(as_col(value)).alias("_sum"))
    return sums.where("_sum <> 0").select(*keys, F.round("_sum", scale).alias(out))


def mixed_owner_docs(header: DataFrame, doc: str, owner: str, main: str, secondary: Sequence[str]) -> DataFrame:
    """Documents with several owners, among them the main one and a secondary one."""
    facts = header.groupBy(doc).agg(
        F.bool_or(F.col(owner) == main).alias("_main"),
        F.bool_or(F.col(owner).isin(*secondary)).alias("_second"),
    )
    return facts.where("_main and _second").select(doc)


def drop_secondary_owners(header: DataFrame, doc: str, owner: str, main: str, secondary: Sequence[str]) -> DataFrame:
    """Of documents with the main and a secondary owner, remove the secondary owners' headers."""
    second = F.col(owner).isin(*secondary)
    mixed = mixed_owner_docs(header, doc, owner, main, secondary).withColumn("_mixed", F.lit(True))
    joined = lookup(header, mixed, [doc])
    return joined.where(F.col("_mixed").isNull() | ~F.coalesce(second, F.lit(False))).select(*header.columns)


def pivot_sum(when: Column, value: ColumnLike) -> Column:
    return F.sum(F.when(when, as_col(value)))
