"""Window-like operators in forms that hold for hot and for ungrouped input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.operators.skew import global_positions, lookup, row_number_by, with_group_totals


def line_numbers(df: DataFrame, doc: str | Sequence[str], order: Sequence[Column], step: int = 10000,
                 out: str = "line_no", scanned: bool = False) -> DataFrame:
    """Line numbers in steps per document. The order should cover all business columns: rows that
    still tie are identical, so any numbering of them is the same result. The rows are written on the way: select what
    is needed first. (``scanned`` has no effect any more: rows of every origin are written once.)"""
    keys = [doc] if isinstance(doc, str) else list(doc)
    numbered = row_number_by(df, keys, order, out)
    return numbered.withColumn(out, F.col(out) * step)


def dense_rank_global(df: DataFrame, key: str, out: str = "rank", partitions: int | None = None) -> DataFrame:
    """``dense_rank() over (order by key)`` without one partition for all rows: the distinct keys
    are ranged and numbered, and the ranks joined back. A null key ranks last."""
    keys = df.select(key).distinct()
    ranks = global_positions(keys, [F.col(key).asc_nulls_last()], partitions, ties=False)
    ranks = ranks.select(F.col(key).alias("_rank_key"), (F.col("_pos") + 1).alias(out))
    return df.join(ranks, F.col(key).eqNullSafe(F.col("_rank_key")), "left").drop("_rank_key")


def allocate(df: DataFrame, part: str, total: str, base: str, weight: str, out: str = "allocated",
             sums: DataFrame | None = None) -> DataFrame:
    """Spread what is left of an invoice total over its rows by weight:
    ``(total - sum(base)) / sum(weight) * weight`` per invoice. A zero weight sum gives null.

    The product is taken before the division, so decimals are rounded once. ``sums``, rows of
    (``part``, ``_base``, ``_weight``), spares the second evaluation of ``df`` where a smaller frame has them.
    """
    if sums is None:
        summed = with_group_totals(df, [part], {"_base": F.sum(base), "_weight": F.sum(weight)})
    else:
        summed = lookup(df, sums, [part], "left")
    left = F.col(total) - F.col("_base")
    share = left * F.col(weight) / F.when(F.col("_weight") != 0, F.col("_weight"))
    return summed.withColumn(out, share).drop("_base", "_weight")


def share_allocate(df: DataFrame, part: Sequence[str], total: str, spend: str,
                   pct: str = "spend_pct", out: str = "allocated") -> DataFrame:
    """Spread a campaign amount over items by their share of its spend."""
    summed = with_group_totals(df, part, {"_spend": F.sum(spend)})
    whole = F.when(F.col("_spend") != 0, F.col("_spend"))
    return summed.withColumns({
        pct: F.col(spend) / whole, out: F.col(total) * F.col(spend) / whole}).drop("_spend")
