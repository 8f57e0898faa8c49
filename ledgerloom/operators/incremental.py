"""Snapshot, incremental and state operators: what is newest, what is already posted, what is new.

Lists go into anti and semi joins as they are: a distinct before them would cost an exchange and keep
adaptive execution from splitting a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.sources.ledgers import KeyedLedger


def latest_snapshot(df: DataFrame, ts: str, within: Column | None = None) -> DataFrame:
    """Rows carrying the newest stamp, ties kept; ``within`` limits which rows count (a channel)."""
    scoped = df if within is None else df.where(within)
    return scoped.where(F.col(ts) == scoped.select(F.max(ts)).scalar())


def keys_of(df: DataFrame, key: str, alias: str | None = None) -> DataFrame:
    return df.select(F.col(key).alias(alias or key)).distinct()


def exclude_posted(df: DataFrame, key: str, *lists: tuple[DataFrame, str] | KeyedLedger) -> DataFrame:
    """Rows whose key is in none of the lists; each list is ``(frame, key column)`` or a ledger laid out by key, which is not
    shuffled. Null keys stay."""
    for ledger in lists:
        if isinstance(ledger, KeyedLedger):
            df = ledger.exclude(df, key)
    frames = [other for other in lists if not isinstance(other, KeyedLedger)]
    if not frames:
        return df
    seen = reduce(DataFrame.union, [other.select(F.col(k).alias(key)) for other, k in frames])
    return df.join(seen, key, "left_anti")


def not_in(df: DataFrame, key: str, other: DataFrame | KeyedLedger, other_key: str | None = None,
           null_aware: bool = True) -> DataFrame:
    """``key NOT IN (select other_key from other)``.

    A null in the list empties the result; a null key passes only against an empty list. Done as
    a shuffled anti join and scalar facts about the list, so the list is never broadcast whole.
    """
    if isinstance(other, KeyedLedger):
        return other.not_in(df, key) if null_aware else other.exclude(df, key)
    other_key = other_key or key
    listed = other.select(F.col(other_key).alias(key))
    kept = df.join(listed, key, "left_anti")
    if not null_aware:
        return kept
    facts = list_facts(listed, key)
    columns = df.columns
    return (
        kept.withColumn("_facts", facts)
        .where(~F.col("_facts.has_rows") | (~F.col("_facts.has_null") & F.col(key).isNotNull()))
        .select(*columns)
    )


def list_facts(listed: DataFrame, key: str) -> Column:
    """Whether a list has rows and has a null, as one scalar read in one pass."""
    return listed.agg(F.struct(
        F.coalesce(F.bool_or(F.col(key).isNull()), F.lit(False)).alias("has_null"),
        (F.count(F.lit(1)) > 0).alias("has_rows"),
    )).scalar()


def composite_anti(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a partner on all keys; a null key part never finds one."""
    return df.join(other.select(*keys), list(keys), "left_anti")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order. The rank filter is pushed below the shuffle, so each
    map task sends at most one row per key."""
    rank = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(rank)).where("_rn = 1").drop("_rn")


def promote(daily_h: DataFrame, daily_l: DataFrame, final_h: DataFrame | KeyedLedger, final_l: DataFrame | KeyedLedger,
            header_doc: str = "external_doc_no", line_doc: str = "document_no",
            flag: str = "is_processed") -> tuple[DataFrame, DataFrame]:
    """Daily rows to add to the final tables: unseen headers with flag 0, and unseen distinct lines
    of documents whose daily header has flag 0."""
    open_h = daily_h.where(F.col(flag) == 0)
    new_h = not_in(open_h, header_doc, final_h, header_doc)
    new_l = not_in(daily_l, line_doc, final_l, line_doc)
    new_l = new_l.join(open_h.select(F.col(header_doc).alias(line_doc)), line_doc, "left_semi")
    return new_h, new_l.select(*daily_l.columns).distinct()


def rollover(history: DataFrame, log: DataFrame, keys: Sequence[str], as_of: date, stamp: str,
             posting: str = "posting_date", document: str = "document_date", amount: str = "amount",
             flag: str = "is_processed") -> DataFrame:
    """Daily ledger: history posted before next month, flagged 2, and unseen non-zero rows of the
    newest log load."""
    limit = F.lit(next_month(as_of))
    kept = history.where(F.col(posting) < limit).withColumn(flag, F.lit(2))
    fresh = latest_snapshot(log, stamp).where(F.col(document) < limit)
    fresh = composite_anti(fresh, kept.where(F.col(document) < limit), keys)
    fresh = fresh.where((F.col(amount) != 0) & (F.col(posting) < limit))
    return kept.unionByName(fresh)


def status_flip(daily: DataFrame, final: DataFrame, keys: Sequence[str], cutoff: date,
                posting: str = "posting_date", amount: str = "amount",
                flag: str = "is_processed") -> DataFrame:
    """Final ledger after promotion: unseen non-zero daily rows up to the cut-off join the ledger,
    then flag 2 becomes 0."""
    fresh = composite_anti(daily, final, keys)
    fresh = fresh.where((F.col(amount) != 0) & (F.col(posting).cast("date") <= F.lit(cutoff)))
    merged = final.unionByName(fresh)
    return merged.withColumn(flag, F.when(F.col(flag) == 2, F.lit(0)).otherwise(F.col(flag)))


def incremental(df: DataFrame, ledger: DataFrame, key: str, ledger_key: str | None = None) -> DataFrame:
    """Rows whose key is not in the ledger, with null equal to null."""
    seen = ledger.select(F.col(ledger_key or key).alias("_seen"))
    return df.join(seen, F.col(key).eqNullSafe(F.col("_seen")), "left_anti")


def unbooked(detail: DataFrame, detail_key: str, paid: DataFrame, paid_key: str,
             *booked: tuple[DataFrame, str]) -> DataFrame:
    """Detail rows of keys that are paid but in none of the booked sets."""
    open_keys = exclude_posted(paid.select(F.col(paid_key).alias(detail_key)), detail_key, *booked)
    return detail.join(open_keys, detail_key, "left_semi")


def next_month(as_of: date) -> date:
    return date(as_of.year + as_of.month // 12, as_of.month % 12 + 1, 1)
