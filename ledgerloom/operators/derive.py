"""Row-level derivations, row updates and reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.scalars import ColumnLike, as_col, concat_skip_null, head
from ledgerloom.operators.skew import lookup


def code_map(col: ColumnLike, mapping: Mapping[str, str], default: ColumnLike | None = None) -> Column:
    """Small fixed code map as a literal map lookup; unmapped and null codes give the default."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    found = F.try_element_at(F.create_map(*pairs), as_col(col)) if pairs else F.lit(None).cast("string")
    return found if default is None else F.coalesce(found, as_col(default))


def is_own(owner: ColumnLike, own_set: Sequence[str]) -> Column:
    return as_col(owner).isin(*own_set)


def doc_number(base: ColumnLike, owner: ColumnLike, own_set: Sequence[str], infix: str = "-OBH-",
               keep_unknown: bool = False) -> Column:
    """Own goods keep the number; on-behalf goods get a suffix with the owner.

    An unknown owner gives null, or the bare suffix when ``keep_unknown`` is set.
    """
    suffixed = concat_skip_null(base, F.lit(infix), owner)
    routed = F.when(is_own(owner, own_set), as_col(base))
    return routed.otherwise(suffixed) if keep_unknown else routed.when(as_col(owner).isNotNull(), suffixed)


def owner_route(df: DataFrame, owner: str, own_set: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Own rows and on-behalf rows; rows without an owner go to neither."""
    own = is_own(owner, own_set)
    return df.where(own), df.where(~own)


def parent_sku(sku: ColumnLike, aliases: Mapping[str, str] | None = None, width: int = 4) -> Column:
    return head(code_map(sku, aliases, as_col(sku)) if aliases else as_col(sku), width)


def promo_price(sku: ColumnLike, cost: ColumnLike, funded: Column, funding: ColumnLike,
                promo_cost: ColumnLike) -> Column:
    """Funded SKU: cost plus funding; otherwise the promotion cost, else the cost."""
    return F.when(funded, as_col(cost) + F.coalesce(as_col(funding), F.lit(0))).otherwise(
        F.coalesce(as_col(promo_cost), as_col(cost)))


def obh_expand(df: DataFrame, owner: str, stock: Column, gl_account: str, zero_price: bool = True) -> DataFrame:
    """On-behalf rows as GL lines of quantity 1, plus a zero-amount item line where ``stock`` holds.

    One pass: each row carries an array of its one or two lines.
    """
    price = F.col("unit_price")
    gl = F.struct(
        F.lit("G/L Account").alias("type"), F.lit(gl_account).alias("no"), F.lit(None).cast("string").alias("uom"),
        F.round(price, 2).alias("unit_price"), F.col("discount").alias("discount"),
        F.lit(1).cast(df.schema["quantity"].dataType).alias("quantity"), F.round("amount", 2).alias("amount"),
    )
    item = F.struct(
        F.lit("ITEM").alias("type"), F.col("no").alias("no"), F.lit("pcs").alias("uom"),
        (F.round(price, 2) * 0 if zero_price else F.round(price, 2)).cast("decimal(18,2)").alias("unit_price"),
        (F.lit(0) if zero_price else F.col("discount")).cast(df.schema["discount"].dataType).alias("discount"),
        F.col("quantity").alias("quantity"), F.lit(0).cast("decimal(18,2)").alias("amount"),
    )
    gl = gl.withField("unit_price", gl["unit_price"].cast("decimal(18,2)")).withField(
        "amount", gl["amount"].cast("decimal(18,2)"))
    both = F.when(stock, F.array(gl, item)).otherwise(F.array(gl))
    changed = ["type", "no", "uom", "unit_price", "discount", "quantity", "amount"]
    kept = [c for c in df.columns if c not in changed]
    return df.select(*kept, F.explode(both).alias("_l")).select(*kept, "_l.*")


def split_header_line(df: DataFrame, header: Mapping[str, Column], line: Mapping[str, Column]
                      ) -> tuple[DataFrame, DataFrame]:
    """Distinct header and distinct line projections of one staging frame."""
    return (
        df.select([c.alias(n) for n, c in header.items()]).distinct(),
        df.select([c.alias(n) for n, c in line.items()]).distinct(),
    )


def update_where(df: DataFrame, rules: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """Ordered updates ``(column, condition, value)``; a later rule sees the result of earlier ones."""
    for name, condition, value in rules:
        df = df.withColumn(name, F.when(condition, value).otherwise(F.col(name)))
    return df


def update_from(df: DataFrame, other: DataFrame, key: str, other_key: str, col: str, value: str,
                only_if: Column) -> DataFrame:
    """Fill ``col`` from a frame with one row per key, only where ``only_if`` holds and a row exists."""
    source = other.select(F.col(other_key).alias(key), F.col(value).alias("_new"), F.lit(True).alias("_hit"))
    joined = lookup(df, source, [key])
    return joined.withColumn(
        col, F.when(F.col("_hit") & only_if, F.col("_new")).otherwise(F.col(col))
    ).select(*df.columns)


def constants(df: DataFrame, values: Mapping[str, object], order: Sequence[str] | None = None) -> DataFrame:
    """Add constant columns; Columns are taken as they are, other values become literals."""
    full = df.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in values.items()})
    return full.select(*order) if order else full


def rate_columns(df: DataFrame, rules: Mapping[str, Column], amount: str = "amount") -> DataFrame:
    """Per rule a rate column and ``rate * amount``."""
    rated = df.withColumns({f"{name}_rate": rate for name, rate in rules.items()})
    return rated.withColumns({f"{name}_amt": F.col(f"{name}_rate") * F.col(amount) for name in rules})


def unpivot_rates(df: DataFrame, triples: Sequence[tuple[str, str, str, str]], kept: Sequence[str]) -> DataFrame:
    """Rate columns to rows in one pass; each triple is ``(rate, amount, note, tested column)``."""
    rows = F.array(*[
        F.struct(F.col(rate).alias("rate"), F.col(amt).alias("accrual_amt"), F.lit(note).alias("note"),
                 (F.col(test) != 0).alias("_keep"))
        for rate, amt, note, test in triples
    ])
    exploded = df.select(*kept, F.explode(rows).alias("_r"))
    return exploded.where("_r._keep").select(*kept, "_r.rate", "_r.accrual_amt", "_r.note")


def sku_or_unallocated(item: ColumnLike) -> Column:
    """Spend that names no item is pooled under one label."""
    return F.when(F.upper(as_col(item)).contains("UNALLOCATED"), F.lit("unallocated_asin")).otherwise(as_col(item))
