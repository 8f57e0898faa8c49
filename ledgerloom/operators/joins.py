"""Joins beyond plain equality: validity intervals, substring containment, fallbacks, text rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.scalars import ColumnLike, as_col, contains
from ledgerloom.operators.incremental import list_facts
from ledgerloom.operators.skew import in_order, slice_of
from ledgerloom.session import cut_lineage

MOST_CONSTANT = 10_000


def interval_join(left: DataFrame, right: DataFrame, equi: Sequence[tuple[str, str]], at: str,
                  start: str, end: str, how: str = "left", bucket_days: int | None = None) -> DataFrame:
    """Equality keys plus ``at between start and end`` (both ends inclusive).

    Overlapping intervals multiply rows. The equality keys shuffle and the interval is a residual
    test. For keys with long histories ``bucket_days`` adds a time bucket to the equality keys:
    each interval is repeated once per bucket it touches inside the dated range of the left side,
    so a row only meets the intervals of its own bucket. :func:`ranged_interval_join` needs no such number and spreads hot keys.
    """
    right_cols = {c: f"_r_{c}" for c in right.columns}
    renamed = right.withColumnsRenamed(right_cols)
    conditions = [F.col(a) == F.col(right_cols[b]) for a, b in equi]
    conditions.append(F.col(at).between(F.col(right_cols[start]), F.col(right_cols[end])))
    extra = []
    if bucket_days:
        bucket = lambda c: F.floor(F.unix_date(c.cast("date")) / F.lit(bucket_days))
        bounds = left.agg(F.struct(F.min(bucket(F.col(at))).alias("low"), F.max(bucket(F.col(at))).alias("high")))
        renamed = renamed.withColumn("_range", bounds.scalar())
        first = F.greatest(bucket(F.col(right_cols[start])), F.col("_range.low"))
        last = F.least(bucket(F.col(right_cols[end])), F.col("_range.high"))
        touched = F.when(first <= last, F.sequence(first, last))
        renamed = renamed.withColumn("_r_bucket", F.explode(touched)).drop("_range")
        left = left.withColumn("_bucket", bucket(F.col(at)))
        conditions.insert(0, F.col("_bucket") == F.col("_r_bucket"))
        extra = ["_bucket", "_r_bucket"]
    joined = left.join(renamed, reduce(Column.__and__, conditions), how).drop(*extra)
    clash = set(left.columns) & set(right.columns)
    back = {r: c for c, r in right_cols.items() if c not in clash}
    return joined.drop(*[right_cols[c] for c in clash]).withColumnsRenamed(back)


def ranged_interval_join(left: DataFrame, right: DataFrame, equi: Sequence[tuple[str, str]], at: str, start: str, end: str,
                         how: str = "left", partitions: int | None = None) -> DataFrame:
    """:func:`interval_join` for long histories: a row meets the intervals near its own time only, and a key of any size is spread over tasks.

    Rows (by ``at``) and intervals (by ``start``) are sorted together by key and time over range slices and written once. A row meets
    the intervals of its key that begin in its slice, and those that began in an earlier slice and are still open at the first
    time of this one: these are carried over the border. Only the key that a slice opens with can be carried into it, so the table
    of borders has one row per slice and is broadcast. Null keys and times match nothing. ``how`` is ``left`` or ``inner``.
    """
    if how not in ("left", "inner"):
        raise ValueError("an interval join by ranges is left or inner")
    keys = [f"_k{i}" for i in range(len(equi))]
    named = lambda pick: [F.col(pair[pick]).alias(k) for pair, k in zip(equi, keys)]
    struct = lambda df: F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = left.select(*named(0), F.col(at).alias("_time"), F.lit(1).alias("_kind"), struct(left).alias("_l"))
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in (*[b for _, b in equi], start, end)])
    spans = right.where(known).select(*named(1), F.col(start).alias("_time"), F.lit(0).alias("_kind"), F.col(end).alias("_end"), struct(right).alias("_r"))
    both = in_order(rows.unionByName(spans, allowMissingColumns=True), [F.col(c) for c in (*keys, "_time", "_kind")], partitions)
    placed = cut_lineage(both, "ranges").withColumn("_slice", slice_of())

    spans = placed.where("_kind = 0").select(F.col("_slice").alias("_on"), *[F.col(k).alias(f"_r{k}") for k in keys], F.col("_time").alias("_start"), "_end", "_r")
    opens = placed.groupBy("_slice").agg(F.min_by(F.struct(*keys, "_time"), "_place").alias("_b")).select("_slice", "_b.*")
    same = [F.col(k) == F.col(f"_r{k}") for k in keys]
    over = reduce(Column.__and__, same, (F.col("_slice") > F.col("_on")) & (F.col("_time") <= F.col("_end")))
    carried = spans.join(F.broadcast(opens), over).select(F.col("_slice").alias("_on"), *spans.columns[1:])     # one row per slice
    within = F.col("_time").between(F.col("_start"), F.col("_end"))
    rows = placed.where("_kind = 1").select("_slice", *keys, "_time", "_l")
    joined = rows.join(spans.unionByName(carried), reduce(Column.__and__, same, (F.col("_slice") == F.col("_on")) & within), how)
    return joined.select("_l.*", *[F.col("_r").getField(c).alias(c) for c in right.columns if c not in left.columns])


LONGEST_PIECE = 8
BLOCK = 256         # a text is cut into blocks first, so that taking a piece never walks the whole text


def _piece_length(text: str) -> Column:
    size = F.length(text)
    return F.when(size >= LONGEST_PIECE, LONGEST_PIECE).when(size >= 4, 4).when(size >= 2, 2).otherwise(size)


def _pieces(df: DataFrame, text: str, lengths: Column, *keep: str) -> DataFrame:
    """One row per place and length: the ``keep`` columns, ``_at`` (from 0) and ``_piece``. An empty piece stands at 0 only."""
    whole = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{1,{BLOCK + LONGEST_PIECE - 1}}})).{{1,{BLOCK}}}"), F.lit(1))
    blocks = F.when(F.length(text) == 0, F.array(F.lit(""))).otherwise(whole)
    rows = df.select(*keep, lengths.alias("_lengths"), F.posexplode(blocks).alias("_block", "_part"))
    rows = rows.select(*keep, "_block", "_part", F.explode("_lengths").alias("_n"))
    last = F.least(F.lit(BLOCK), F.length("_part") - F.col("_n") + 1)
    piece = lambda at, text: F.struct(at.alias("_at"), text.alias("_piece"))
    cut = F.when(F.col("_n") == 0, F.when(F.col("_block") == 0, F.array(piece(F.lit(0), F.lit(""))))).when(
        last > 0, F.transform(F.sequence(F.lit(1), last), lambda i: piece(
            F.col("_block") * BLOCK + i - 1, F.substr(F.col("_part"), i, F.col("_n")))))
    return rows.select(*keep, F.explode(cut).alias("_p")).select(*keep, "_p.*")


def text_key(text: str) -> Column:
    """A short key of a text, so that joins need not carry the text."""
    return F.unhex(F.sha2(text, 256))


def contains_candidates(hay: DataFrame, hay_col: str, needles: DataFrame, needle_col: str) -> DataFrame:
    """Every pair with ``position(needle in hay) > 0`` once, and few others: ``_text_key`` (see :func:`text_key`) and ``_needle``.

    A text that holds a needle holds every piece of it. Pieces have 8 characters, or 4, 2 or 1 where the needle is shorter. Texts are
    cut at every place, and pieces that no needle has are dropped at once. What is left is written and counted, each needle is joined by the
    piece that the fewest texts have, and a pair goes on if the needle fits into the text at a place of that
    piece. Pieces carry the key of their text alone, so long texts are never repeated per piece. An empty needle lies in every
    text; nulls match nothing.
    """
    needle = needles.select(F.col(needle_col).alias("_needle")).where(F.col("_needle").isNotNull()).distinct()
    needle = needle.withColumn("_q", _piece_length("_needle"))
    # at most five lengths: a scalar, not data
    lengths = needle.agg(F.collect_set("_q")).scalar()
    texts = hay.select(F.col(hay_col).alias("_hay")).where(F.col("_hay").isNotNull()).distinct()
    texts = texts.withColumns({"_text_key": text_key("_hay"), "_size": F.length("_hay")})
    own = _pieces(needle, "_needle", F.array("_q"), "_needle")
    met = _pieces(texts, "_hay", lengths, "_text_key", "_size").join(own.select("_piece").distinct(), "_piece", "left_semi")
    met = cut_lineage(met.groupBy("_text_key", "_size", "_piece").agg(F.min("_at").alias("_first"), F.max("_at").alias("_last")), "pieces")
    common = met.groupBy("_piece").agg(F.count(F.lit(1)).alias("_texts"))
    counted = own.join(common, "_piece", "left").withColumn("_texts", F.coalesce("_texts", F.lit(0)))
    rarest = counted.groupBy("_needle").agg(F.min(F.struct("_texts", "_at", "_piece")).alias("_p")).select("_needle", "_p.*").where("_texts > 0")
    fits = (F.col("_last") >= F.col("_at")) & (F.col("_first") - F.col("_at") + F.length("_needle") <= F.col("_size"))
    return met.join(rarest, "_piece").where(fits).select("_text_key", "_needle")


def contains_join(left: DataFrame, right: DataFrame, hay: str, needle: str,
                  window: tuple[str, str, str] | None = None, how: str = "left",
                  texts: DataFrame | None = None) -> DataFrame:
    """Theta join ``position(right.needle in left.hay) > 0`` with an optional inclusive date window
    ``(left date, right start, right end)``. Substring semantics: id 12 is found in 512.

    ``texts``, a frame with the column ``hay``, names a smaller source of all texts of ``left``, which
    then need not be evaluated to find the pairs. Candidates come from :func:`contains_candidates`, which writes the pieces that texts
    and needles share, and are compared in full where they meet the rows of ``left``."""
    pairs = contains_candidates(left if texts is None else texts, hay, right, needle)
    matched = pairs.join(right, F.col("_needle") == F.col(needle))
    condition = (F.col("_hay_key") == F.col("_text_key")) & F.contains(F.col(hay), F.col("_needle"))
    if window is not None:
        at, start, end = window
        condition = condition & F.col(at).between(F.col(start), F.col(end))
    return left.withColumn("_hay_key", text_key(hay)).join(matched, condition, how).drop("_hay_key", "_text_key", "_needle")


def token_join(left: DataFrame, right: DataFrame, hay: str, needle: str, separator: str = ",",
               how: str = "left") -> DataFrame:
    """Strict variant of :func:`contains_join`: the needle equals one whole token of the list."""
    listed = left.select(F.col(hay).alias("_hay")).distinct()
    tokens = listed.select("_hay", F.explode(F.array_distinct(F.split("_hay", separator))).alias("_token"))
    matched = tokens.join(right, F.col("_token") == F.col(needle)).drop("_token")
    return left.join(matched, F.col(hay) == F.col("_hay"), how).drop("_hay")


def fallback_join(df: DataFrame, dim: DataFrame, dim_key: str, value: str, key_exprs: Sequence[Column],
                  out: str, default: ColumnLike | None = None) -> DataFrame:
    """Try several keys in order against one dimension; first hit wins, else the default."""
    columns, hits = df.columns, []
    for i, expr in enumerate(key_exprs):
        side = dim.select(F.col(dim_key).alias(f"_fk{i}"), F.col(value).alias(f"_fv{i}"))
        # null-safe, so that a hot key can be split although the dimension is grouped by its key
        df = df.join(side.where(F.col(f"_fk{i}").isNotNull()), expr.eqNullSafe(F.col(f"_fk{i}")), "left")
        hits.append(F.col(f"_fv{i}"))
    if default is not None:
        hits.append(as_col(default))
    return df.withColumn(out, F.coalesce(*hits)).select(*dict.fromkeys([*columns, out]))


def rate_join(df: DataFrame, fx: DataFrame, ccy: str, day: str, fx_ccy: str, fx_day: str, rate: str,
              out: str = "to_usd") -> DataFrame:
    """Exchange rate of the currency on exactly that day; a missing day gives null."""
    side = fx.select(F.col(fx_ccy).alias("_ccy"), F.col(fx_day).alias("_day"), F.col(rate).alias(out))
    return df.join(side, (F.col(ccy) == F.col("_ccy")) & (F.col(day) == F.col("_day")), "left").drop("_ccy", "_day")


def constant_dim(df: DataFrame, dim: DataFrame, condition: Column, cols: Sequence[str]) -> DataFrame:
    """Left join to the rows of a dimension that a constant picks; null columns if there is none.

    The few rows of one constant are read as a scalar list, so the main frame is not shuffled. It
    is multiplied if the dimension lists the constant more than once, as a join does. More than ``MOST_CONSTANT`` rows fail the job: such
    a table wants a join. At most one row above that number is gathered.
    """
    some = dim.where(condition).select(*cols).limit(MOST_CONSTANT + 1)
    rows = F.array_sort(F.array_agg(F.struct(*cols)))
    picked = some.agg(F.when(F.count(F.lit(1)) <= MOST_CONSTANT, rows).otherwise(
        F.raise_error(F.lit(f"a constant picks more than {MOST_CONSTANT} rows of a dimension"))).alias("d")).scalar()
    return df.withColumn("_dims", picked).withColumn("_dim", F.explode_outer("_dims")).select(*df.columns, *[F.col(f"_dim.{c}").alias(c) for c in cols])


def member_flag(df: DataFrame, key: Column, members: DataFrame, member_key: str, out: str) -> DataFrame:
    """``key IN (select member_key ..)`` as a column, for use inside an expression."""
    side = members.select(F.col(member_key).alias("_member")).where(F.col("_member").isNotNull()).distinct()
    joined = df.join(side, key.eqNullSafe(F.col("_member")), "left")   # see skew.lookup
    return joined.withColumn(out, F.col("_member").isNotNull()).drop("_member")


def reconcile(source: DataFrame, booked: DataFrame, keys: Sequence[tuple[str, str]], measure: tuple[str, str],
              posted: DataFrame | None = None, posted_key: str | None = None,
              guard: str = "missing", tolerance: float = 0, booked_only: bool = False) -> DataFrame:
    """Full outer comparison of source totals and booked totals, keeping what disagrees.

    A row stays if the amounts differ by more than the tolerance or the source document is not
    booked. Documents in ``posted`` are ignored on the arm named by ``guard`` (``missing`` or
    ``differs``). Rows that exist only on the booked side have no source amount and drop out, unless ``booked_only`` asks
    for them as well.
    """
    src_key, booked_key = keys[0]
    on = reduce(Column.__and__, [F.col(a) == F.col(b) for a, b in keys])
    joined = source.join(booked, on, "full")
    gap = F.col(measure[0]) - F.col(measure[1])
    differs = (F.abs(gap) > tolerance) if tolerance else (F.col(measure[0]) != F.col(measure[1]))
    missing = F.col(booked_key).isNull()
    alone = F.col(src_key).isNull() & ~missing if booked_only else F.lit(False)
    # no other row can stay. Booked rows without a source share a null key: they must not meet in one task of the join below
    joined = joined.where(differs | missing | alone)
    if posted is None:
        return joined
    listed = posted.select(F.col(posted_key or src_key).alias("_posted"))
    joined = joined.join(listed.where(F.col("_posted").isNotNull()).distinct(), F.col(src_key) == F.col("_posted"), "left")
    joined = joined.withColumn("_facts", list_facts(listed, "_posted"))
    unlisted = ~F.col("_facts.has_rows") | (
        ~F.col("_facts.has_null") & F.col(src_key).isNotNull() & F.col("_posted").isNull())
    keep = (differs | (missing & unlisted)) if guard == "missing" else (missing | (differs & unlisted))
    return joined.where(keep | alone).drop("_posted", "_facts")


def text_rule_join(df: DataFrame, rules: DataFrame, equal: Sequence[tuple[Column, str]],
                   contained: tuple[str, Column] | None = None) -> DataFrame:
    """Left join to a rule table on computed equality keys and, optionally, a token of the rule that
    must occur in a text of the row. Rule columns come back with the prefix ``rule_``."""
    side = rules.withColumnsRenamed({c: f"rule_{c}" for c in rules.columns})
    condition = reduce(Column.__and__, [expr == F.col(f"rule_{name}") for expr, name in equal])
    if contained is not None:
        text, token = contained
        condition = condition & contains(text, token)
    return df.join(side, condition, "left")
