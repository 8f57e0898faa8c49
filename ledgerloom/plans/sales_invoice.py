"""Sales-invoice channels: candidate rows per channel, then one shared document pipeline.

Candidates are built from raw marketplace tables, written to an append-only snapshot log with one
load stamp, read back from the newest load, freed of what is already posted, routed to own or
on-behalf documents and split into headers and lines.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ledgerloom.functions.scalars import (
    as_col, concat_skip_null, dated_doc, head, posting_date, posting_description, tail, unit_price,
)
from ledgerloom.operators.aggs import completeness, drop_secondary_owners, string_distinct, unique_or_unknown
from ledgerloom.operators.derive import (
    code_map, doc_number, obh_expand, parent_sku, promo_price, update_from, update_where,
)
from ledgerloom.operators.incremental import composite_anti, incremental, latest_per_key, latest_snapshot, not_in
from ledgerloom.operators.joins import constant_dim, contains_join, fallback_join, interval_join, member_flag
from ledgerloom.operators.skew import in_order, lookup, numbers_from_places, slice_of
from ledgerloom.operators.windows import line_numbers
from ledgerloom.plans import config as c
from ledgerloom.plans.config import ChannelConfig
from ledgerloom.schemas import _MONEY, HEADER, LINE, SNAPSHOT, conform
from ledgerloom.session import cut_lineage
from ledgerloom.sources.versions import SNAPSHOT_COL, SNAPSHOT_PARTITION, SnapshotLog

Tables = Mapping[str, DataFrame]

LINE_STEP = 10000
# what a placed load has besides the snapshot layout: the document lines are numbered in, their place, the write they belong to, and,
# of lines that differ in their amount alone, all amounts in order. Such lines are one row with the first amount; null stands for that one
NUMBERED_IN, PLACE, WRITE, AMOUNTS = "numbered_in", "log_place", "log_write", "amounts"
ONE_AMOUNT_EACH = StructField(AMOUNTS, ArrayType(_MONEY))
# part of a document: slice of a write, number of the document, whether it has none
IN_SLICE = ["_slice", "_write", "_document", "_unnumbered"]
PLACES = StructType([StructField(NUMBERED_IN, StringType()), StructField(PLACE, LongType()), StructField(WRITE, StringType()), ONE_AMOUNT_EACH])


# ---- shared pieces ------------------------------------------------------------------------------
def as_candidates(df: DataFrame, fixed: Mapping[str, object], line_order: Sequence[str], run_ts: datetime,
                  number_by: str = "external_doc_no", numbered: bool = True, placed: bool = False) -> DataFrame:
    """Add the channel's constants and, if ``numbered``, the line numbers, in the snapshot layout.

    Numbering writes the rows. A reader of amounts alone does without it; line numbers are then null. Rows that go into a
    snapshot log anyway are ``placed`` instead: sorted over range slices for the write of the log itself, each with the document that it is
    numbered in and its place. :func:`numbered_load` takes the numbers from what was written.
    """
    base = {"document_type": "Order", "source_code": "DATAMART_SI", "type": "ITEM", "uom": "pcs",
            "vat_product_posting_group": "VAT-NOT", "is_valid_record": True, "data_updated_time": run_ts}
    values = {k: v if isinstance(v, Column) else F.lit(v) for k, v in {**base, **fixed}.items()}
    if not numbered and not placed:
        return conform(df.withColumns(values), SNAPSHOT)
    # sorting and numbering move the rows, so what they do not need is added after them
    early = {k: values.pop(k) for k in (number_by, *line_order) if k in values}
    rows, order = df.withColumns(early), [F.col(o) for o in line_order]
    if not placed:
        return conform(line_numbers(rows, number_by, order).withColumns(values), SNAPSHOT)
    rows = in_order(rows, [F.col(number_by), *order], out=PLACE).withColumn(NUMBERED_IN, F.col(number_by))
    rows = rows.withColumns({**values, WRITE: F.lit(uuid.uuid4().hex)})
    return conform(rows, StructType([*SNAPSHOT.fields, *PLACES.fields]))


def numbered_load(load: DataFrame) -> DataFrame:
    """A load of placed candidates, whole as it was written, with line numbers instead of places and a row for each line."""
    return line_per_amount(first_numbers(by_slice(load)).drop(*IN_SLICE))


def by_slice(load: DataFrame) -> DataFrame:
    """A placed load with :data:`IN_SLICE`, the parts of documents that its rows are numbered in. None of them is null, so joins find them."""
    load = load.withColumn(PLACE, F.coalesce(PLACE, F.lit(-1)))
    parts = [slice_of(PLACE), F.coalesce(WRITE, F.lit("")), F.coalesce(NUMBERED_IN, F.lit("")), F.col(NUMBERED_IN).isNull()]
    return load.withColumns(dict(zip(IN_SLICE, parts))).drop(WRITE, NUMBERED_IN)


def first_numbers(load: DataFrame) -> DataFrame:
    """:func:`numbered_load` with lines that differ in their amount alone still in one row, which has the number of the first."""
    weight = F.coalesce(F.size(AMOUNTS), F.lit(1)) if AMOUNTS in load.columns else None
    rows = numbers_from_places(load, IN_SLICE[2:], PLACE, "_number", writes=IN_SLICE[1:2], weight=weight, keep_slice=True)
    return rows.withColumn("line_no", F.col("_number") * LINE_STEP).drop("_number", PLACE)


def line_per_amount(rows: DataFrame) -> DataFrame:
    """A row for each line, where rows hold the amounts of several."""
    if AMOUNTS not in rows.columns:
        return rows
    kept = [c for c in rows.columns if c != AMOUNTS]
    each = rows.select(*kept, F.posexplode(F.coalesce(AMOUNTS, F.array("amount"))).alias("_nth", "_amount"))
    return each.withColumns({"line_no": F.col("line_no") + F.col("_nth") * LINE_STEP, "amount": F.col("_amount")}).select(*kept)


def lines_in_one(lines: DataFrame, order: Sequence[str], amounts: str) -> DataFrame:
    """One row for the amounts of lines that are equal in all other columns: :data:`AMOUNTS` in order, and the first as ``amount``.

    Lines that are equal by ``order`` alone are numbered by their amounts, mixed, so they get a row for each amount. ``order`` names
    the lines of a document, so a key gathers what one line of an order gives.
    """
    rest = [c for c in lines.columns if c not in (*order, amounts)]
    tied = lines.groupBy(*order).agg(F.collect_list(F.struct(F.struct(*rest).alias("rest"), F.col(amounts).alias("all"))).alias("_t"))
    row = lambda of, values: F.struct(of.alias("rest"), values.alias("all"))
    alike = F.array(row(F.col("_t")[0]["rest"], F.sort_array(F.flatten("_t.all"))))
    mixed = F.flatten(F.transform("_t", lambda x: F.transform(x["all"], lambda a: row(x["rest"], F.array(a)))))
    rows = F.when(F.size(F.array_distinct("_t.rest")) == 1, alike).otherwise(mixed)
    rows = tied.select(*order, F.explode(rows).alias("_r")).select(*order, "_r.rest.*", F.col("_r.all").alias("_all"))
    return rows.select(*order, *rest, F.col("_all")[0].alias("amount"), F.when(F.size("_all") > 1, F.col("_all")).alias(AMOUNTS))


def item_owners(items: DataFrame, company: str) -> DataFrame:
    """Distinct owner rows of the item master for one company, written: a join that knows their size need not move the rows to them."""
    owned = items.where(F.col("original_company_id") == company)
    return cut_lineage(owned.select(F.col("item_id").alias("_item"), "belong_to_company", "customer_posting_group").distinct(), "owners")


def warehouse_locations(transactions: DataFrame, channel: str, since: date) -> DataFrame:
    """Location per transaction, only where all its real movements name one location."""
    moved = transactions.where(
        (F.col("transaction") == channel) & (F.col("log_date") >= F.lit(since)) & F.col("ims_id").isNotNull()
        & (F.col("qty") != 0) & ~F.coalesce((F.col("ims_id") == 0) & (F.col("log_id") == 0), F.lit(False))
    )
    located = moved.select(
        "transaction_id", code_map("warehouse", c.WAREHOUSE_LOCATION, F.lit(c.UNIDENTIFIED)).alias("location"))
    return unique_or_unknown(located, "transaction_id", "location")


def header_layout(staging: DataFrame, name: Column) -> DataFrame:
    """Distinct header rows of a staging frame."""
    renamed = staging.withColumnsRenamed({"payment_term": "payment_term_code", "wh_location": "location"})
    renamed = renamed.withColumn("name", name)
    if "is_processed" not in renamed.columns:
        renamed = renamed.withColumn("is_processed", F.lit(0))
    return conform(renamed, HEADER).distinct()


def line_layout(staging: DataFrame, once: bool = True) -> DataFrame:
    """Distinct line rows of a staging frame, money rounded to cents. Without ``once`` equal lines stay, for a caller that makes them distinct."""
    renamed = staging.withColumnsRenamed(
        {"external_doc_no": "document_no", "wh_location": "location_code", "asin": "original_asin_sku"})
    money = {"unit_price": F.round("unit_price", 2), "amount": F.round("amount", 2)}
    if AMOUNTS not in renamed.columns:
        rows = conform(renamed.withColumns(money), LINE)
        return rows.distinct() if once else rows
    # a row and its amounts are what a line and its number are: equal rows are the same lines
    rows = conform(renamed.withColumns(money), StructType([*LINE.fields, ONE_AMOUNT_EACH]))
    return line_per_amount(rows.distinct() if once else rows)


def stage_own(candidates: DataFrame, tables: Tables, cfg: ChannelConfig, as_of: date) -> DataFrame:
    """Own-goods staging rows that are not posted yet."""
    return stage(candidates, tables, cfg, as_of).where("_own").drop("_own")


def stage_on_behalf(candidates: DataFrame, tables: Tables, cfg: ChannelConfig, as_of: date) -> DataFrame:
    return stage(candidates, tables, cfg, as_of).where("not _own").drop("_own")


def stage(rows: DataFrame, tables: Tables, cfg: ChannelConfig, as_of: date, places: DataFrame | None = None,
          load: DataFrame | None = None) -> DataFrame:
    """Staging rows that are not posted yet, own and on-behalf goods told apart by ``_own``, from one pass over the candidates.

    ``places``, a frame of ``transaction_id`` and ``location``, gives own rows without a location theirs. What is posted and placed is asked
    for the rows themselves or, where they were numbered from the places of a ``load``, for the keys of its documents alone: the rows then stay
    where their numbering has put them.
    """
    rows = routed(rows, cfg, as_of)
    if load is None:
        rows = still_open(rows, tables, cfg, places)
    else:
        keys = open_keys(cfg, places)
        documents = still_open(routed(load, cfg, as_of).select(*IN_SLICE, "_own", *keys).distinct(), tables, cfg, places)
        # written, so that the files of its joins are gone before the rows move
        documents = cut_lineage(documents, "open").withColumnsRenamed({name: f"_of_{name}" for name in (*IN_SLICE, "_own", *keys)})
        there = reduce(Column.__and__, [F.col(name) == F.col(f"_of_{name}") for name in IN_SLICE])
        same = reduce(Column.__and__, [alike(F.col(name), F.col(f"_of_{name}")) for name in ("_own", *keys)])
        rows = rows.join(documents, there & same).select(*[name for name in rows.columns if name not in IN_SLICE], "_place")
    by_rule = F.lit(True) if cfg.obh_posting_by_rule else F.col("_own")
    stamp = F.col("order_date") if cfg.description_by_order_date else F.lit(as_of)
    place = F.when((F.col("wh_location") == c.UNIDENTIFIED) & F.col("_place").isNotNull(), F.col("_place")).otherwise(F.col("wh_location"))
    return rows.withColumns({
        "posting_date": F.when(by_rule, posting_date("order_date", as_of, cfg.legacy_month_number)).otherwise(F.lit(as_of)),
        "posting_description": posting_description("country", "sales_channel", "external_doc_no", stamp),
        "wh_location": F.when(F.col("_own"), place).otherwise(cfg.obh_location() if cfg.obh_location else F.col("wh_location")),
    }).drop("_place")


def routed(rows: DataFrame, cfg: ChannelConfig, as_of: date) -> DataFrame:
    """Valid rows of the period with their branch; a row without an owner goes to neither."""
    rows = rows.where(F.col("is_valid_record") & F.col("order_date").between(F.lit(cfg.date_from), F.lit(as_of)))
    return rows.withColumn("_own", F.col("belong_to_company").isin(*cfg.own)).where("_own is not null")


def open_keys(cfg: ChannelConfig, places: DataFrame | None) -> list[str]:
    """Columns that tell what is posted and placed."""
    return list(dict.fromkeys([cfg.posted_key, *(["po_number"] if cfg.po_exclusion else []), *([] if places is None else [cfg.evidence_key])]))


def alike(a: Column, b: Column) -> Column:
    """``a <=> b`` as a test on the pairs of a join. An equality would become one of its keys, and rows would move to meet by it."""
    return ((a <= b) & (a >= b)) | (a.isNull() & b.isNull())


def still_open(rows: DataFrame, tables: Tables, cfg: ChannelConfig, places: DataFrame | None) -> DataFrame:
    """Rows that are not posted yet, with ``_place``, the location that is known for their key in ``places``.

    The lists of what is posted differ between own and on-behalf goods, so an entry names the branch that it counts for.
    """
    own, on_behalf = F.lit(True), F.lit(False)
    counts = F.upper("document_type").isin(*cfg.posted_types)
    for name, values in cfg.posted_scope.items():
        counts = counts & F.col(name).isin(*values)
    # an original number is shared with returns, so there the document type counts for both branches
    for_obh = F.lit(True) if cfg.posted_key == "external_doc_no" else counts
    branches = F.explode(F.array_compact(F.array(F.when(counts, own), F.when(for_obh, on_behalf))))
    seen = tables["posted_header"].select(F.col(cfg.posted_key), branches.alias("_own"))
    if cfg.use_excluded:
        seen = seen.union(tables["excluded"].select(F.col("external_doc_no"), own))
    rows = composite_anti(rows, seen, [cfg.posted_key, "_own"])
    known = None if places is None else places.select(F.col("transaction_id").alias(cfg.evidence_key), F.col("location").alias("_place"))
    if cfg.po_exclusion:
        shipped = tables["posted_line"].where(~F.col("location_code").rlike("SRT")).select("po_number")
        if known is not None and cfg.evidence_key == "po_number":
            # both are known by the purchase order: put together, the rows meet them at once
            listed = shipped.distinct().withColumn("_shipped", F.lit(True))
            rows = lookup(rows, listed.join(known, "po_number", "full"), ["po_number"])
            return rows.where(~(F.col("_own") & F.coalesce("_shipped", F.lit(False)))).drop("_shipped")
        rows = composite_anti(rows, shipped.withColumn("_own", own), ["po_number", "_own"])
    return rows.withColumn("_place", F.lit(None).cast("string")) if known is None else lookup(rows, known, [cfg.evidence_key])


def columns_read(cfg: ChannelConfig, shown: Sequence[str]) -> set[str]:
    """Columns of candidates that the ``shown`` columns of :func:`document_lines` are made of, and those that the rows are picked, numbered
    and expanded by."""
    made_of = {"document_no": "external_doc_no", "location_code": "wh_location", "location": "wh_location", "original_asin_sku": "asin",
               "payment_term_code": "payment_term", "name": "bill_to_customer", "header_country": "country"}
    by = ["external_doc_no", "order_date", "is_valid_record", "wh_location", "internal_sales_channel", "belong_to_company", cfg.posted_key, "country",
          "sales_channel", "type", "no", "uom", "unit_price", "discount", "quantity", "amount", NUMBERED_IN, PLACE, WRITE, AMOUNTS]
    by += [cfg.evidence_key] if cfg.evidence else []
    by += ["po_number"] if cfg.po_exclusion else []
    return {*by, "line_no", *[made_of.get(name, name) for name in shown]}


def run_channel(candidates: DataFrame | None, tables: Tables, cfg: ChannelConfig, as_of: date,
                snapshot_log: SnapshotLog | DataFrame | None = None, evidence_since: date | None = None,
                extra_invoices: DataFrame | None = None, shipments: DataFrame | None = None,
                shown: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Headers and lines of one channel as of a day.

    The staged rows of both branches are written once; headers and lines are read from them. A reader of some columns of
    :func:`document_lines` alone names them in ``shown``: rows then move without the others, which are null or not to be used, and equal lines
    are left to :func:`daily_documents`. What ``cfg`` itself looks at beyond the owner and the place has to be among them.

    ``snapshot_log``, when given, is the log the candidates were written to: the newest load *of
    this channel* is read from it, so a channel without new rows does not pick up another's load. A :class:`SnapshotLog` knows that load
    without reading others. Where its rows are placed but not numbered, they are numbered here.
    """
    cut = lambda df: df if shown is None else df.select(*[n for n in df.columns if n in columns_read(cfg, shown)])
    rows, load = candidates, None
    ours = F.col("internal_sales_channel").isin(*cfg.channels)
    if isinstance(snapshot_log, SnapshotLog):
        rows = snapshot_log.newest(*[[channel] for channel in cfg.channels]).drop(SNAPSHOT_PARTITION)
    elif snapshot_log is not None:
        stamp = SNAPSHOT_PARTITION if SNAPSHOT_PARTITION in snapshot_log.columns else SNAPSHOT_COL
        # other channels of the same write may hold lines of the same documents
        rows = snapshot_log.where(F.col(stamp) == snapshot_log.where(ours).select(F.max(stamp)).scalar()).drop(SNAPSHOT_PARTITION)
    rows = cut(rows)
    if snapshot_log is not None and PLACE in rows.columns:
        placed = by_slice(rows)
        rows, load = first_numbers(placed).where(ours), placed.where(ours)
    elif snapshot_log is not None:
        rows = rows.where(ours)
    places = warehouse_locations(tables["transactions"], cfg.evidence, evidence_since or cfg.date_from) if cfg.evidence else None
    both = cut_lineage(stage(rows, tables, cfg, as_of, places, load), "staged")
    own, obh = both.where("_own").drop("_own"), both.where("not _own").drop("_own")
    header_rows = line_rows = own
    if extra_invoices is not None:
        header_rows, line_rows = reclass_extra(own, extra_invoices)
    header = header_layout(header_rows, F.lit(None).cast("string"))
    line = line_layout(line_rows, once=shown is None)

    header = header.unionByName(header_layout(obh, F.col("bill_to_customer")))
    stock = cfg.obh_stock() if cfg.obh_stock else F.lit(False)
    line = line.unionByName(line_layout(
        obh_expand(line_per_amount(obh), "belong_to_company", stock, c.OBH_ACCOUNT, cfg.obh_zero_price), once=shown is None))
    if shipments is not None:
        header, line = apply_shipments(header, line, shipments, cfg.own)
    return finish(header, line, cfg)


def add_in(rows: DataFrame, posted: DataFrame, fixed: Mapping[str, object], key: str = "external_doc_no",
           posted_key: str = "external_doc_no", vat_from: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Headers and lines of manually supplied documents that are not posted yet (null equals null).

    ``fixed`` holds constant or derived columns. ``vat_amount`` of the lines is taken from the rows if they
    have it and is null otherwise; ``vat_from`` names another column to take it from.
    """
    fresh = incremental(rows, posted, key, posted_key)
    fresh = fresh.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in fixed.items()})
    fresh = fresh.withColumns({k: F.lit(None).cast("double") for k in ("unit_price", "amount") if k not in fresh.columns})
    if vat_from:
        fresh = fresh.withColumn("vat_amount", F.col(vat_from))
    name = F.col("name") if "name" in fresh.columns else F.lit(None).cast("string")
    return header_layout(fresh, name), line_layout(fresh)


def daily_documents(runs: Sequence[tuple[DataFrame, DataFrame]], shown: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Daily header and line tables of all channels of a run.

    They are built anew from the channels' results, so a run that is repeated gives the same tables and
    doubles nothing; write them with :func:`ledgerloom.sources.versions.publish`. With ``shown`` they have the
    columns that :func:`document_lines` needs for these alone, and its rows are distinct without comparing them again.
    """
    header, line = (reduce(DataFrame.unionByName, frames) for frames in zip(*runs))
    if shown is not None:
        header = header.select(*[source for source, name in FACTS.items() if name in ("document_no", *shown)])
        line = line.select(*[name for name in line.columns if name in ("document_no", *shown)])
    return header.distinct(), line.distinct()


def finish(header: DataFrame, line: DataFrame, cfg: ChannelConfig) -> tuple[DataFrame, DataFrame]:
    """Closing updates on all documents of the channel."""
    line = update_where(line, [("uom", F.col("no").isin(*c.NO_UOM_ACCOUNTS), F.lit(None))])
    header = header.withColumns({
        "is_processed": F.coalesce("is_processed", F.lit(0)),
        "customer_posting_group": F.lit(c.POSTING_GROUP),
        "name": code_map("belong_to_company", c.OWNER_VENDOR, F.col("name")),
    })
    if cfg.dedupe_owners:
        header = update_where(header, [("country", F.col("location") == c.CAN_3PL_LOCATION, F.lit("REG-CAN"))])
        line = update_where(line, [("country", F.col("location_code") == c.CAN_3PL_LOCATION, F.lit("REG-CAN"))])
        secondary = [o for o in cfg.own if o != cfg.main]
        header = drop_secondary_owners(header, "external_doc_no", "belong_to_company", cfg.main, secondary)
    return header, line


def reclass_extra(staging: DataFrame, extra: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Invoices without a purchase: header without location and flagged 2, lines to another account."""
    listed = extra.where((F.upper("type_of_invoice") == "EXTRA INVOICE") | (F.col("invoice_vendor") == 0))
    marked = member_flag(staging, F.col("external_doc_no"), listed, "invoice_no", "_extra")
    header = marked.withColumns({
        "wh_location": F.when(~F.col("_extra"), F.col("wh_location")),
        "is_processed": F.when(F.col("_extra"), 2).otherwise(0),
    })
    line = marked.withColumns({
        "type": F.when(F.col("_extra"), F.lit("G/L Account")).otherwise(F.col("type")),
        "no": F.when(F.col("_extra"), F.lit(c.EXTRA_INVOICE_ACCOUNT)).otherwise(F.col("no")),
        "uom": F.when(~F.col("_extra"), F.col("uom")),
    })
    return header.drop("_extra"), line.drop("_extra")


def shipment_locations(shipments: DataFrame) -> DataFrame:
    """Location per document from the newest state of each shipment.

    The newest row is picked before its list of purchase orders is exploded; of several cities the
    first in precedence wins.
    """
    newest = latest_per_key(shipments, ["shipment_id"], [
        F.col("run_date").desc_nulls_first(), "purchase_order", "reference_id", "ship_from_city"])
    ranks = {city: str(i) for i, city in enumerate(c.SHIP_CITY_LOCATION)}
    orders = newest.where((F.col("purchase_order") != "") & F.col("ship_from_city").isin(*ranks)).select(
        F.explode(F.split("purchase_order", ",")).alias("po"), "reference_id",
        F.struct(code_map("ship_from_city", ranks).cast("int").alias("rank"),
                 code_map("ship_from_city", c.SHIP_CITY_LOCATION).alias("location")).alias("place"))
    docs = orders.select(concat_skip_null("po", F.lit("_"), "reference_id").alias("_doc"), "place")
    return docs.groupBy("_doc").agg(F.min("place").alias("place")).select("_doc", F.col("place.location").alias("_ship"))


def apply_shipments(header: DataFrame, line: DataFrame, shipments: DataFrame, own: Sequence[str]
                    ) -> tuple[DataFrame, DataFrame]:
    """Overwrite locations by shipment, then send on-behalf import documents to their own location."""
    # one row per document, read by headers and lines: written once
    places = cut_lineage(shipment_locations(shipments), "shipped")
    header = update_from(header, places, "external_doc_no", "_doc", "location", "_ship", F.lit(True))
    import_obh = ~F.col("belong_to_company").isin(*own) & (F.col("internal_sales_channel") == "AVC DI")
    # read for their own sake and for the lines of some: written, too
    header = cut_lineage(update_where(header, [("location", import_obh, F.lit(c.OBH_IMPORT_LOCATION))]), "headers")
    docs = header.where(import_obh).select(F.col("external_doc_no").alias("_doc"), F.lit(c.OBH_IMPORT_LOCATION).alias("_import")).distinct()
    # what is known of a document is put together first, so that its lines move once; the import goes before the shipment
    known = places.join(docs, "_doc", "full").select("_doc", F.coalesce("_import", "_ship").alias("_at"))
    return header, cut_lineage(update_from(line, known, "document_no", "_doc", "location_code", "_at", F.lit(True)), "lines")


# header columns a reader of lines needs, and their names beside those of the line
FACTS = {"external_doc_no": "document_no", "country": "header_country", **{name: name for name in (
    "order_date", "posting_date", "posting_description", "location", "currency", "internal_sales_channel", "belong_to_company", "name",
    "payment_term_code", "is_processed")}}


def document_lines(header: DataFrame, line: DataFrame) -> DataFrame:
    """Lines with the header facts a reader needs."""
    facts = header.select(*[F.col(source).alias(name) for source, name in FACTS.items() if source in header.columns])
    return line.join(facts, "document_no", "left")


# ---- candidates per channel ---------------------------------------------------------------------
def settlement_candidates(t: Tables, as_of: date, run_ts: datetime, since: date, owner: str, company: str,
                          numbered: bool = True,
                          placed: bool = False) -> DataFrame:
    """Settled sale rows; one document per purchase order and report date."""
    rows = t["settlements"].where(
        (F.col("transaction_type") == "SALE") & F.col("settlement_date").between(F.lit(since), F.lit(as_of)))
    price = F.coalesce(F.when(F.col("original_item_price") != 0, F.col("original_item_price")), F.col("product_price"))
    rows = rows.select(
        F.col("settlement_date").alias("order_date"), F.col("settlement_date").alias("document_date"),
        dated_doc("po_id", "report_date").alias("external_doc_no"), head("sku", 4).alias("no"),
        unit_price(price, "ship_qty").alias("unit_price"), F.col("ship_qty").alias("quantity"),
        F.round(price, 2).alias("amount"), F.col("po_id").alias("po_number"),
        F.col("po_id").alias("original_external_doc_no"), F.col("sku").alias("asin"))
    rows = constant_dim(rows, t["companies"], F.col("company_code") == company, ["company_id"])
    return as_candidates(rows, {
        "bill_to_customer": c.CUSTOMER_WM, "sell_to_customer": c.CUSTOMER_WM, "platform": "PLF-WM-1",
        "customer_posting_group": c.POSTING_GROUP, "payment_term": "14D", "wh_location": c.UNIDENTIFIED,
        "sales_channel": "CHAN-WMMKP", "country": "REG-USA", "internal_sales_channel": "WM WFS",
        "original_company_id": company, "belong_to_company": owner,
    }, ["asin", "amount", "quantity", "order_date"], run_ts, numbered=numbered, placed=placed)


def dropship_candidates(t: Tables, as_of: date, run_ts: datetime, since: date, owner: str, company: str,
                        orders_since: date, sku_alias: Mapping[str, str] | None = None, numbered: bool = True,
                        placed: bool = False) -> DataFrame:
    """Lines of fully settled orders, priced with promotions found through the catalogue item ids.

    A line gets a row for each promotion of its day. Placed, these stay in one row (see :data:`AMOUNTS`), so that sorting, writing, numbering and
    the lists of what is posted cost what the lines cost.
    """
    lines = t["order_lines"].where(F.col("order_date").cast("date").between(F.lit(orders_since), F.lit(as_of)))
    settled = completeness(lines, "purchase_order_id", "order_line_status", ["Delivered", "Shipped"], ["Cancelled"])
    catalogue = latest_snapshot(t["catalogue"], "run_date")
    ids = catalogue.where((F.col("fulfillment_method") == "DSV") & (F.col("site_status") != "UNPUBLISHED"))
    ids = ids.groupBy("supplier_stock_id").agg(string_distinct("item_id", ",").alias("item_ids"))
    log = latest_snapshot(t["promo_log"], "data_updated_time").select(
        F.col("item_id").alias("promo_item"), "current_cost",
        F.col("promo_start_1").alias("log_start"), F.col("promo_end_1").alias("log_end"))
    sheet = latest_snapshot(t["promo_sheet"], "run_time").select(
        F.col("sku_supplier_stock_id").alias("sheet_sku"), "funding_amount",
        F.col("promo_start_1").alias("sheet_start"), F.col("promo_end_1").alias("sheet_end"))

    rows = lookup(lines.where(F.col("order_date") >= F.lit(since)), settled, ["purchase_order_id"], "left_semi")
    posted = t["posted_header"].where(
        (F.col("document_type") == "Order") & (F.col("internal_sales_channel") == "WM DSV"))
    rows = not_in(rows, "purchase_order_id", posted, "original_external_doc_no")
    rows = rows.withColumn("raw_sku", F.col("item_sku")).withColumn(
        "item_sku", code_map("item_sku", sku_alias, F.col("item_sku")) if sku_alias else F.col("item_sku"))
    # promotions are found once per list of ids; a line carries the catalogue key of its list, never the text, which grows with the catalogue
    offers = contains_join(ids, log, "item_ids", "promo_item", how="inner").select(
        F.col("supplier_stock_id").alias("listed_as"), "current_cost", "log_start", "log_end")
    listed = ids.where(F.col("item_ids").isNotNull()).select("supplier_stock_id", F.col("supplier_stock_id").alias("listed_as"))
    rows = fallback_join(rows, listed, "supplier_stock_id", "listed_as",
                         [F.col("item_sku"), head("item_sku", 4)], "listed_as")
    rows = rows.withColumn("order_day", F.col("order_date").cast("date"))
    rows = interval_join(rows, sheet, [("item_sku", "sheet_sku")], "order_day", "sheet_start", "sheet_end")
    rows = member_flag(rows, F.col("item_sku"), sheet.withColumnRenamed("sheet_sku", "_s"), "_s", "funded")
    gtin = catalogue.where(F.col("product_gtin").isNotNull()).select(
        F.col("product_gtin").alias("gtin"), F.col("supplier_stock_id").alias("gtin_sku")).distinct()
    rows = rows.join(gtin, F.col("item_sku") == F.col("gtin"), "left")
    # a line has a price for each promotion of its day: one row until its numbers are given
    offers = offers.groupBy("listed_as").agg(F.collect_list(F.struct("current_cost", "log_start", "log_end")).alias("_offers"))
    rows = lookup(rows, offers, ["listed_as"])
    valid = F.filter("_offers", lambda o: F.col("order_date").between(o["log_start"], o["log_end"]))
    costs = F.when(F.size(valid) > 0, F.transform(valid, lambda o: o["current_cost"])).otherwise(
        F.array(F.lit(None).cast(log.schema["current_cost"].dataType)))
    quantity = F.col("order_line_quantity_amount").cast("decimal(18,4)")
    price = lambda cost: promo_price("item_sku", "unit_cost_by_logic", F.col("funded"), "funding_amount", cost)
    order = ["external_doc_no", "asin", "order_line_id", "unit_price", "quantity"]
    rows = rows.select(
        F.col("order_day").alias("order_date"), F.col("order_day").alias("document_date"),
        F.col("purchase_order_id").alias("external_doc_no"),
        F.when(F.col("gtin").isNotNull(), head("gtin_sku", 4)).otherwise(head("item_sku", 4)).alias("no"),
        F.round("unit_cost_by_logic", 2).alias("unit_price"), quantity.alias("quantity"),
        F.transform(costs, lambda cost: F.round(quantity * F.round(price(cost), 2), 2)).alias("_amounts"),
        F.col("purchase_order_id").alias("po_number"),
        F.col("purchase_order_id").alias("original_external_doc_no"), F.col("item_sku").alias("asin"),
        "order_line_id")
    rows = lines_in_one(rows, order, "_amounts") if placed else rows.withColumn("amount", F.explode("_amounts")).drop("_amounts")
    rows = constant_dim(rows, t["companies"], F.col("company_code") == company, ["company_id"])
    return as_candidates(rows, {
        "bill_to_customer": c.CUSTOMER_WM, "sell_to_customer": c.CUSTOMER_WM, "platform": "PLF-WM-1",
        "customer_posting_group": c.POSTING_GROUP, "payment_term": "60D", "wh_location": c.UNIDENTIFIED,
        "sales_channel": "CHAN-WMDSV", "country": "REG-USA", "internal_sales_channel": "WM DSV",
        "original_company_id": company, "belong_to_company": owner,
    }, [*order[1:], "amount"], run_ts, numbered=numbered, placed=placed)


def basecost_candidates(t: Tables, as_of: date, run_ts: datetime, since: date, own: Sequence[str], company: str,
                        item_company: str, accounts: Mapping[str, str], castle_locations: Mapping[str, str],
                        skip_invoices: Sequence[str] = (), numbered: bool = True,
                        placed: bool = False) -> DataFrame:
    """Invoices priced with the base cost valid when the order was placed.

    ``accounts`` maps account name to region, ``castle_locations`` account name to the location of
    orders that never appeared in the drop-ship export.
    """
    num = F.col("invoice_num")
    invoices = t["invoices"].where(
        (F.col("amount") > 0) & F.col("invoice_date").cast("date").between(F.lit(since), F.lit(as_of))
        & ~tail(num, 3).like("%CM%") & ~num.like("%SAP Credit%"))
    if skip_invoices:
        invoices = invoices.where(~num.isin(*skip_invoices))
    orders = t["orders_export"].where(F.col("order_status") != "Cancelled").select(
        "po_number", "item_number", "po_date_time", "quantity", "wholesale_price")
    sold = invoices.withColumnRenamed("account_name", "account").join(
        orders, F.col("po_num") == F.col("po_number"), "inner")
    rows = interval_join(sold, t["base_cost"], [("item_number", "supplier_part_number"), ("account", "account_name")],
                         "po_date_time", "effective_from", "effective_to")
    rows = rows.join(item_owners(t["items"], item_company), head("item_number", 4) == F.col("_item"), "left")
    rows = member_flag(rows, F.col("po_number"), t["dropship_export"], "order_id", "exported")
    owner = F.col("belong_to_company")
    is_own = owner.isin(*own)
    location = (
        F.when(owner == c.STOCK_OWNERS[0], F.lit(c.OBH_STOCK_LOCATION))
        .when(~F.col("exported") & ~is_own, F.lit(c.OBH_IMPORT_LOCATION))
        .when(~F.col("exported") & is_own, code_map("account", castle_locations))
        .otherwise(F.lit(c.UNIDENTIFIED)))
    rows = rows.select(
        F.col("invoice_date").cast("date").alias("order_date"), F.col("invoice_date").cast("date").alias("document_date"),
        "customer_posting_group", doc_number(num, owner, own).alias("external_doc_no"),
        doc_number(num, owner, own, keep_unknown=True).alias("numbering_doc"),
        location.alias("wh_location"), F.when(F.col("currency") != "USD", F.col("currency")).alias("currency"),
        code_map("account", accounts).alias("country"), head("item_number", 4).alias("no"),
        F.lit("").alias("description"), F.col("wholesale_price").alias("unit_price"), "quantity",
        F.round(F.col("base_cost") * F.col("quantity"), 2).alias("amount"), F.col("po_num").alias("po_number"),
        F.when(F.col("exported"), F.lit("WF")).otherwise(F.lit("WF CG")).alias("internal_sales_channel"),
        num.alias("original_external_doc_no"), F.col("item_number").alias("asin"), "belong_to_company")
    rows = constant_dim(rows, t["companies"], F.col("company_code") == company, ["company_id"])
    return as_candidates(rows, {
        "bill_to_customer": c.CUSTOMER_WF, "sell_to_customer": c.CUSTOMER_WF, "platform": "PLF-WF-1",
        "payment_term": "60D", "sales_channel": "CHAN-WAYFAIR", "original_company_id": company,
    }, ["asin", "unit_price", "quantity", "amount"], run_ts, number_by="numbering_doc", numbered=numbered, placed=placed)


def direct_fulfil_candidates(t: Tables, as_of: date, run_ts: datetime, since: date, own: Sequence[str], company: str,
                             no_stock: Sequence[str] = c.NO_STOCK_OWNERS, numbered: bool = True,
                             placed: bool = False) -> DataFrame:
    """Item lines of accepted direct-fulfilment invoices."""
    heads = t["df_summary"].where(
        F.col("invoicedate").cast("date").between(F.lit(since), F.lit(as_of)) & (F.col("status") != "REJECTED"))
    rows = t["df_items"].join(heads.select("invoicenumber", "invoicedate", "country"), "invoicenumber")
    profile = t["profiles"].select(
        F.col("platform_prd_id").alias("asin"), "country", F.col("pims_sku").alias("sku"))
    rows = rows.join(profile, ["asin", "country"], "left")
    rows = rows.join(item_owners(t["items"], company), F.col("sku") == F.col("_item"), "left")
    owner = F.col("belong_to_company")
    location = (
        F.when(owner.isin(*own), F.lit(c.UNIDENTIFIED))
        .when(F.upper(owner).isin(*no_stock), F.lit(None))
        .otherwise(F.lit(c.OBH_STOCK_LOCATION)))
    rows = rows.select(
        F.col("invoicedate").cast("date").alias("order_date"), F.col("invoicedate").cast("date").alias("document_date"),
        "customer_posting_group", doc_number("invoicenumber", owner, own).alias("external_doc_no"),
        doc_number("invoicenumber", owner, own, keep_unknown=True).alias("numbering_doc"),
        location.alias("wh_location"), code_map("country", {k: c.REGION[k] for k in ("USA", "CAN")}).alias("country"),
        F.col("sku").alias("no"), unit_price("subtotal", "quantity").alias("unit_price"), "quantity",
        F.round("subtotal", 2).alias("amount"), F.col("invoicenumber").alias("po_number"),
        F.col("invoicenumber").alias("original_external_doc_no"), "asin", "belong_to_company")
    rows = constant_dim(rows, t["companies"], F.col("company_code") == company, ["company_id"])
    return as_candidates(rows, {
        "bill_to_customer": c.CUSTOMER_AMZ, "sell_to_customer": c.CUSTOMER_AMZ, "platform": "PLF-AMZ-1",
        "payment_term": "60D", "sales_channel": "CHAN-AVC", "internal_sales_channel": "AVC DS",
        "original_company_id": company,
    }, ["asin", "amount", "quantity"], run_ts, number_by="numbering_doc", numbered=numbered, placed=placed)


def payment_candidates(t: Tables, as_of: date, run_ts: datetime, since: date, own: Sequence[str],
                       no_stock: Sequence[str] = c.NO_STOCK_OWNERS, numbered: bool = True,
                       placed: bool = False) -> DataFrame:
    """Payment rows of type Order; seller SKU to product id to item through two order extracts."""
    payments = t["payments"].where(
        F.col("date_time").cast("date").between(F.lit(since), F.lit(as_of)) & (F.col("type") == "Order"))
    # the two order extracts stay a bag: an order in both doubles its rows, as in the source
    extract = lambda df: df.select(
        F.col("amazon_order_id").alias("order_id"), F.col("sellersku").alias("sku"), "asin").distinct()
    ordered = extract(t["seller_orders_a"]).unionByName(extract(t["seller_orders_b"]))
    rows = payments.join(ordered, ["order_id", "sku"], "left")
    profile = t["profiles"].select(F.col("platform_prd_id").alias("asin"), "country", "pims_sku")
    rows = rows.join(profile, ["asin", "country"], "left")
    items = cut_lineage(t["items"].select(
        F.col("item_id").alias("pims_sku"), F.col("original_company_id").alias("company"),
        "belong_to_company", "customer_posting_group").distinct(), "owners")
    rows = rows.join(items, ["pims_sku", "company"], "left")
    companies = t["companies"].select(F.col("company_code").alias("company"), "company_id")
    rows = rows.join(companies, "company", "left")
    owner = F.col("belong_to_company")
    by_merchant = F.col("fulfillment") == "FBM"
    by_platform = F.col("fulfillment") == "FBA"
    sales = F.when(by_merchant, F.col("fbm_product_sales")).when(by_platform, F.col("fba_product_sales"))
    location = (
        F.when(F.upper(owner).isin(*no_stock), F.lit(None))
        .when(owner.isin(*own), F.when(by_merchant, F.lit(c.UNIDENTIFIED)).when(
            by_platform, code_map("country", c.FULFILMENT_LOCATION, F.lit(c.UNIDENTIFIED))))
        .when(owner.isNull(), F.lit(c.UNIDENTIFIED))
        .otherwise(F.lit(c.OBH_STOCK_LOCATION)))
    doc = dated_doc("order_id", F.col("date_time").cast("date"))
    rows = rows.select(
        F.col("date_time").cast("date").alias("order_date"), F.col("date_time").cast("date").alias("document_date"),
        "customer_posting_group", doc_number(doc, owner, own, infix="-", keep_unknown=True).alias("external_doc_no"),
        location.alias("wh_location"), F.when(F.col("currency_code") != "USD", F.col("currency_code")).alias("currency"),
        code_map("country", c.REGION).alias("country"), head("pims_sku", 4).alias("no"),
        unit_price(sales, "quantity").alias("unit_price"), (-F.col("promotional_rebates")).alias("discount"),
        "quantity", F.round(sales, 2).alias("amount"), F.col("order_id").alias("po_number"),
        F.when(by_merchant, F.lit("ASC FBM")).otherwise(F.lit("ASC FBA")).alias("internal_sales_channel"),
        F.col("order_id").alias("original_external_doc_no"), "asin", "company_id",
        F.col("company").alias("original_company_id"), "belong_to_company")
    return as_candidates(rows, {
        "bill_to_customer": c.CUSTOMER_AMZ, "sell_to_customer": c.CUSTOMER_AMZ, "platform": "PLF-AMZ-1",
        "payment_term": "14D", "sales_channel": "CHAN-ASC",
    }, ["asin", "amount", "quantity", "discount", "internal_sales_channel"], run_ts, numbered=numbered, placed=placed)


def vendor_candidates(t: Tables, as_of: date, run_ts: datetime, since: date, own: Sequence[str], company: str,
                      stock_vendors: Sequence[str], gpe_vendors: Sequence[str], skip_invoices: Sequence[str] = (),
                      no_stock: Sequence[str] = c.NO_STOCK_OWNERS, home: str = "USA", numbered: bool = True,
                      placed: bool = False) -> DataFrame:
    """Vendor invoices by purchase order; the vendor code tells import, stock or GPE channel."""
    channel = (
        F.when(F.col("vendor").isin(*stock_vendors), F.lit("AVC WH"))
        .when(F.col("vendor").isin(*gpe_vendors), F.lit("AVC GPE"))
        .when(F.col("vendor").isNull(), F.lit(c.UNIDENTIFIED)).otherwise(F.lit("AVC DI")))
    vendors = cut_lineage(t["purchase_orders"].select(F.col("po_id").alias("purchase_order_id"), channel.alias("channel")).distinct(), "vendors")
    heads = t["vendor_invoices"].where(F.col("invoice_date").cast("date").between(F.lit(since), F.lit(as_of)))
    if skip_invoices:
        heads = heads.where(~F.col("invoice_number").isin(*skip_invoices))
    detail = t["vendor_invoice_detail"].where(
        ~F.col("invoice_number").like("%SCR") & ~F.col("invoice_number").like("%PCR"))
    rows = heads.select("invoice_number", "invoice_date", "country").join(detail, "invoice_number")
    rows = rows.join(vendors, "purchase_order_id", "left")
    if placed:
        # all rows go on, so the files of the joins before can go; a reader of some days alone asks for these through all joins
        rows = cut_lineage(rows, "invoiced")
    profile = t["profiles"].where(F.col("country") == home).select(
        F.col("platform_prd_id").alias("asin"), "country", "pims_sku")
    rows = rows.join(profile, ["asin", "country"], "left")
    second = t["second_skus"].select(F.col("amz_po").alias("purchase_order_id"), "asin", F.col("sku").alias("po_sku")).distinct()
    rows = rows.join(second, ["purchase_order_id", "asin"], "left")
    rows = rows.withColumn("sku", F.coalesce("pims_sku", "po_sku"))
    rows = rows.join(item_owners(t["items"], company), F.col("sku") == F.col("_item"), "left")
    owner = F.col("belong_to_company")
    imported = F.col("channel").isin("AVC DI", "AVC GPE")
    location = (
        F.when(owner.isin(*own), F.when(F.col("channel") == "AVC DI", code_map("country", c.IMPORT_LOCATION))
               .when(F.col("channel") == "AVC GPE", F.lit("157-DI-GPE"))
               .when(F.col("channel") == "AVC WH", F.lit(c.UNIDENTIFIED)))
        .when(F.upper(owner).isin(*no_stock) | owner.isNull(), F.lit(None))
        .otherwise(F.lit(c.OBH_STOCK_LOCATION)))
    region = (
        F.when(imported, code_map("country", c.IMPORT_REGION, F.lit(c.UNIDENTIFIED)))
        .when(F.col("channel") == "AVC WH", F.lit("REG-USA")).otherwise(F.lit(c.UNIDENTIFIED)))
    rows = rows.select(
        F.col("invoice_date").cast("date").alias("order_date"), F.col("invoice_date").cast("date").alias("document_date"),
        "customer_posting_group", F.when(imported, F.lit("120D")).otherwise(F.lit("90D")).alias("payment_term"),
        doc_number("invoice_number", owner, own, keep_unknown=True).alias("external_doc_no"),
        location.alias("wh_location"), region.alias("country"), F.col("sku").alias("no"),
        unit_price("invoice_price", "invoice_quantity").alias("unit_price"),
        F.col("invoice_quantity").alias("quantity"), F.round("invoice_price", 2).alias("amount"),
        F.col("purchase_order_id").alias("po_number"), F.col("channel").alias("internal_sales_channel"),
        F.col("invoice_number").alias("original_external_doc_no"), "asin", "belong_to_company")
    rows = constant_dim(rows, t["companies"], F.col("company_code") == company, ["company_id"])
    return as_candidates(rows, {
        "bill_to_customer": c.CUSTOMER_AMZ, "sell_to_customer": c.CUSTOMER_AMZ, "platform": "PLF-AMZ-1",
        "sales_channel": "CHAN-AVC", "original_company_id": company,
    }, ["asin", "amount", "quantity", "po_number"], run_ts, numbered=numbered, placed=placed)
