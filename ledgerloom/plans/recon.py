"""Reconciliation and monitoring reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.scalars import concat_skip_null, date_text, in_period, matches, not_matches, part, period_day, shift_period
from ledgerloom.operators.aggs import distinct_lists, group_constant, pivot_sum, string_list
from ledgerloom.operators.derive import code_map
from ledgerloom.operators.incremental import not_in
from ledgerloom.operators.joins import interval_join, reconcile
from ledgerloom.operators.skew import lookup
from ledgerloom.session import cut_lineage

Tables = Mapping[str, DataFrame]
NET_CHANNELS = ("CHAN-WAYFAIR", "CHAN-WMDSV")   # fixed values: channels whose net sales differ from gross


def booked_totals(header: DataFrame, line: DataFrame, key: str, channel_col: str, channels: Sequence[str],
                  month: bool = False) -> DataFrame:
    """Booked amount per document of some channels; documents without lines keep a null amount."""
    heads = header.where(F.col(channel_col).isin(*channels))
    keys = [F.col(key).alias("booked_doc")]
    if month:
        keys.append(date_text("order_date", "YYYY-MM").alias("booked_month"))
    joined = heads.select("external_doc_no", *keys).join(
        line.select(F.col("document_no").alias("external_doc_no"), "amount"), "external_doc_no", "left")
    return joined.groupBy("booked_doc", *(["booked_month"] if month else [])).agg(F.sum("amount").alias("booked_amount"))


def source_totals(rows: DataFrame, doc: str, amount: str, day: str, as_of: date, extra: Sequence[str] = ()) -> DataFrame:
    """Source amount per document of the month of ``as_of``."""
    this_month = rows.where(in_period(day, f"{as_of:%Y-%m}"))
    return this_month.groupBy(F.col(doc).alias("source_doc"), *extra).agg(F.sum(amount).alias("source_amount"))


def recon_documents(source: DataFrame, booked: DataFrame, posted: DataFrame | None = None,
                    guard: str = "missing", booked_only: bool = False) -> DataFrame:
    """Source against booked per document, see :func:`ledgerloom.operators.joins.reconcile`. Each side is written first, so that the
    files of its joins are gone before those of the other come."""
    source, booked = cut_lineage(source, "source"), cut_lineage(booked, "booked")
    return reconcile(source, booked, [("source_doc", "booked_doc")], ("source_amount", "booked_amount"),
                     posted, "original_external_doc_no", guard, booked_only=booked_only)


def recon_by_month(rows: DataFrame, booked: DataFrame, posted: DataFrame, doc: str, day: str, amount: str) -> DataFrame:
    """Source against booked per order and month, newest months first."""
    source = rows.groupBy(date_text(day, "YYYY-MM").alias("source_month"), F.col(doc).alias("source_doc")).agg(
        F.sum(amount).alias("source_amount"))
    out = reconcile(source, booked, [("source_doc", "booked_doc"), ("source_month", "booked_month")],
                    ("source_amount", "booked_amount"), posted, "original_external_doc_no", guard="differs")
    return out.orderBy(F.desc_nulls_first("source_month"), F.desc_nulls_first("booked_month"))


def consistent_invoices(summary: DataFrame, detail: DataFrame, deleted: DataFrame, tolerance: float = 2) -> DataFrame:
    """Invoices whose header and detail amounts agree within the tolerance and that are not deleted."""
    sums = detail.groupBy("invoice_number").agg(F.sum("total_amount").alias("_detail"))
    bad = summary.join(sums, "invoice_number").where(F.abs(F.col("invoice_amount") - F.col("_detail")) > tolerance)
    dropped = bad.select("invoice_number").union(deleted.select("invoice_number"))
    return summary.join(dropped, "invoice_number", "left_anti")


def recon_po_invoice(t: Tables, since: date, gap: float = 0.01) -> DataFrame:
    """Invoice totals against order totals and booked totals, where the first two differ."""
    priced = interval_join(t["orders_export"], t["base_cost"],
                           [("item_number", "supplier_part_number"), ("account_name", "account_name")],
                           "po_date_time", "effective_from", "effective_to")
    orders = priced.groupBy(F.col("po_number").alias("invoice_num")).agg(
        F.sum(F.col("wholesale_price") * F.col("quantity")).alias("po_amount"),
        string_list("item_number", " | ").alias("sku_list"),
        F.sum(F.col("base_cost") * F.col("quantity")).alias("si_amount_testing"))
    booked = t["daily_line"].groupBy(F.col("document_no").alias("invoice_num")).agg(
        F.sum("amount").alias("si_amount"), F.sum(F.col("unit_price") * F.col("quantity")).alias("si_net_sales"))
    # invoices are summed before the joins: the other sides have one row per document
    invoices = t["invoices"].where(F.col("invoice_date").cast("date") >= F.lit(since)).groupBy(
        "invoice_num", "invoice_date").agg(F.sum("amount").alias("invoice_amount"))
    rows = invoices.join(orders, "invoice_num", "left").join(booked, "invoice_num", "left")
    rows = rows.withColumn("po_amount", F.coalesce("po_amount", F.lit(0)))
    rows = rows.where(F.abs(F.col("invoice_amount") - F.col("po_amount")) >= F.lit(str(gap)).cast("decimal(10,4)"))
    return rows.select("invoice_num", "invoice_date", "sku_list", "invoice_amount", "po_amount", "si_amount",
                       "si_amount_testing", "si_net_sales").orderBy(F.asc_nulls_last("invoice_date"))


def recon_net_sales(po_vs_invoice: DataFrame, suffixed: DataFrame, posted: DataFrame) -> DataFrame:
    """Rows whose invoice differs from booked net sales, without documents of two lists, widest gap first."""
    rows = po_vs_invoice.where(F.col("invoice_amount") != F.col("si_net_sales"))
    rows = not_in(rows, "invoice_num", suffixed, "document_no")
    rows = not_in(rows, "invoice_num", posted, "external_doc_no")
    return rows.orderBy(F.desc_nulls_first(F.abs(F.col("invoice_amount") - F.col("po_amount"))))


def source_freshness(sources: Sequence[tuple[str, str, DataFrame, str, str | None]], by_group: Sequence[str] = ()) -> DataFrame:
    """Newest load and newest business day per source ``(label, platform, frame, load, business)``.

    Labels in ``by_group`` give no row for an empty source, the others give a row of nulls.
    """
    out = None
    for label, platform, df, load, business in sources:
        day = F.max(F.col(business).cast("timestamp")) if business else F.lit(None).cast("timestamp")
        aggs = [F.max(F.col(load).cast("timestamp")).alias("latest_run_time"), day.alias("latest_report_date")]
        if label in by_group:
            row = group_constant(df, label, "data_source", *aggs)
        else:
            row = df.agg(*aggs).withColumn("data_source", F.lit(label))
        row = row.withColumn("platform", F.lit(platform))
        out = row if out is None else out.unionByName(row)
    return out


def unidentified_location(t: Tables) -> DataFrame:
    """Documents without a location and the warehouse evidence there is for them."""
    open_docs = t["daily_header"].where(F.col("location") == "Unidentified").select(
        F.col("external_doc_no").alias("document_no")).distinct()
    lines = lookup(t["daily_line"], open_docs, ["document_no"], "left_semi").select(
        "document_no", F.col("no").alias("sku"), "location_code")
    heads = t["daily_header"].select(
        F.col("external_doc_no").alias("document_no"), "original_external_doc_no", "internal_sales_channel")
    pos = t["settlements"].select(F.col("order_id").alias("original_external_doc_no"), "po_id").distinct()
    rows = lines.join(heads, "document_no", "left").join(pos, "original_external_doc_no", "left")
    rows = rows.withColumn("transaction_id", F.coalesce("po_id", "original_external_doc_no"))
    # lines of open documents alone, read by both sides and by the filter of the movements: written once
    rows = cut_lineage(rows.select("original_external_doc_no", "transaction_id", "sku", "location_code", "internal_sales_channel"), "open_documents")
    # the lists of the two sides do not depend on each other: each is gathered by itself, so no
    # pairs of items and movements are formed
    doc = F.col("original_external_doc_no").alias("invoice_number")
    items = distinct_lists(rows.withColumn("invoice_number", doc), ["invoice_number"], {
        "sku": ("sku", ","), "location": ("location_code", ","), "sales_channel": ("internal_sales_channel", ",")})
    # movements of open documents alone, each place and number once
    opened = rows.select(doc, "transaction_id").distinct()
    moves = t["transactions"].select("transaction_id", "warehouse", "ims_id").join(opened, "transaction_id", "left_semi").distinct()
    evidence = distinct_lists(opened.join(moves, "transaction_id"), ["invoice_number"], {
        "warehouse": ("warehouse", ","), "ims_id": ("ims_id", "|")})
    out = items.join(evidence, "invoice_number", "left")
    out = out.withColumn("sales_channel", code_map("sales_channel", {"WM WFS": "WM MKP"}, F.col("sales_channel")))
    # a sort reads its input twice, for the bounds of its ranges and for the rows
    return cut_lineage(out, "unidentified").orderBy(F.asc_nulls_last("sales_channel"), F.asc_nulls_last("invoice_number"))


def outbound_notes(t: Tables, by_sku: bool, low: date, high: date, date_col: str = "issue_date") -> DataFrame:
    """Completed sales notes, per document or per document and SKU, with their dates and warehouses."""
    notes = t["notes"].where(
        (F.col("status") == "COMPLETED") & (F.col("issue_type") == "SALES_ORDERS")
        & (F.col(date_col).cast("date") >= F.lit(low)) & (F.col(date_col).cast("date") <= F.lit(high)))
    places = t["warehouses"].join(t["warehouse_dim"], F.col("short_name") == F.col("dim_short"), "inner").select(
        F.col("warehouse_id").alias("warehouse_from_id"), "erp_warehouse")
    rows = notes.join(t["note_items"], "note_id", "inner").join(places, "warehouse_from_id", "inner")
    rows = rows.withColumn("day", F.col("issue_date").cast("date"))
    keys = ["sale_order_number", "ob_sku"] if by_sku else ["sale_order_number"]
    rows = rows.withColumnRenamed("sku", "ob_sku")
    aggs = [F.sum("actual_exported_qty").alias("ob_qty"), F.max("day").alias("ob_date")]
    if not by_sku:
        aggs.append(string_list("ob_sku", ",").alias("ob_sku"))
    lists = distinct_lists(rows, keys, {
        "outbound_date": ("day", ","), "issue_code": ("issue_code", ","), "erp_warehouse": ("erp_warehouse", ",")},
        {"outbound_date": "cnt_date", "issue_code": "cnt_ob", "erp_warehouse": "cnt_wh"})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_l_{k}")) for k in keys])
    return rows.groupBy(*keys).agg(*aggs).join(lists.withColumnsRenamed({k: f"_l_{k}" for k in keys}), same).drop(
        *[f"_l_{k}" for k in keys])


def invoiced_by_sku(header: DataFrame, line: DataFrame, period: str, channels: Sequence[str]) -> DataFrame:
    """Invoiced quantity and sales per document and SKU of one posting month."""
    heads = header.where(
        (F.upper("document_type") == "ORDER") & in_period("posting_date", period)
        & not_matches("bill_to_customer", "INTC") & F.col("internal_sales_channel").isin(*channels))
    keys = ["order_date", "external_doc_no", "location", "original_external_doc_no", "original_company_id", "belong_to_company",
            "country", "sku"]
    rows = heads.drop("sku").join(
        line.select(F.col("document_no").alias("external_doc_no"), F.col("no").alias("sku"), "quantity", "amount", "unit_price"),
        "external_doc_no", "left")
    return rows.groupBy(*keys).agg(
        F.sum("quantity").alias("quantity"), F.sum("amount").alias("gross_sales"),
        pivot_sum(F.col("sales_channel").isin(*NET_CHANNELS), F.col("quantity") * F.col("unit_price")).alias("net_sales"))


def outbound_vs_invoice_sku(t: Tables, period: str, channels: Sequence[str], low: date, high: date) -> DataFrame:
    """Outbound against invoiced per document and SKU; every invoiced row stays."""
    out = outbound_notes(t, True, low, high)
    out = out.withColumn("ob_key", concat_skip_null("sale_order_number", "ob_sku"))
    sold = invoiced_by_sku(t["posted_header"], t["posted_line"], period, channels)
    sold = sold.withColumn("si_key", concat_skip_null("original_external_doc_no", "sku"))
    return out.join(sold, F.col("ob_key") == F.col("si_key"), "right").drop("ob_key").orderBy(
        F.desc_nulls_first("si_key"), F.asc_nulls_last("order_date"))


def located_not_listed(header: DataFrame, channel: str, listed: DataFrame) -> DataFrame:
    """Located documents of a channel that the outbound comparison does not list."""
    rows = header.where((F.col("internal_sales_channel") == channel) & (F.col("location") != "Unidentified"))
    return not_in(rows, "original_external_doc_no", listed, "original_external_doc_no")


def outbound_vs_invoice_doc(t: Tables, period: str, channels: Sequence[str], low: date, high: date) -> DataFrame:
    """Outbound against invoiced per document, only invoices dated before the goods left."""
    out = outbound_notes(t, False, low, high, "created_date")
    sold = invoiced_by_sku(t["daily_header"], t["daily_line"], period, channels)
    rows = out.join(sold, F.col("original_external_doc_no") == F.col("sale_order_number"), "right")
    rows = rows.where((F.col("order_date") < F.col("ob_date")) & not_matches("external_doc_no", "-OBH-"))
    return rows.orderBy(F.desc_nulls_first("sale_order_number"))


def closing_window(as_of: date, months_back: int = 2, start_day: int = 25) -> tuple[date, date]:
    """From the 25th, two months back, to before the 26th of the month that closed last.

    The end is the month of five days ago, so the report still covers a month in its last days.
    """
    from datetime import timedelta

    five_ago = as_of - timedelta(days=5)
    low = period_day(shift_period(f"{as_of:%Y-%m}", -months_back), start_day)
    high = period_day(f"{five_ago:%Y-%m}", 26)
    return low, high


def within(col: str, bounds: tuple[date, date]) -> Column:
    return (F.col(col) >= F.lit(bounds[0])) & (F.col(col) < F.lit(bounds[1]))


def recon_ads(t: Tables, as_of: date) -> DataFrame:
    """Booked advertising against raw invoices per account. The raw total repeats on each booked
    group of the account."""
    bounds = closing_window(as_of)
    heads = t["ads_invoices"].where(within("invoicedate", bounds)).select(F.col("invoice_id").alias("summary_id"), "profile_id")
    names = t["ads_profiles"].select(F.col("profileid").alias("profile_id"), F.col("accountinfo_name").alias("accounts"))
    raw = t["ads_invoice_detail"].select("summary_id", (F.col("amount") + F.col("tax")).alias("due")).join(
        heads, "summary_id").join(names, "profile_id", "left").groupBy("accounts").agg(F.sum("due").alias("amount_raw"))
    booked = t["expense_daily"].where(
        within("document_date", bounds) & (F.col("amount") > 0) & (F.col("is_processed") == 2)
        & matches("descriptions", "Marketing"))
    sums = booked.groupBy(
        part("descriptions", " ", 3).alias("se_type"), "accounts", "region_code",
        part("original_invoice_company", "_", 2).alias("company"),
    ).agg(F.sum(F.col("amount").cast("decimal(10,2)")).alias("amount_erp"))
    rows = sums.join(raw, "accounts", "left").withColumn("reconcile", F.col("amount_erp") - F.col("amount_raw"))
    return rows.orderBy(F.asc_nulls_last("accounts"))


def recon_promo(t: Tables, as_of: date, late_region: str = "JPN", width: int | None = None) -> DataFrame:
    """Booked promotions against raw invoices per month and country; one country closes later."""
    last = period_day(shift_period(f"{as_of:%Y-%m}", -1), 1)
    usual = (last, closing_window(as_of)[1])
    late = (period_day(shift_period(f"{as_of:%Y-%m}", -2), 1), period_day(shift_period(f"{as_of:%Y-%m}", 1), 1))
    kind = part("descriptions", " ", 3)
    booked = t["expense_daily"].where((F.col("amount") > 0) & (kind == "Promotions"))
    is_late = matches("region_code", late_region)
    # both windows in one scan: each row is tested against the window of its region
    booked = booked.where((~is_late & (F.col("is_processed") == 2) & within("document_date", usual))
                          | (is_late & within("document_date", late)))
    booked = booked.groupBy(date_text("document_date", "YYYY-MM").alias("year_month"), kind.alias("se_type"), "region_code").agg(
        F.sum(F.col("amount").cast("decimal(10,2)")).alias("erp_amount"))
    raw = t["promo_overview"].where(F.col("funding_type") == "Vendor Funded Sales Discount")
    raw = raw.where(((F.col("country") != late_region) & within("invoice_date", usual))
                    | ((F.col("country") == late_region) & within("invoice_date", late)))
    raw = raw.groupBy(date_text("invoice_date", "YYYY-MM").alias("raw_month"), "country").agg(
        F.sum("original_balance").alias("raw_amount"))
    code = part("region_code", "-", 2)
    booked = booked.withColumn("_country", code_map(code, {"MXN": "MEX", "UAE": "ARE"}, code))
    raw = raw.withColumn("_raw_country", part("country", "-", 1))
    rows = booked.join(raw, (F.col("_country") == F.col("_raw_country")) & (F.col("year_month") == F.col("raw_month")), "full")
    country = F.rpad("country", width, " ") if width else F.col("country")
    return rows.select("year_month", "se_type", "region_code", "erp_amount", country.alias("country"), "raw_amount",
                       (F.col("erp_amount") - F.col("raw_amount")).alias("recon"))


def si_report(header: DataFrame, line: DataFrame, period: str) -> DataFrame:
    """Open documents of a posting month with their lines, net sales for two channels."""
    heads = header.where((F.upper("document_type") == "ORDER") & in_period("posting_date", period)
                         & not_matches("bill_to_customer", "INTC") & (F.col("is_processed") == 0))
    lines = line.select(F.col("document_no").alias("external_doc_no"), "po_number", "no", "quantity", "unit_price",
                        "amount", "discount")
    rows = heads.join(lines, "external_doc_no", "left").select(
        *[k for k in heads.columns if k not in ("is_processed", "po_number")], "po_number", "no", "quantity",
        F.col("unit_price").alias("unit_price_aft_promo"), F.col("amount").alias("gross_sales"),
        F.when(F.col("sales_channel").isin(*NET_CHANNELS), F.col("quantity") * F.col("unit_price")).alias("net_sales"), "discount")
    return rows.orderBy(*[F.asc_nulls_last(k) for k in ("sales_channel", "order_date", "external_doc_no")])


def accrual_report(final: DataFrame, since: date) -> DataFrame:
    return final.where((F.col("posting_date") >= F.lit(since)) & F.col("external_document_no").isNotNull())


def cent_adjust(line: DataFrame, invoices: DataFrame, recon: DataFrame) -> DataFrame:
    """Add a per-unit gap of exactly one cent to the unit price of one-SKU documents."""
    cent = F.lit("0.01").cast("decimal(4,2)")
    single = recon.where(F.length("sku_list") < 6).select(
        F.col("invoice_num").alias("po_number"), F.left("sku_list", F.lit(4)).alias("no"), F.lit(True).alias("_single")).distinct()
    totals = invoices.select(F.col("invoice_num").alias("document_no"), F.col("amount").alias("_total")).distinct()
    keys = lookup(line, single, ["po_number", "no"]).join(totals, "document_no", "left")
    gap = (F.col("_total") - F.col("unit_price") * F.col("quantity")) / F.when(F.col("quantity") != 0, F.col("quantity"))
    hits = keys.where(F.col("_single") & (gap == cent)).select("document_no", "no", F.lit(True).alias("_hit")).distinct()
    out = lookup(line, hits, ["document_no", "no"])
    return out.withColumn("unit_price", F.when(F.col("_hit"), F.col("unit_price") + cent).otherwise(F.col("unit_price"))).select(*line.columns)
