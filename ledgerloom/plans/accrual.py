"""Period-end accruals: promotions, advertising, rate-based estimates, and their reversals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.scalars import (
    ColumnLike, as_col, concat_skip_null, contains, date_text, in_period, matches, not_matches, part, period_day,
    positive_gap, shift_period, tail,
)
from ledgerloom.operators.aggs import string_distinct
from ledgerloom.operators.derive import code_map, rate_columns, sku_or_unallocated, unpivot_rates
from ledgerloom.operators.incremental import composite_anti, latest_snapshot
from ledgerloom.operators.joins import member_flag, rate_join
from ledgerloom.operators.windows import allocate, share_allocate
from ledgerloom.plans import config as c
from ledgerloom.plans.config import GlConfig
from ledgerloom.schemas import ESTIMATE, GL_LINE, conform
from ledgerloom.session import cut_lineage

Tables = Mapping[str, DataFrame]


# ---- general-ledger lines -----------------------------------------------------------------------
def gl_line(df: DataFrame, cfg: GlConfig, values: Mapping[str, ColumnLike | Column]) -> DataFrame:
    """Constant-filled GL projection; unnamed text codes are empty, ids come from the config."""
    blank = {name: F.lit("") for name in (
        "due_date", "document_type", "document_no", "bal_vat_bus_posting_group", "vat_prod_posting_group",
        "posting_group", "gen_prod_posting_group", "bal_vat_prod_posting_group", "bal_gen_prod_posting_group",
        "currency_code", "company_ic_code", "accounts")}
    ids = {"company_id": F.lit(cfg.company_id), "journal_id": F.lit(cfg.journal_id),
           "original_company_id": F.lit(cfg.original_company_id), "batch_name": F.lit(cfg.batch_name)}
    given = {k: as_col(v) for k, v in values.items()}
    return conform(df.withColumns({**blank, **ids, **given}), GL_LINE)


def accrual_lines(totals: DataFrame, cfg: GlConfig, run_ts: datetime, account: tuple[str, str], balance: str,
                  prefix: Column, text: str, label_day: ColumnLike, region: Column, other_name: Column,
                  channel: str, platform: str) -> DataFrame:
    """GL lines of accrual totals ``(posting_date, external_doc_no, accrual_amt)``."""
    return gl_line(totals, cfg, {
        "posting_date": F.col("posting_date"), "account_type": F.lit("G/L Account"), "account_no": F.lit(account[0]),
        "account_name": F.lit(account[1]),
        "descriptions": concat_skip_null(prefix, F.lit(text), date_text(label_day, "MonYYYY")),
        "amount": F.col("accrual_amt"), "bal_account_type": F.lit("G/L Account"), "bal_account_no": F.lit(balance),
        "channel_code": F.lit(channel), "region_code": concat_skip_null(F.lit("REG-"), region),
        "platform_code": F.lit(platform), "external_document_no": F.col("external_doc_no"),
        "data_updated_time": F.lit(run_ts), "original_invoice_company": F.col("external_doc_no"),
        "is_processed": F.lit(2), "other_name": other_name,
    })


def book_and_reverse(detail: DataFrame, period: str, keys: Sequence[str], value: str, end_day: int = 25,
                     run_col: str | None = "run_time", all_stamps: bool = False, drop_zero: bool = True
                     ) -> tuple[DataFrame, DataFrame]:
    """Totals of this period (to book) and of the previous one (to reverse, dated this period).

    Only the newest run of each period counts; ``all_stamps`` sums every run of a month instead.
    """
    months = (period, shift_period(period, -1))
    newest = bool(run_col) and not all_stamps
    of_either = reduce(Column.__or__, [in_period("posting_date", of) for of in months])
    sums = detail.where(of_either).groupBy(*dict.fromkeys([*keys, "posting_date", *([run_col] if newest else [])])).agg(F.sum(value).alias("_sum"))
    if newest:
        # one row per document and run: written, so that finding the newest run does not evaluate the detail again
        sums = cut_lineage(sums, "accrued")

    def totals(of: str) -> DataFrame:
        rows = sums.where(in_period("posting_date", of))
        if newest:
            rows = latest_snapshot(rows, run_col)
        if "posting_date" not in keys:
            rows = rows.groupBy(*keys).agg(F.sum("_sum").alias("_sum"))
        if drop_zero:
            rows = rows.where("_sum <> 0")
        return rows.select(*keys, F.round("_sum", 2).alias("accrual_amt"))

    booked = totals(period)
    reversed_ = totals(shift_period(period, -1)).withColumn("posting_date", F.lit(period_day(period, end_day)))
    return booked, reversed_


def marketplace_gl(detail: DataFrame, period: str, cfg: GlConfig, run_ts: datetime, kind: str, end_day: int = 25,
                   skip: Sequence[str] = (), all_stamps: bool = False, reversal_label: date | None = None) -> DataFrame:
    """Accrual and reversal lines per country; ``kind`` is ``Promotion`` or ``Advertising``."""
    account = {"Promotion": (c.PROMOTION_ACCOUNT, c.PROMOTION_NAME, "PROM-AVC "),
               "Advertising": (c.MARKETING_ACCOUNT, c.MARKETING_NAME, "ADV-AVC ")}[kind]
    keys = ["posting_date", "external_doc_no", "platform", "country"]
    booked, reversed_ = book_and_reverse(detail, period, keys, "accrual_usd", end_day, all_stamps=all_stamps)
    region = code_map("country", c.ACCRUAL_REGION, F.col("country"))
    prefix = concat_skip_null(F.lit("AVC "), region)
    common = dict(prefix=prefix, region=region, channel="CHAN-AVC", platform="PLF-AMZ-1",
                  other_name=concat_skip_null(F.lit(account[2]), region, F.lit("_AMZ")))
    keep = ~F.coalesce(F.col("country").rlike("|".join(skip)), F.lit(False)) if skip else F.lit(True)
    label = F.lit(reversal_label) if reversal_label else F.col("posting_date")
    book = accrual_lines(booked.where(keep), cfg, run_ts, account[:2], c.ACCRUED_ACCOUNT,
                         text=f": Booking accrual {kind} expenses at ", label_day="posting_date", **common)
    back = accrual_lines(reversed_.where(keep), cfg, run_ts, (c.ACCRUED_ACCOUNT, c.ACCRUED_NAME), account[0],
                         text=f": Booking revert accrual {kind} expenses at ", label_day=label, **common)
    return back.unionByName(book)


def single_gl(detail: DataFrame, period: str, cfg: GlConfig, run_ts: datetime, value: str, label: str,
              other_name: str, channel: str, platform: str, end_day: int = 25,
              reversal_name: str = c.ACCRUED_NAME, all_stamps: bool = False) -> DataFrame:
    """Accrual and reversal of a one-country source."""
    keys = ["posting_date", "external_doc_no"]
    booked, reversed_ = book_and_reverse(detail, period, keys, value, end_day,
                                         run_col="run_time" if "run_time" in detail.columns else None,
                                         all_stamps=all_stamps, drop_zero=False)
    common = dict(prefix=F.lit(label), region=F.lit("USA"), channel=channel, platform=platform,
                  other_name=F.lit(other_name), label_day="posting_date")
    book = accrual_lines(booked, cfg, run_ts, (c.MARKETING_ACCOUNT, c.MARKETING_NAME), c.ACCRUED_ACCOUNT,
                         text=": Booking accrual Advertising expenses at ", **common)
    back = accrual_lines(reversed_, cfg, run_ts, (c.ACCRUED_ACCOUNT, reversal_name), c.MARKETING_ACCOUNT,
                         text=": Booking revert accrual Advertising expenses at ", **common)
    return back.unionByName(book)


# ---- promotions ---------------------------------------------------------------------------------
def promo_kind(funding: str = "funding_type", title: str = "agreement_title") -> Column:
    fund, name = F.upper(funding), F.upper(title)
    return (
        F.when(contains(fund, F.lit("STRAIGHT PAYMENT")) & contains(name, F.lit("MERCHANDISING")), F.lit("Base Merchandising Fee"))
        .when(contains(fund, F.lit("VENDOR")) & ~contains(name, F.lit("VPC")), F.lit("Promotions"))
        .when(contains(fund, F.lit("VENDOR")) & contains(name, F.lit("VPC")), F.lit("Coupon")))


def promo_invoices(t: Tables) -> DataFrame:
    """Promotion detail and overview side by side, the clip fee spread over the detail rows."""
    agreements = t["promo_info"].select(
        F.col("funding_agreement").alias("agreement_id"), F.col("promotion_id").alias("agreed_promotion"))
    titles = t["promo_overview"].select(F.col("invoice_id").alias("invoice_number"), "agreement_id")
    detail = t["promo_detail"].where(~contains(F.upper("funding_type"), F.lit("GUARANTEED")))
    detail = detail.join(titles, "invoice_number", "left").join(agreements, "agreement_id", "left").select(
        "invoice_number", F.col("invoice_date").alias("d_date"), F.col("order_date").alias("report_date"),
        F.coalesce("promotion_id", "agreed_promotion").alias("d_promotion"), "asin", F.col("country").alias("d_country"),
        F.col("cost_currency").alias("d_currency"), "quantity", "promotion_cost")
    kind = promo_kind()
    overview = t["promo_overview"].withColumn("promo_type", kind).where("promo_type is not null").select(
        F.col("invoice_id").alias("o_invoice"), F.col("invoice_date").alias("o_date"),
        F.when(F.col("promo_type") == "Base Merchandising Fee", part("agreement_title", ":", 2)).alias("o_promotion"),
        F.col("country").alias("o_country"), F.col("currency").alias("o_currency"), "original_balance", "promo_type")
    # the full join in two halves: a left join that may be split on a hot invoice, and the overview
    # rows without detail, which have no group to share a fee with
    billed = detail.join(overview, F.col("invoice_number") == F.col("o_invoice"), "left")
    # the sums of the joined rows, from both sides before the join
    titled = overview.groupBy(F.col("o_invoice").alias("invoice_number")).agg(F.count(F.lit(1)).alias("_times"))
    once = detail.groupBy("invoice_number").agg(F.sum("promotion_cost").alias("_base"), F.sum("quantity").alias("_weight"))
    times = lambda name: (F.col(name) * F.col("_times")).cast(once.schema[name].dataType).alias(name)
    sums = once.join(titled, "invoice_number").select("invoice_number", times("_base"), times("_weight"))
    fee = allocate(billed, "invoice_number", "original_balance", "promotion_cost", "quantity", "clip", sums)
    bare = overview.join(detail.select(F.col("invoice_number").alias("o_invoice")), "o_invoice", "left_anti")
    rows = fee.unionByName(bare, allowMissingColumns=True)
    return rows.select(
        F.coalesce("invoice_number", "o_invoice").alias("invoice_number"), F.coalesce("d_date", "o_date").alias("invoice_date"),
        "report_date", F.coalesce("d_promotion", "o_promotion", F.lit("VM Promotion")).alias("promotion_id"), "asin",
        F.coalesce("d_country", "o_country").alias("country"), F.coalesce("d_currency", "o_currency").alias("cost_currency"),
        "quantity", F.coalesce("promotion_cost", "original_balance").alias("promotion_cost"),
        F.when(F.col("promo_type") == "Base Merchandising Fee", F.lit(0)).otherwise(F.col("clip")).alias("clp_fee"),
        F.col("original_balance").alias("invoice_amount"), "promo_type")


def promo_accrual(t: Tables, period: str, run_ts: datetime, own: Sequence[str], frozen_period: str,
                  frozen_range: tuple[date, date], open_from: date, end_day: int = 25, main: str | None = None,
                  platform_short: str = "AMZ") -> DataFrame:
    """Promotion accrual detail: a frozen estimate against today's invoices for the frozen range,
    and the newest estimate log for everything after it."""
    day = period_day(period, end_day)
    low, high = (F.lit(x) for x in frozen_range)
    keys = ["country", "platform", "sale_channel", "platform_prd_id", "report_date"]

    # one pass over the estimates; a row counts for the frozen branch, the open one, or both
    log = t["estimate_log"]
    frozen = in_period("run_time", frozen_period) & F.col("report_date").between(low, high)
    fresh = (F.col("run_time") == log.select(F.max("run_time")).scalar()) & F.col("report_date").between(F.lit(open_from), F.lit(day))
    branch = F.explode(F.array_compact(F.array(F.when(frozen, "frozen"), F.when(fresh, "open"))))
    # the source joins estimate rows to invoice rows of one key and then sums: each sum is the sum
    # of one side times the row count of the other, so both sides are summed before they meet
    estimates = log.where(frozen | fresh).withColumn("branch", branch).groupBy("branch", "promotion_id", *keys).agg(
        F.count(F.lit(1)).alias("_est"), F.sum("pro_est_adj_usd").alias("est_usd"), F.sum("pro_est_adj_lc").alias("est_lc"),
        F.sum("invoiced_amt_usd").alias("own_usd"), F.sum("invoiced_amt_lc").alias("own_lc"), F.collect_set("invoices_list").alias("own_lists"))
    # a blank promotion stands for a null one; only frozen estimates meet today's invoices
    estimates = estimates.withColumn("_promo", F.when(F.col("branch") == "frozen", F.coalesce("promotion_id", F.lit(""))))
    # lists are gathered as sets beside the sums: what a key gathers is what its text in the result holds
    invoiced = t["promo_spend"].where(F.col("report_date").between(low, high)).groupBy(
        F.coalesce("promotion_id", F.lit("")).alias("_promo"), *keys).agg(
        F.count(F.lit(1)).alias("_inv"), F.sum("invoiced_amt_usd").alias("inv_usd"), F.sum("invoiced_amt_lc").alias("inv_lc"),
        F.collect_set("invoices_list").alias("inv_lists"))
    both = estimates.join(invoiced, ["_promo", *keys], "left")
    is_open = F.col("branch") == "open"
    paired = lambda c: F.col(c) * F.coalesce("_inv", F.lit(1))
    rows = both.select(
        "branch", "promotion_id", *keys, paired("est_usd").alias("est_usd"), paired("est_lc").alias("est_lc"),
        F.when(is_open, F.col("own_usd")).otherwise(F.col("inv_usd") * F.col("_est")).alias("invoiced_usd"),
        F.when(is_open, F.col("own_lc")).otherwise(F.col("inv_lc") * F.col("_est")).alias("invoiced_lc"),
        F.when(is_open, F.col("own_lists")).otherwise(F.coalesce("inv_lists", F.array().cast("array<string>"))).alias("lists"))
    # a product may be listed on several platforms with different owners
    owners = t["profiles"].where(F.col("platform_short") == platform_short).select(
        F.col("platform_product_id").alias("platform_prd_id"), F.col("pims_company").alias("_owner"))
    rows = rows.join(owners, "platform_prd_id", "left").where(F.coalesce("_owner", F.lit(main or own[0])).isin(*own))
    group = ["report_month", "promotion_id", "platform_prd_id", "platform", "country"]
    # rows of a group are the days and sales channels of a month by now
    lists = F.array_distinct(F.flatten(F.collect_list("lists")))
    grouped = rows.withColumn("report_month", date_text("report_date", "YYYY-MM")).groupBy("branch", *group).agg(
        F.when(F.size(lists) > 0, F.array_join(F.array_sort(lists), "|")).alias("list_invoice_number"),
        F.sum("est_usd").alias("est_amt_usd"), F.sum("est_lc").alias("est_amt_lcy"),
        F.sum("invoiced_usd").alias("invoiced_amt_usd"), F.sum("invoiced_lc").alias("invoiced_amt_lcy"))
    rows = grouped.drop("branch").withColumns({
        "accrual_usd": positive_gap("est_amt_usd", "invoiced_amt_usd"),
        "accrual_lcy": positive_gap("est_amt_lcy", "invoiced_amt_lcy")})
    # a month that both branches have may give one row twice; without such a month nothing can, and a reader of amounts alone gathers no lists
    if open_from <= frozen_range[1] or (open_from.year, open_from.month) == (frozen_range[1].year, frozen_range[1].month):
        rows = rows.distinct()
    return rows.withColumns({
        "posting_date": F.lit(day), "run_time": F.lit(run_ts),
        "external_doc_no": concat_skip_null(F.lit("PROMOACRAMZ"), "country", F.lit(day.strftime("%Y%m")))})


# ---- advertising --------------------------------------------------------------------------------
def allocate_ads_by_item(invoices: DataFrame, spend: DataFrame) -> DataFrame:
    """Campaign invoice amounts over items by spend share.

    Assumption: the rule is inferred from the output columns, as no definition is published:
    ``asin_spend_pct = asin_spend / campaign_spend`` and ``allocated = campaign amount * pct``.
    """
    items = spend.groupBy("campaignid", "report_date", "platform_item_id").agg(F.sum("spend").alias("asin_spend_amt"))
    joined = invoices.join(items, ["campaignid", "report_date"], "left")
    return share_allocate(joined, ["summary_id", "campaignid", "report_date"], "cmp_allocated_inv_amt", "asin_spend_amt",
                          "asin_spend_pct", "asin_allocated_inv_amt")


def ads_accrual(t: Tables, period: str, run_ts: datetime, own: Sequence[str], year: int, invoices_from: date,
                skip_platforms: Sequence[str] = ("WF", "WM"), skip_accounts: Sequence[str] = (),
                skip_types: Sequence[str] = ("Affiliate",), end_day: int = 25) -> DataFrame:
    """Advertising accrual: spend per campaign and item, less what has been invoiced, in two currencies."""
    day = period_day(period, end_day)
    in_year = lambda col: (F.col(col) >= F.lit(date(year, 1, 1))) & (F.col(col) < F.lit(date(year + 1, 1, 1)))
    owners = t["profiles"].select(
        F.col("platform_product_id").alias("platform_item_id"), F.col("platform_short").alias("platform"),
        F.col("pims_company").alias("_owner"))
    owned = F.col("_owner").isin(*own) | F.col("_owner").isNull()

    spend = t["ads_spend"].where(
        in_year("report_date") & (F.col("report_date") <= F.lit(day)) & ~F.col("platform").isin(*skip_platforms))
    for col, values in (("accname", skip_accounts), ("advertisingtype", skip_types)):
        if values:
            spend = spend.where(~F.col(col).isin(*values))
    spend = spend.join(owners, ["platform_item_id", "platform"], "left").where(owned)
    currency = t["countries"].select(F.col("country_code_3").alias("country_code"), F.col("major_currency_code").alias("ccy"))
    # sum per day first: the rate is the same on all rows of a day, so it joins to far fewer rows
    daily = spend.groupBy("report_date", "platform", "country_code", "accname", "campaignid",
                          sku_or_unallocated("platform_item_id").alias("platform_item_id")).agg(F.sum("spend").alias("spend"))
    daily = rate_join(daily.join(currency, "country_code", "left"), t["fx"], "ccy", "report_date",
                      "currency_code", "run_date", "to_usd")
    spent = daily.groupBy("platform", "country_code", "accname", "campaignid", "platform_item_id").agg(
        F.sum("spend").alias("ads_spend"), F.sum(F.col("spend") * F.col("to_usd")).alias("ads_spend_usd"))

    billed = latest_snapshot(t["ads_invoice_log"], "run_time").where(
        F.col("summary_invoicedate").between(F.lit(invoices_from), F.lit(day)) & in_year("report_date"))
    billed = billed.join(owners.where(F.col("platform") == "AMZ").drop("platform"), "platform_item_id", "left").where(owned)
    billed = rate_join(billed, t["fx"], "currency", "summary_invoicedate", "currency_code", "run_date", "to_usd")
    amount = F.col("asin_allocated_inv_amt")
    billed = billed.groupBy("campaignid", F.col("country").alias("b_country"), "currency",
                            sku_or_unallocated("platform_item_id").alias("b_item")).agg(
        string_distinct("summary_id", " ; ").alias("list_invoice_number"),
        F.sum(amount).alias("invoiced"), F.sum(amount * F.col("to_usd")).alias("invoiced_usd"))
    billed = billed.select(F.lit("AMZ").alias("b_platform"), F.col("campaignid").alias("b_campaign"), "b_country",
                           "b_item", "list_invoice_number", "invoiced", "invoiced_usd")

    both = spent.join(billed, (F.col("platform") == F.col("b_platform")) & (F.col("campaignid") == F.col("b_campaign"))
                      & (F.col("platform_item_id") == F.col("b_item")), "full")
    rows = both.select(
        F.coalesce("platform", "b_platform").alias("platform"), F.coalesce("country_code", "b_country").alias("country"),
        F.col("accname").alias("account_name"), F.coalesce("campaignid", "b_campaign").alias("campaignid"),
        F.coalesce("platform_item_id", "b_item").alias("platform_item_id"), "list_invoice_number",
        "ads_spend", "ads_spend_usd", F.coalesce("invoiced", F.lit(0)).alias("invoiced_amount"),
        F.coalesce("invoiced_usd", F.lit(0)).alias("invoiced_amount_usd"))
    return rows.withColumns({
        "posting_date": F.lit(day), "accrual": positive_gap("ads_spend", "invoiced_amount"),
        "accrual_usd": positive_gap("ads_spend_usd", "invoiced_amount_usd"), "run_time": F.lit(run_ts),
        "external_doc_no": concat_skip_null(F.lit("MKTACRAMZ"), "country", F.lit(day.strftime("%Y%m")))})


def spend_window(col: str, period: str, end_day: int = 25) -> Column:
    """From the 26th of the previous month to the period day, both included."""
    start = period_day(shift_period(period, -1), 26)
    return F.col(col).between(F.lit(start), F.lit(period_day(period, end_day)))


def retail_ads_accrual(spend: DataFrame, period: str, run_ts: datetime, accounts: Sequence[str],
                       platform: str = "WM", end_day: int = 25) -> DataFrame:
    """Spend of one period by team and SKU, in cents."""
    day = period_day(period, end_day)
    rows = spend.where((F.col("platform") == platform) & F.col("accname").isin(*accounts)
                       & spend_window("report_date", period, end_day))
    channel = F.when(F.col("accname").isin(*accounts), F.lit("CHAN-WMDSV")).otherwise(F.lit("CHAN-WMMKP"))
    sums = rows.groupBy("report_date", channel.alias("channel"), "team", "sku").agg(
        F.sum("spend_usd").cast("decimal(10,2)").alias("amount_spend"), F.sum("unitssold14d").alias("quantity_sold"))
    return sums.withColumns({
        "external_doc_no": F.lit("MKTACRWMDSV" + day.strftime("%Y%m")), "posting_date": F.lit(day),
        "run_time": F.lit(run_ts)})


def search_ads_accrual(costs: DataFrame, period: str, run_ts: datetime, account_names: Mapping[str, str],
                       end_day: int = 25) -> DataFrame:
    """Search advertising cost of one period, from micros by exact decimal division."""
    day = period_day(period, end_day)
    rows = costs.where(spend_window("segments_date", period, end_day))
    return rows.withColumns({
        "external_doc_no": F.lit("MKTACRGGADS" + day.strftime("%Y%m")), "posting_date": F.lit(day),
        "report_date": F.col("segments_date").cast("date"),
        "account_name": code_map("de_accountid", account_names, F.col("de_accountid")),
        "ad_cost": (F.col("metrics_costmicros").cast("decimal(20,0)") / F.lit(1000000).cast("decimal(7,0)")).cast("decimal(18,6)"),
        "run_time": F.lit(run_ts)})


# ---- rate-based estimate ------------------------------------------------------------------------
def _dec(value: str) -> Column:
    return F.lit(value).cast("decimal(6,4)")


def estimate_rules(furniture: Column, returned: Column) -> dict[str, Column]:
    channel, country = F.col("internal_sales_channel"), F.col("country")
    zero = _dec("0")
    imported = channel == "AVC DI"
    until, before, after = c.FREIGHT_RATE_UNTIL
    by_region = lambda rule: F.when(imported & country.isin(*rule[1]), _dec(rule[0])).otherwise(zero)
    return {
        "coop_mkt": F.when(channel.isin("AVC DS", "AVC WH"), _dec(c.COOP_MARKETING_RATE)).otherwise(zero),
        # return documents are told by their name before the suffix is removed
        "freight": F.when(~F.col("source_document").like("%Return%") & (channel == "AVC WH"),
                          F.when(F.col("document_date") <= F.lit(until), _dec(before)).otherwise(_dec(after))).otherwise(zero),
        "damage": by_region(c.IMPORT_DAMAGE_RATE),
        "jpn_service": by_region(c.JPN_SERVICE_RATE),
        "import_service": by_region(c.IMPORT_SERVICE_RATE),
        "import_coop": by_region(c.IMPORT_COOP_RATE),
        "dropship_damage": F.when(channel.isin("WF", "WF CG"), _dec(c.DROPSHIP_DAMAGE_RATE)).otherwise(zero),
        "stock_damage": F.when(channel.isin("AVC DS", "AVC WH") & ~returned, _dec(c.STOCK_DAMAGE_RATE)).otherwise(zero),
        "furniture": F.when(channel.isin("AVC DS", "AVC DI", "AVC WH") & furniture,
                            _dec(c.FURNITURE_SERVICE_RATE)).otherwise(zero),
    }


# (rule, note, column tested against zero)
ESTIMATE_NOTES = [
    ("coop_mkt", "COOP_MKT", "amt"), ("import_coop", "Coop DI", "amt"), ("jpn_service", "DI JPN AVS_SVS", "amt"),
    ("import_service", "DI DEU GBR AVS_SVS", "rate"), ("freight", "Freight_Allowance", "amt"),
    ("damage", "Damage_Allowance", "rate"), ("dropship_damage", "Damage_Allowance", "amt"),
    ("stock_damage", "Damage_Allowance", "amt"), ("furniture", "Furniture_SVS_AVS", "amt"),
]


def estimate_base(t: Tables, as_of: date, merged: Sequence[str], main: str, stock_vendors: Sequence[str],
                  gpe_vendors: Sequence[str], skip_po: Sequence[str] = (), skip_customers: Sequence[str] = ()
                  ) -> DataFrame:
    """Last month's processed invoices and returns of the estimated channels."""
    last = shift_period(f"{as_of:%Y-%m}", -1)
    header = t["posted_header"].where((F.col("is_processed") == 1) & in_period("posting_date", last)).select(
        F.col("external_doc_no").alias("document_no"), "posting_date", "document_date", F.col("country").alias("h_country"),
        "currency", F.col("sales_channel").alias("h_channel"), "internal_sales_channel", "is_processed",
        "original_company_id", "posting_description", "bill_to_customer", "document_type",
        F.when(F.col("belong_to_company").isin(*merged), F.lit(main)).otherwise(F.col("belong_to_company")).alias("company"))
    line = t["posted_line"].select(
        "document_no", "po_number", F.col("no").alias("sku"), "unit_price", "quantity", "amount", "country",
        "sales_channel", "platform")
    kept = ["document_no", "po_number", "posting_date", "document_date", "country", "currency", "sku", "company",
            "unit_price", "quantity", "amount", "sales_channel", "platform", "internal_sales_channel", "is_processed",
            "original_company_id", "type"]

    # lines meet their headers once, in one shuffle; sales and returns are told apart after it
    sale = (F.col("internal_sales_channel").isin(*c.ESTIMATE_CHANNELS) & not_matches("bill_to_customer", "INTC")
            & (F.upper("document_type") == "ORDER") & F.col("h_country").isin(*c.ESTIMATE_REGIONS))
    back = (F.col("document_type") == "Sales Return") & (F.col("sales_channel") == "CHAN-AVC")
    if skip_customers:
        back = back & ~F.col("bill_to_customer").isin(*skip_customers)
    rows = line.join(header, "document_no").withColumn("_branch", F.when(sale, "sale").when(back, "back")).where("_branch is not null")

    channel = (
        F.when(F.col("vendor").isin(*stock_vendors), F.lit("AVC WH")).when(F.col("vendor").isin(*gpe_vendors), F.lit("AVC GPE"))
        .when(F.col("vendor").isNull(), F.lit(c.UNIDENTIFIED)).otherwise(F.lit("AVC DI")))
    vendors = t["purchase_orders"].select(F.col("po_id").alias("_po"), channel.alias("po_channel")).distinct()
    is_sale, is_back = F.col("_branch") == "sale", F.col("_branch") == "back"
    # only returns ask for the vendor
    rows = rows.join(vendors, F.when(is_back, F.col("po_number")) == F.col("_po"), "left")
    stock = is_back & (F.col("po_channel").isin("AVC DS", "AVC WH") | F.col("po_channel").isNull())
    imports = is_back & (F.col("po_channel") == "AVC DI") & part("country", "-", 2).isin(*c.RETURN_REGIONS)
    imports = imports & (~F.col("po_number").isin(*skip_po) if skip_po else F.col("po_number").isNotNull())
    net = F.when(F.col("h_channel").isin("CHAN-WAYFAIR", "CHAN-WMDSV"), F.col("quantity") * F.col("unit_price")).otherwise(F.col("amount"))
    booked = F.when(matches("posting_description", "Booking accrual revenue"), F.lit("SI Accrual")).otherwise(F.lit("SI Actual"))
    by_number = F.when(matches("po_number", "DROPSHIP"), F.lit("AVC DS")).otherwise(F.lit("AVC WH"))
    return rows.where(is_sale | stock | imports).select(*[
        {"country": F.when(is_sale, F.col("h_country")).otherwise(F.col("country")),
         "amount": F.when(is_sale, net).otherwise(-F.col("amount")),
         "internal_sales_channel": F.when(is_sale, F.col("internal_sales_channel")).when(stock, by_number).otherwise(F.col("po_channel")),
         "type": F.when(is_sale, booked).otherwise(F.lit("SRT Actual"))}.get(name, F.col(name)).alias(name) for name in kept])


def accrual_estimate(t: Tables, as_of: date, **base_args) -> DataFrame:
    """Nine rate-based estimates per line, unpivoted in one pass."""
    rows = estimate_base(t, as_of, **base_args)
    rows = rows.withColumns({"source_document": F.col("document_no"),
                             "document_no": F.replace(F.col("document_no"), F.lit("_Return"), F.lit(""))})
    returns = t["posted_header"].where(F.col("document_type") == "Sales Return").select(
        F.replace(F.col("external_doc_no"), F.lit("_Return"), F.lit("")).alias("_doc"))
    rows = member_flag(rows, F.col("document_no"), returns, "_doc", "_returned")
    rows = member_flag(rows, F.col("sku"), t["furniture_items"], "pims_sku", "_furniture")
    rated = rate_columns(rows, estimate_rules(F.col("_furniture"), F.col("_returned")))
    rated = rated.withColumns({
        "original_invoice": F.col("document_no"),
        "invoice_number": concat_skip_null("document_no", F.lit("_"), "company")})
    triples = [(f"{rule}_rate", f"{rule}_amt", note, f"{rule}_{test}") for rule, note, test in ESTIMATE_NOTES]
    kept = [f.name for f in ESTIMATE.fields if f.name not in ("rate", "accrual_amt", "note")]
    return conform(unpivot_rates(rated, triples, kept), ESTIMATE)


def estimate_log(detail: DataFrame, run_ts: datetime) -> DataFrame:
    """Estimate rows in journal form with one stamp."""
    return detail.select(
        F.lit("GENERAL").alias("journal_template_name"), F.lit("IM_SELEXP").alias("journal_batch_name"),
        F.lit("G/L Account").alias("account_type"), "posting_date",
        concat_skip_null("internal_sales_channel", F.lit("-"), tail("country", 3), F.lit(": Accrual estimate "), "note",
                         F.lit(" exps Inv# "), "invoice_number", F.lit("_"), date_text("document_date", "YYMMDD")).alias("description"),
        F.col("currency").alias("currency_code"), F.col("accrual_amt").alias("amount"),
        F.lit("G/L Account").alias("bal_account_type"), "document_date", F.col("invoice_number").alias("external_document_no"),
        F.col("sales_channel").alias("channel_code"), F.col("platform").alias("platform_code"),
        F.col("country").alias("region_code"), "internal_sales_channel", F.col("amount").alias("si_amount"), "rate",
        "company", "original_company_id", "original_invoice", "po_number", "is_processed",
        F.lit(run_ts).alias("run_time"), "note", "type")


def estimate_final(log: DataFrame, final: DataFrame, as_of: date) -> DataFrame:
    """Rows of the newest stamp that are not in the final table yet, last month only."""
    fresh = composite_anti(latest_snapshot(log, "run_time"), final, ["external_document_no", "document_date"])
    return fresh.where(in_period("posting_date", shift_period(f"{as_of:%Y-%m}", -1)))
