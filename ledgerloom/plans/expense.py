"""Selling-expense invoices and their general-ledger lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.scalars import (
    concat_skip_null, contains, date_text, head, matches, part, posting_date, tail,
)
from ledgerloom.operators.derive import code_map, is_own
from ledgerloom.operators.incremental import not_in
from ledgerloom.operators.joins import text_rule_join
from ledgerloom.operators.windows import dense_rank_global
from ledgerloom.plans import config as c
from ledgerloom.plans.accrual import gl_line
from ledgerloom.plans.config import GlConfig
from ledgerloom.schemas import GL_LINE, conform
from ledgerloom.session import cut_lineage

Tables = Mapping[str, DataFrame]


# ---- promotion invoices -------------------------------------------------------------------------
def funding_class(funding: str, title: str, transaction: str) -> Column:
    """Sub-type of a funding; the first rule that matches wins."""
    fund, name = F.upper(funding), F.upper(title)
    # in the pattern the underscore stands for any one character
    straight = (
        F.when(contains(name, F.lit("MERCHANDISING")), F.lit("Base merchandising fee"))
        .when(contains(name, F.lit("BORN TO RUN")), F.lit("Born to run"))
        .when(contains(name, F.lit("VINE")) & ~name.like("%STRAIGHT_PAYMENT%"), F.lit("VINE_new"))
        .when(contains(name, F.lit("VINE")) & name.like("%STRAIGHT_PAYMENT%"), F.lit("VINE_old"))
        .when(F.col(transaction) == "AVS - SVS", F.lit("AVS_SVS"))
        .otherwise(F.lit("Other deduction")))
    return (
        F.when(contains(fund, F.lit("STRAIGHT PAYMENT")), straight)
        .when(contains(fund, F.lit("VENDOR")), F.lit("Vendor Funded Sales Discount"))
        .when(contains(fund, F.lit("PRICE PROTECTION")), F.lit("Price Protection"))
        .when(contains(fund, F.lit("GUARANTEED")), F.lit("Guaranteed Minimum Margin"))
        .when(contains(fund, F.lit("DAMAGE")), F.lit("Damage Allowance"))
        .when(contains(fund, F.lit("ACCRUAL")), F.lit("Accrual")))


def clean_currency(currency: str, country: str) -> Column:
    blank_home = F.col(currency).isNull() & (F.col(country) == "USA")
    return F.when((F.col(currency) == "USA") | blank_home, F.lit("USD")).otherwise(F.col(currency))


def promo_invoice_by_sku(t: Tables, since: date, booked: Sequence[tuple[DataFrame, str]] = ()) -> DataFrame:
    """Promotion detail with its share of the clip fee, and merchandising fees that have no detail.

    Invoices in a list of ``booked``, ``(frame, key)``, are left out as ``NOT IN`` does, before a line of them is joined.
    """
    def unbooked(df: DataFrame, key: str) -> DataFrame:
        return reduce(lambda kept, other: not_in(kept, key, *other), booked, df)

    kinds = t["promo_stream"].select(F.col("invoice_number").alias("invoice_id"), "transaction_type")
    overview = t["promo_overview"].join(kinds, "invoice_id", "left").select(
        F.col("invoice_id").alias("invoice_number"), "invoice_date", "funding_type",
        funding_class("funding_type", "agreement_title", "transaction_type").alias("sub_funding_type"),
        "agreement_id", "agreement_title", clean_currency("currency", "country").alias("currency"),
        F.col("country").alias("o_country"), F.col("original_balance").alias("cop_ovr_amt")).distinct()
    totals = t["promo_detail"].groupBy("invoice_number").agg(
        F.sum("quantity").alias("total_quantity"), F.sum("promotion_cost").alias("total_cost"))
    clips = t["clip_fees"].groupBy("invoice_number").agg(F.sum("total_clip_fee").alias("total_clip_fee"))
    agreements = t["promo_info"].select(
        F.col("funding_agreement").alias("agreement_id"), F.col("promotion_id").alias("agreed_promotion")).distinct()

    # what is known of an invoice is gathered per invoice, so that a line is joined once; without a number nothing is known of it
    totals = totals.withColumns({name: F.when(F.col("invoice_number").isNotNull(), F.col(name)) for name in ("total_quantity", "total_cost")})
    known = unbooked(totals, "invoice_number").join(clips, "invoice_number", "left")
    known = known.join(overview.drop("invoice_date"), "invoice_number", "left").join(agreements, "agreement_id", "left").select(
        F.col("invoice_number").alias("_invoice"), "funding_type", "sub_funding_type", "currency", "cop_ovr_amt", "agreed_promotion",
        "total_clip_fee", "total_quantity", "total_cost")
    # read once, and the files of its joins are gone before the lines move
    known = cut_lineage(known, "known")
    detail = t["promo_detail"].where(F.col("invoice_date") >= F.lit(since)).drop("funding_type")
    # every line has totals, so none is lost but those of booked invoices; null-safe, see skew.lookup
    rows = detail.join(known, F.col("invoice_number").eqNullSafe(F.col("_invoice")))
    per_unit = lambda amount: F.round(
        F.col("promotion_cost") + amount * F.col("quantity") / F.when(F.col("total_quantity") != 0, F.col("total_quantity")), 2)
    residual = F.col("cop_ovr_amt") - F.col("total_cost")
    day = F.coalesce("order_date", "ship_date").cast("date")
    promotion = F.coalesce("agreed_promotion", "promotion_id")
    detailed = rows.select(
        date_text(day, "YYYY").alias("year_order_date"), day.alias("report_date"), "invoice_number", "invoice_date",
        "funding_type", "sub_funding_type", "currency", "country",
        F.when(promotion.isNull(), F.lit("VM")).otherwise(F.lit("Portal")).alias("booked_type"),
        promotion.alias("promotion_id"), "asin", "quantity", "total_quantity", "cop_ovr_amt",
        F.coalesce("total_clip_fee", residual).alias("clp_fee"), "promotion_cost",
        F.coalesce(per_unit(F.col("total_clip_fee")), per_unit(residual)).alias("cop_fee_by_sku"))
    fund, title = F.upper("funding_type"), F.upper("agreement_title")
    fees = t["promo_overview"].where(
        contains(fund, F.lit("STRAIGHT PAYMENT")) & contains(title, F.lit("MERCHANDISING"))
        & (F.col("invoice_date") >= F.lit(since)))
    fees = unbooked(fees, "invoice_id")
    fee = F.round("original_balance", 2)
    label = F.lit("Base merchandising fee")
    undetailed = fees.select(
        date_text("invoice_date", "YYYY").alias("year_order_date"), F.col("invoice_date").cast("date").alias("report_date"),
        F.col("invoice_id").alias("invoice_number"), F.col("invoice_date").cast("date").alias("invoice_date"),
        F.lit("STRAIGHT_PAYMENT").alias("funding_type"), label.alias("sub_funding_type"), "currency", "country",
        label.alias("booked_type"), part("agreement_title", ":", 2).alias("promotion_id"), fee.alias("cop_ovr_amt"),
        fee.alias("cop_fee_by_sku"))
    return detailed.unionByName(undetailed, allowMissingColumns=True)


# ---- advertising invoices -----------------------------------------------------------------------
def ads_invoice_detail(t: Tables, since: date, main: str, main_company: str, seller_company: str,
                       seller_rules: Sequence[tuple[str, str]], other_company: str, account_owner: Mapping[str, str],
                       split_owner: str = c.SPLIT_OWNER, skip_accounts: Sequence[str] = (), skip_documents: Sequence[str] = (),
                       retail_types: Sequence[str] = ("WIC - AR", "Walmart Connect SS"),
                       open_reason: str = "Advertising Billing", wallet_region: Mapping[str, str] | None = None
                       ) -> DataFrame:
    """Advertising invoices of all platforms in one layout.

    The amount that belongs to a partner's portfolios is split off its invoice into a row of its own.
    """
    seller = F.lit(other_company)
    for token, company in reversed(list(seller_rules)):
        seller = F.when(contains(F.upper("accountinfo_name"), F.lit(token)), F.lit(company)).otherwise(seller)
    profiles = t["ads_profiles"].select(
        F.col("profileid").alias("profile_id"), F.col("accountinfo_type"), F.col("accountinfo_name").alias("account_name"),
        "countrycode",
        F.when(F.col("accountinfo_type") == "vendor", F.lit(main_company))
        .when(F.col("accountinfo_type") == "seller", seller).alias("original_company_id")).distinct()
    heads = t["ads_invoices"].select(F.col("invoice_id").alias("summary_id"), "profile_id")
    countries = t["countries"].select("country_code_2", "country_code_3")
    adjust = t["ads_adjustments"].select("invoice_id", F.col("portfolioid").alias("portfolio_id"), F.col("amount").alias("adj"))
    partner = t["ads_portfolios"].where(contains("name", F.lit(split_owner))).join(
        adjust, ["invoice_id", "portfolio_id"], "left")
    partner = partner.groupBy(F.col("invoice_id").alias("summary_id")).agg(
        F.sum(F.col("totalamount") + F.coalesce("adj", F.lit(0)) - F.col("feeamount")).cast("decimal(10,2)").alias("partner_amt"))
    # both joins by invoice stand together: one shuffle serves them
    raw = (
        t["ads_invoice_detail"].join(heads, "summary_id", "left").join(partner, "summary_id", "left").join(profiles, "profile_id", "left")
        .withColumn("country_code_2", F.coalesce("issuer_countrycode", "countrycode"))
        .join(countries, "country_code_2", "left"))
    raw = raw.where(~F.col("account_name").isin(*skip_accounts) if skip_accounts else F.col("account_name").isNotNull())
    written_off = (F.col("status") == "WRITTEN_OFF") & (F.col("remaining") == 0)
    raw = raw.select(
        F.col("summary_id").alias("invoice_number"), F.col("invoicedate").cast("date").alias("invoice_date"),
        F.col("profile_id").alias("acc_id"),
        F.when(F.col("currency") == "SGD", F.lit("SGP")).otherwise(F.col("country_code_3")).alias("country"), "currency",
        F.when(written_off, F.lit(0)).otherwise(F.col("amount") + F.col("tax")).alias("amount"),
        code_map("accountinfo_type", {"vendor": "AVC", "seller": "ASC"}).alias("channel"),
        F.lit("Amazon").alias("platform"), "account_name", "original_company_id",
        F.coalesce("partner_amt", F.lit(0)).alias("partner_amt"))
    raw = raw.where(F.col("invoice_date") >= F.lit(since))

    # one pass: each invoice gives its own row and, if there is an amount, the partner's row
    own = F.struct(code_map("account_name", account_owner, F.lit(main)).alias("company"),
                   (F.col("amount") - F.col("partner_amt")).cast("decimal(18,2)").alias("invoice_amount"))
    other = F.struct(F.lit(split_owner).alias("company"), F.col("partner_amt").cast("decimal(18,2)").alias("invoice_amount"))
    split = F.when(F.col("partner_amt") != 0, F.array(own, other)).otherwise(F.array(own))
    keep = ["invoice_number", "invoice_date", "acc_id", "country", "currency", "channel", "platform", "account_name",
            "original_company_id"]
    ads = raw.select(*keep, F.explode(split).alias("_s")).select(*keep, "_s.company", "_s.invoice_amount")

    region = t["countries"].select(F.col("country_code_2").alias("country_key"), F.col("country_code_3").alias("country"))

    def bills(df: DataFrame, amount: str) -> DataFrame:
        df = df.where(F.col("document_date") >= F.lit(since))
        if skip_documents:
            df = df.where(~F.col("document_number").isin(*skip_documents))
        return df.join(region, "country_key", "left").select(
            F.col("document_number").alias("invoice_number"), F.col("document_date").cast("date").alias("invoice_date"),
            "country", "currency", F.col(amount).cast("decimal(18,2)").alias("invoice_amount"), F.lit("WM - DSV").alias("channel"),
            F.lit("Walmart").alias("platform"), F.lit("Walmart").alias("account_name"), F.lit(main).alias("company"),
            F.lit(main_company).alias("original_company_id"))

    closed = bills(t["closed_bills"].where(F.col("doc_type_desc").isin(*retail_types)), "invoice_amount")
    open_ = bills(t["open_bills"].where(F.col("reason_code_description") == open_reason), "open_amount")
    wallet = t["ads_wallet"].where((F.col("status") == "Paid") & (F.col("report_date") >= F.lit(since))).select(
        F.col("externalpaymentid").alias("invoice_number"), F.col("report_date").cast("date").alias("invoice_date"),
        code_map("account_name", wallet_region or {}).alias("country"), F.col("currencyid").alias("currency"),
        F.col("amount").cast("decimal(18,2)").alias("invoice_amount"), F.lit("WF - DSV").alias("channel"),
        F.lit("Wayfair").alias("platform"), F.lit("Wayfair").alias("account_name"), F.lit(main).alias("company"),
        F.lit(seller_company).alias("original_company_id"))
    rows = ads
    for other_rows in (closed, open_, wallet):
        rows = rows.unionByName(other_rows, allowMissingColumns=True)
    return rows.withColumns({"asin": F.lit("nonASIN"), "sku": F.lit("nonSKU")})


# ---- general-ledger log -------------------------------------------------------------------------
def journals(t: Tables) -> DataFrame:
    """Journals whose code carries a currency before a dash, with their company."""
    owners = t["items"].select("company_id", F.col("original_company_id").alias("j_company")).distinct()
    dashed = t["journals"].where(F.col("code").rlike(".*-.*"))
    return dashed.join(owners, "company_id", "left").select(
        "j_company", F.col("company_id").alias("j_company_id"), F.col("id").alias("journal_id"),
        part("code", "-", 1).alias("j_currency"), F.col("displayname").alias("batch_name"))


def promotion_gl(t: Tables, cfg: GlConfig, main: str, merged: Sequence[str], unbooked: bool = False) -> DataFrame:
    """Promotion invoices per owner, described for the ledger. With ``unbooked`` no invoice of the two lists is in
    ``promo_by_sku`` any more (see :func:`promo_invoice_by_sku`), and they are not read."""
    rows = _coded(_promotions(t, cfg, main, merged, unbooked), t["dimensions"], journals(t))
    return _described(rows, cfg, main).drop("channel", "platform")


def _promotions(t: Tables, cfg: GlConfig, main: str, merged: Sequence[str], unbooked: bool) -> DataFrame:
    profile = t["profiles"].where(F.col("platform") == "Amazon").select(
        F.col("platform_prd_id").alias("asin"), "country", F.col("pims_company").alias("owner"))
    rows = t["promo_by_sku"]
    if not unbooked:
        rows = not_in(rows, "invoice_number", t["old_invoices"], "original_invoice")
        rows = not_in(rows, "invoice_number", t["withdrawn"], "invoice_id")
    owner = F.when(F.col("owner").isin(*merged) | F.col("owner").isNull(), F.lit(main)).otherwise(F.col("owner"))
    # the sums are taken before the owner is known per item, so each item joins once
    rows = rows.join(profile, ["asin", "country"], "left").groupBy(
        "invoice_number", F.col("invoice_date").cast("date").alias("document_date"), "funding_type", "sub_funding_type",
        "currency", "country", owner.alias("company"), "booked_type").agg(F.sum("cop_fee_by_sku").alias("amount"))
    unknown = F.lit(None).cast("string")
    return rows.withColumns({"original_company_id": F.lit(cfg.original_company_id), "accounts": unknown, "channel": unknown,
                             "platform": unknown, "_promo": F.lit(True)})


def advertising_gl(t: Tables, cfg: GlConfig, main: str, merged: Sequence[str]) -> DataFrame:
    """Advertising invoices per owner, described for the ledger; Singapore is held back with flag 3."""
    return _described(_coded(_advertising(t, main, merged), t["dimensions"], journals(t)), cfg, main)


def _advertising(t: Tables, main: str, merged: Sequence[str]) -> DataFrame:
    rows = not_in(t["ads_detail"], "invoice_number", t["old_invoices"], "original_invoice")
    owner = F.when(F.col("company").isin(*merged) | F.col("company").isNull(), F.lit(main)).otherwise(F.col("company"))
    return rows.groupBy("invoice_number", F.col("invoice_date").alias("document_date"), "acc_id", "country", "currency",
                        owner.alias("company"), "channel", "platform", F.col("account_name").alias("accounts"),
                        "original_company_id").agg(F.sum("invoice_amount").alias("amount")).withColumn("_promo", F.lit(False))


def _coded(rows: DataFrame, dimensions: DataFrame, books: DataFrame) -> DataFrame:
    """Ledger codes and journals of promotion and advertising invoices (``_promo`` tells them apart)."""
    for source, target in (("country", "region_code"), ("platform", "platform_code"), ("channel", "channel_code")):
        rows = rows.join(dimensions.select(F.col("db").alias(source), F.col("erp").alias(target)), source, "left")
    rows = rows.join(books, (F.col("original_company_id") == F.col("j_company")) & (F.col("currency") == F.col("j_currency")), "left")
    promo = F.col("_promo")
    return rows.withColumns({
        "channel_code": F.when(promo, F.lit("CHAN-AVC")).otherwise(F.col("channel_code")),
        "platform_code": F.when(promo, F.lit("PLF-AMZ-1")).otherwise(F.col("platform_code")),
        "is_processed": F.when(promo | (F.col("country") != "SGP"), F.lit(2)).otherwise(F.lit(3)),
        "_text": F.when(promo, F.lit(": Booking Promotions exps, Inv# ")).otherwise(F.lit(": Selling exp_Marketing, Inv# "))})


def _described(rows: DataFrame, cfg: GlConfig, main: str) -> DataFrame:
    own = F.col("company") == main
    return rows.withColumns({
        "original_invoice_company": _document(),
        "descriptions": concat_skip_null(F.when(own, F.lit("")).otherwise(F.lit("OBH-")), "channel_code", F.lit("-"), "country",
                                         "_text", "invoice_number", F.lit("_"), "company", F.lit("_"),
                                         _day_text("document_date", "MONYYYY")),
        "amount": F.round("amount", 2), "posting_date": F.col("document_date"), "account_type": F.lit("G/L Account"),
        "journal_id": F.when(own, F.col("journal_id")).otherwise(F.lit(cfg.obh_journal_id)),
        "external_document_no": F.col("invoice_number"), "company_id": F.col("j_company_id"),
        "original_company_id": F.col("j_company"), "currency_code": F.col("currency")}).drop("_text", "_promo")


def _day_text(day: str, pattern: str) -> Column:
    """:func:`date_text` of a date column from its year and month; formatters are dear where there are many rows."""
    year, month = F.year(day), F.month(day)
    two = lambda number: F.lpad(number.cast("string"), 2, "0")
    quick = {"YY": two(year % 100), "MM": two(month), "MONYYYY": F.concat(
        F.element_at(F.array(*[F.lit(name) for name in MONTHS]), month), F.lpad(year.cast("string"), 4, "0"))}[pattern]
    return F.when(year.between(1, 9999), quick).otherwise(date_text(day, pattern))


def _document() -> Column:
    return concat_skip_null("invoice_number", F.lit("_"), "company")


# an invoice-level row as it is written: what can be told from these columns is added after the ranking
RANKED = ["invoice_number", "company", "document_date", "country", "currency", "amount", "accounts", "original_company_id", "channel",
          "platform", "_promo"]
ACCOUNT = ["company", "account_type", "account_no", "account_name", "posting_group", "bal_account_type", "bal_account_no", "currency_code",
           "channel_code", "region_code", "platform_code", "original_company_id", "other_name"]
OWN, EXPENSE, CONTRA = 0, 1, 2
MONTHS = "JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC".split()


def gl_format_log(t: Tables, cfg: GlConfig, main: str, merged: Sequence[str], as_of: date, run_ts: datetime,
                  partitions: int | None = None, unbooked: bool = False) -> DataFrame:
    """Promotion and advertising invoices as GL lines.

    Own invoices take their accounts from the map by text; on-behalf invoices give an expense line
    and a contra line against the vendor. Document numbers rank the invoices across the whole log.
    For ``unbooked`` see :func:`promotion_gl`.
    """
    # every invoice gives a line, so they can be ranked before their accounts are known;
    # the invoice-level rows are fixed once, read by the ranking and joined to the ranks once. The two kinds are written one after
    # the other: the files of the joins of one are gone before those of the other come
    kinds = [_promotions(t, cfg, main, merged, unbooked), _advertising(t, main, merged)]
    rows = reduce(DataFrame.unionByName, [cut_lineage(kind.select(*RANKED), "ranked") for kind in kinds]).withColumn("original_invoice_company", _document())
    rows = dense_rank_global(rows, "original_invoice_company", "_rank", partitions)
    # small tables are written, so that their size is known to the joins
    rows = _coded(rows, cut_lineage(t["dimensions"].select("db", "erp"), "codes"), cut_lineage(journals(t), "journals"))
    rows = _described(rows, cfg, main)
    own = F.col("original_invoice_company").like(f"%{main}")
    use = F.when(own, F.array(F.lit(OWN))).otherwise(F.array(F.lit(EXPENSE), F.lit(CONTRA)))
    rows = rows.withColumn("_use", F.explode(use))
    contra = F.col("_use") == CONTRA

    # a contra line asks for the vendor and the codes alone
    accounts = cut_lineage(t["gl_accounts"].select(*ACCOUNT), "accounts")
    asked = ["company", "account_type", "original_company_id"]
    by_owner = accounts.withColumns({"contra": F.lit(False), "token": part("account_name", "_", 2), **{f"for_{name}": F.col(name) for name in asked}})
    vendors = accounts.where((F.col("company") == "OBH") & (F.col("account_type") == "Vendor")).withColumns(
        {"contra": F.lit(True), "token": F.lit(None).cast("string"), **{f"for_{name}": F.lit("") for name in asked}})
    owned = {"company": part("original_invoice_company", "_", 2), "account_type": F.col("account_type"),
             "original_company_id": F.col("original_company_id")}
    equal = [(contra, "contra"), *[(F.when(contra, F.lit("")).otherwise(owned[name]), f"for_{name}") for name in asked],
             *[(F.col(name), name) for name in ("currency_code", "channel_code", "region_code", "platform_code")]]
    token = F.when(F.col("_use") == OWN, F.col("rule_token")).otherwise(F.lit(""))
    lines = text_rule_join(rows, by_owner.unionByName(vendors), equal, ("descriptions", token)).withColumns({
        **{name: F.col(f"rule_{name}") for name in (
            "account_no", "account_name", "posting_group", "bal_account_type", "bal_account_no", "other_name")},
        "account_type": F.when(contra, F.col("rule_account_type")).otherwise(F.col("account_type")),
        "document_no": concat_skip_null(F.lit("GJNLGEN"), _day_text("posting_date", "YY"), _day_text("posting_date", "MM"),
                                        (F.col("_rank") + 10000)),
        "posting_date": posting_date("posting_date", as_of),
        "amount": F.round(F.when(contra, -F.col("amount")).otherwise(F.col("amount")), 2),
        "currency_code": F.when(F.col("currency_code") == "USD", F.lit("")).otherwise(F.col("currency_code")),
        "data_updated_time": F.lit(run_ts),
        **{name: F.lit("") for name in ("bal_vat_bus_posting_group", "vat_prod_posting_group",
                                        "bal_vat_prod_posting_group", "bal_gen_prod_posting_group", "company_ic_code")}})
    return conform(lines, GL_LINE)


# ---- damage credits -----------------------------------------------------------------------------
def damage_credit(t: Tables, cfg: GlConfig, own: Sequence[str], item_company: str, as_of: date, run_ts: datetime,
                  before: date, accounts: Mapping[str, tuple[str, str]], skip_invoices: Sequence[str] = ()) -> DataFrame:
    """Credit-memo invoices of posted orders as GL lines, own and on-behalf accounts apart.

    ``accounts`` maps account name to ``(currency code, region)``.
    """
    num = F.col("invoice_num")
    memo = (num.like("%CM") & ~num.like("%CM2%") & ~num.like("%SAP%") & ~F.lower(num).like("%credit%")
            & ~num.like("%_VIR"))
    if skip_invoices:
        memo = memo & ~num.isin(*skip_invoices)
    credits = t["invoices"].where(memo)
    items = t["items"].where(F.col("original_company_id") == item_company).select(
        F.col("item_id").alias("_item"), "belong_to_company").distinct()
    ordered = t["orders_export"].select("po_number", head("item_number", 4).alias("_item"))
    owners = credits.select("invoice_num", F.col("po_num").alias("po_number")).join(ordered, "po_number", "left").join(
        items, "_item", "left").select("invoice_num", "belong_to_company").distinct()
    posted = t["posted_header"].where(
        matches("platform", "WF") & (F.col("document_type") == "Order") & ~F.col("bill_to_customer").like("%INTC%")
        & (F.col("is_processed") == 1)).select(F.col("original_external_doc_no").alias("_order")).distinct()
    rows = credits.where((F.col("amount") < 0) & (F.col("invoice_date") < F.lit(before)))
    rows = rows.join(posted, part("invoice_num", "_", 1) == F.col("_order"), "left_semi")
    rows = not_in(rows, "invoice_num", t["expense_ledger"], "original_invoice_company")
    rows = rows.join(owners, "invoice_num", "left")
    is_mine = is_own("belong_to_company", own)
    by_owner = lambda mine, theirs: F.when(is_mine, mine).when(~is_mine, theirs)
    month = date_text("invoice_date", "MonYYYY")
    currency, region = ({k: v[i] for k, v in accounts.items()} for i in (0, 1))
    last_month = date(as_of.year - (as_of.month == 1), (as_of.month - 2) % 12 + 1, 1)
    return gl_line(rows, cfg, {
        "posting_date": posting_date(F.col("invoice_date").cast("date"), last_month),
        "account_type": F.lit("G/L Account"), "account_no": by_owner(F.lit(c.DAMAGE_ACCOUNT), F.lit(c.DAMAGE_OBH_ACCOUNT)),
        "account_name": F.lit(""), "posting_group": F.lit("3311-MER"),
        "descriptions": by_owner(
            concat_skip_null(F.lit("Wayfair : Booking damage 4% expenses of revenue "), month),
            concat_skip_null(F.lit("Wayfair : Booking damage 4% OBH "), month)),
        "amount": -F.col("amount"), "bal_account_type": F.lit("Vendor"), "bal_account_no": F.lit("331US-SER0031-WFR"),
        "currency_code": code_map("account_name", currency), "channel_code": F.lit("CHAN-WAYFAIR"),
        "region_code": code_map("account_name", region), "platform_code": F.lit("PLF-WF-1"),
        "external_document_no": num, "data_updated_time": F.lit(run_ts), "original_invoice_company": num,
        "document_date": F.col("invoice_date").cast("date"), "exporting_time": F.lit(""), "is_processed": F.lit(0),
        "error_type": F.lit(""), "other_name": by_owner(F.lit(""), F.lit(c.OWNER_VENDOR["Bluestars"]))})
