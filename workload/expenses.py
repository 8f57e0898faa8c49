"""Selling-expense invoices, ledger lines and accruals on the driver tables."""

from datetime import date, datetime

from pyspark.sql import functions as F

from ledgerloom.operators.incremental import rollover, status_flip
from ledgerloom.plans import accrual, expense, recon
from ledgerloom.plans.config import GlConfig
from workload.registry import query

AS_OF = date(2001, 7, 20)
RUN_TS = datetime(2001, 7, 20, 5)
SINCE = date(1995, 1, 1)
GL = GlConfig(company_id="company-1", journal_id="journal-1", obh_journal_id="journal-obh", original_company_id="CO1", batch_name="DATA")
MERGED = ("MAIN", "SIDE", "JOINT")


def half_up(num: str, den: str, scale: int = 2) -> str:
    return f"(sign({num}) * ((2 * abs({num}) + abs({den})) // (2 * abs({den}))))::decimal(38,0) * {'0.' + '0' * (scale - 1) + '1'}"


# ---- promotion and advertising invoices ------------------------------------------------------
PROMO_SQL = f"""
ovr as (select distinct invoice_id, agreement_id, funding_type, case when upper(funding_type) like '%STRAIGHT PAYMENT%' then case when upper(agreement_title) like '%MERCHANDISING%' then
      'Base merchandising fee' when upper(agreement_title) like '%VINE%' then 'VINE_new' when s.transaction_type is not null then 'AVS_SVS' else 'Other deduction' end
    when upper(funding_type) like '%VENDOR%' then 'Vendor Funded Sales Discount' when upper(funding_type) like '%PRICE%' then 'Price Protection'
    when upper(funding_type) like '%GUAR%' then 'Guaranteed Minimum Margin' else 'Damage Allowance' end as sub,
    case when currency = 'USA' or (currency is null and country = 'USA') then 'USD' else currency end as ccy, original_balance as ovr_amt
  from promo_overview o left join promo_stream s on o.invoice_id = s.invoice_number),
tot as (select invoice_number, sum(quantity)::bigint as tq, sum(promotion_cost) as tc from promo_detail group by 1),
clip as (select invoice_number, sum(total_clip_fee) as fee from clip_fees group by 1),
det as (select d.*, ovr.sub, ovr.ccy, ovr.ovr_amt, tot.tq, tot.tc, clip.fee, coalesce(i.promotion_id, d.promotion_id) as promo, (coalesce(clip.fee, ovr_amt - tc) * 100)::bigint as clip_c
  from promo_detail d left join ovr on d.invoice_number = ovr.invoice_id left join (select distinct * from promo_info) i on i.funding_agreement = ovr.agreement_id
  left join clip on d.invoice_number = clip.invoice_number left join tot on d.invoice_number = tot.invoice_number),
promo_rows as (select strftime(coalesce(order_date, ship_date), '%Y') as year_order_date, coalesce(order_date, ship_date) as report_date, invoice_number, invoice_date, funding_type, sub as sub_funding_type,
    ccy as currency, country, case when promo is null then 'VM' else 'Portal' end as booked_type, promo as promotion_id, asin, quantity, tq as total_quantity, ovr_amt as cop_ovr_amt,
    coalesce(fee, ovr_amt - tc) as clp_fee, promotion_cost, {half_up('((promotion_cost * 100)::bigint * tq + clip_c * quantity)', 'tq')} as cop_fee_by_sku from det
  union all select strftime(invoice_date, '%Y'), invoice_date, invoice_id, invoice_date, 'STRAIGHT_PAYMENT', 'Base merchandising fee', currency, country, 'Base merchandising fee',
    split_part(agreement_title, ':', 2), null, null, null, original_balance, null, null, original_balance from promo_overview
    where upper(funding_type) like '%STRAIGHT PAYMENT%' and upper(agreement_title) like '%MERCHANDISING%')"""


def promo_rows(t, booked=()):
    return expense.promo_invoice_by_sku(t.pick(
        promo_stream="promo_stream", promo_overview="promo_overview", promo_detail="promo_detail", clip_fees="clip_fees", promo_info="promo_info"), SINCE, booked)


@query("promo_invoice_by_sku", f"""with {PROMO_SQL} select year_order_date, report_date::varchar as report_date, invoice_number, invoice_date::varchar as invoice_date, funding_type, sub_funding_type,
  currency, country, booked_type, promotion_id, asin, quantity, total_quantity, cop_ovr_amt::double as cop_ovr_amt, clp_fee::double as clp_fee, promotion_cost::double as promotion_cost,
  cop_fee_by_sku::double as cop_fee_by_sku from promo_rows""")
def promo_invoice_by_sku(t):
    return promo_rows(t)


ADS_SQL = """
prof as (select distinct profileid, accountinfo_type as kind, accountinfo_name as account_name, countrycode, case when accountinfo_type = 'vendor' then 'CO1' when accountinfo_name like '%AUTO%' then 'CO2'
    when accountinfo_name like '%FURN%' then 'CO3' else 'CO4' end as company from ads_profiles),
part_all as (select a.invoice_id, sum(totalamount + coalesce(adj.amount, 0) - feeamount) as amt from ads_portfolios a left join ads_adjustments adj on a.invoice_id = adj.invoice_id and a.portfolio_id = adj.portfolioid
    where name like '%HMD%' group by 1),
adr as (select d.summary_id as invoice_number, d.invoicedate as invoice_date, i.profile_id as acc_id, case when d.currency = 'SGD' then 'SGP' else c.country_code_3 end as country, d.currency,
    case when status = 'WRITTEN_OFF' and remaining = 0 then 0 else d.amount + d.tax end as amount, case kind when 'vendor' then 'AVC' else 'ASC' end as channel, p.account_name, p.company, coalesce(x.amt, 0) as part
  from ads_invoice_detail d left join ads_invoices i on d.summary_id = i.invoice_id left join prof p on i.profile_id = p.profileid
  left join countries c on coalesce(d.issuer_countrycode, p.countrycode) = c.country_code_2 left join part_all x on d.summary_id = x.invoice_id where p.account_name not in ('Services - HOUSEHOLD')),
ads_rows as (select invoice_number, invoice_date, acc_id, country, currency, case when account_name = 'Services - BUILDING' then 'Bluestars' else 'MAIN' end as company, (amount - part) as invoice_amount, channel,
    'Amazon' as platform, account_name, company as original_company_id from adr
  union all select invoice_number, invoice_date, acc_id, country, currency, 'HMD', part, channel, 'Amazon', account_name, company from adr where part <> 0
  union all select document_number, document_date, null, country_code_3, currency, 'MAIN', invoice_amount, 'WM - DSV', 'Walmart', 'Walmart', 'CO1' from closed_bills left join countries on country_key = country_code_2
    where doc_type_desc in ('WIC - AR', 'Walmart Connect SS') and document_number not in ('CB7')
  union all select document_number, document_date, null, country_code_3, currency, 'MAIN', open_amount, 'WM - DSV', 'Walmart', 'Walmart', 'CO1' from open_bills left join countries on country_key = country_code_2
    where reason_code_description = 'Advertising Billing' and document_number not in ('CB7')
  union all select externalpaymentid, report_date, null, case account_name when 'ACCT_US' then 'USA' else 'CAN' end, currencyid, 'MAIN', amount, 'WF - DSV', 'Wayfair', 'Wayfair', 'CO2' from ads_wallet where status = 'Paid')"""


def ads_rows(t):
    tables = t.pick(**{n: n for n in ("ads_profiles", "ads_invoices", "ads_invoice_detail", "countries", "ads_adjustments", "ads_portfolios", "closed_bills", "open_bills", "ads_wallet")})
    return expense.ads_invoice_detail(
        tables, SINCE, "MAIN", "CO1", "CO2", [("AUTO", "CO2"), ("FURN", "CO3")], "CO4", {"Services - BUILDING": "Bluestars"},
        skip_accounts=["Services - HOUSEHOLD"], skip_documents=["CB7"], wallet_region={"ACCT_US": "USA", "ACCT_CA": "CAN"})


@query("ads_invoice_detail", f"""with {ADS_SQL} select invoice_number, invoice_date::varchar as invoice_date, acc_id, country, currency, company, invoice_amount::double as invoice_amount, channel, platform,
  account_name, original_company_id, 'nonASIN' as asin, 'nonSKU' as sku from ads_rows""")
def ads_invoice_detail(t):
    return ads_rows(t)


# ---- general ledger --------------------------------------------------------------------------
GL_SQL = f"""{PROMO_SQL}, {ADS_SQL},
jr as (select id, split_part(code, '-', 1) as j_ccy, displayname, 'CO1' as j_company, company_id from journals where code like '%-%'),
pg as (select r.invoice_number, r.invoice_date, r.currency, r.country, case when p.pims_company in ('MAIN', 'SIDE', 'JOINT') or p.pims_company is null then 'MAIN' else p.pims_company end as company, sum(cop_fee_by_sku) as amount
  from promo_rows r left join profiles q on r.asin = q.platform_prd_id and r.country = q.country left join product_owner p on q.platform_prd_id = p.platform_product_id
  where r.invoice_number not in (select original_invoice from old_invoices) and r.invoice_number not in (select invoice_id from withdrawn)
  group by r.invoice_number, r.invoice_date, r.funding_type, r.sub_funding_type, r.currency, r.country, r.booked_type, 5),
ag as (select invoice_number, invoice_date, currency, country, company, sum(invoice_amount) as amount, channel, platform, account_name, original_company_id from ads_rows
  where invoice_number not in (select original_invoice from old_invoices) group by all),
lines as (select pg.invoice_number, invoice_date, currency, pg.country, company, round(amount, 2) as amount, 'CHAN-AVC' as channel_code, dc.erp as region_code, 'PLF-AMZ-1' as platform_code, 2 as flag,
    concat(case when company = 'MAIN' then '' else 'OBH-' end, 'CHAN-AVC-', pg.country, ': Booking Promotions exps, Inv# ', pg.invoice_number, '_', company, '_', upper(strftime(invoice_date, '%b%Y'))) as text,
    jr.id, jr.j_company, jr.displayname from pg left join dimensions dc on pg.country = dc.db left join jr on pg.currency = jr.j_ccy
  union all select ag.invoice_number, invoice_date, currency, ag.country, company, round(amount, 2), dch.erp, dc.erp, dp.erp, case when ag.country <> 'SGP' then 2 else 3 end,
    concat(case when company = 'MAIN' then '' else 'OBH-' end, dch.erp, '-', ag.country, ': Selling exp_Marketing, Inv# ', ag.invoice_number, '_', company, '_', upper(strftime(invoice_date, '%b%Y'))), jr.id, jr.j_company, jr.displayname
  from ag left join dimensions dc on ag.country = dc.db left join dimensions dp on ag.platform = dp.db left join dimensions dch on ag.channel = dch.db
    left join jr on ag.original_company_id = jr.j_company and ag.currency = jr.j_ccy),
acc as (select l.*, g.account_no, g.bal_account_no, g.other_name, 'G/L Account' as account_type, 1 as sgn from lines l left join gl_accounts g on g.company = l.company and g.account_type = 'G/L Account'
    and position(split_part(g.account_name, '_', 2) in l.text) > 0 and g.currency_code = l.currency and g.channel_code = l.channel_code and g.region_code = l.region_code
    and g.original_company_id = l.j_company and g.platform_code = l.platform_code where l.company = 'MAIN'
  union all select l.*, g.account_no, g.bal_account_no, g.other_name, 'G/L Account', 1 from lines l left join gl_accounts g on g.company = l.company and g.account_type = 'G/L Account' and g.currency_code = l.currency
    and g.channel_code = l.channel_code and g.region_code = l.region_code and g.original_company_id = l.j_company and g.platform_code = l.platform_code where l.company <> 'MAIN'
  union all select l.*, g.account_no, g.bal_account_no, g.other_name, g.account_type, -1 from lines l left join gl_accounts g on g.company = 'OBH' and g.account_type = 'Vendor' and g.currency_code = l.currency
    and g.channel_code = l.channel_code and g.region_code = l.region_code and g.platform_code = l.platform_code where l.company <> 'MAIN')"""


@query("gl_format_log", f"""with {GL_SQL}
  select concat('GJNLGEN', strftime(invoice_date, '%y%m'), 10000 + dense_rank() over (order by invoice_number || '_' || company)) as document_no, account_type, account_no, bal_account_no, other_name,
    (sgn * amount)::double as amount, text as descriptions, case when currency = 'USD' then '' else currency end as currency_code, channel_code, region_code, platform_code, flag as is_processed,
    case when company = 'MAIN' then id else 'journal-obh' end as journal_id, displayname as batch_name, case when invoice_date < date '2001-07-01' then '2001-07-01' when invoice_date < date '2001-08-01' then
    invoice_date::varchar end as posting_date, invoice_number as external_document_no from acc""")
def gl_format_log(t):
    tables = t.pick(**{n: n for n in ("profiles", "old_invoices", "withdrawn", "dimensions", "journals", "items", "gl_accounts")})
    booked = [(tables["old_invoices"], "original_invoice"), (tables["withdrawn"], "invoice_id")]
    tables |= {"promo_by_sku": promo_rows(t, booked), "ads_detail": ads_rows(t)}
    out = expense.gl_format_log(tables, GL, "MAIN", MERGED, AS_OF, RUN_TS, unbooked=True)
    return out.select("document_no", "account_type", "account_no", "bal_account_no", "other_name", "amount", "descriptions", "currency_code", "channel_code", "region_code", "platform_code",
                      "is_processed", "journal_id", "batch_name", "posting_date", "external_document_no")


EXP = """select split_part(original_invoice_company, '_', 1) as external_document_no, region_code, amount, document_date, document_date as posting_date, is_processed from expense_daily"""


def expense_rows(t):
    return t["expense_daily"].select(F.split_part("original_invoice_company", F.lit("_"), F.lit(1)).alias("external_document_no"), "region_code", "amount", "document_date",
                                     F.col("document_date").alias("posting_date"), F.col("is_processed"))


@query("gl_daily", f"""with h as ({EXP} where original_invoice_company like '%HMD'), n as ({EXP} where original_invoice_company not like '%HMD')
  select external_document_no, region_code, amount::double as amount, posting_date::varchar as posting_date, 2 as is_processed from h where posting_date < date '2001-08-01'
  union all select external_document_no, region_code, amount::double, posting_date::varchar, is_processed from n where posting_date < date '2001-08-01' and amount <> 0 and not exists
    (select 1 from h where h.posting_date < date '2001-08-01' and h.external_document_no = n.external_document_no and h.region_code = n.region_code)""")
def gl_daily(t):
    rows = expense_rows(t)
    partner = t["expense_daily"].select("*").where(F.col("original_invoice_company").like("%HMD"))
    history = expense_rows({"expense_daily": partner}).withColumn("stamp", F.lit(datetime(2001, 1, 1)))
    rest = t["expense_daily"].where(~F.col("original_invoice_company").like("%HMD"))
    log = rows.withColumn("stamp", F.lit(datetime(2001, 1, 1))).unionByName(expense_rows({"expense_daily": rest}).withColumn("stamp", F.lit(RUN_TS)))
    keys = ["external_document_no", "region_code"]
    return rollover(history, log, keys, AS_OF, "stamp").select(*keys, "amount", "posting_date", "is_processed")


@query("gl_final", f"""with f as ({EXP} where original_invoice_company like '%HMD'), d as ({EXP} where original_invoice_company not like '%HMD')
  select external_document_no, region_code, amount::double as amount, posting_date::varchar as posting_date, case when is_processed = 2 then 0 else is_processed end as is_processed from (select * from f union all
    select * from d where amount <> 0 and posting_date <= date '2000-01-25' and not exists (select 1 from f where f.external_document_no = d.external_document_no and f.region_code = d.region_code))""")
def gl_final(t):
    like = F.col("original_invoice_company").like("%HMD")
    final, daily = (expense_rows({"expense_daily": t["expense_daily"].where(c)}) for c in (like, ~like))
    keys = ["external_document_no", "region_code"]
    return status_flip(daily, final, keys, date(2000, 1, 25)).select(*keys, "amount", "posting_date", "is_processed")


@query("damage_credit", """with own as (select distinct a.invoice_num, i.belong_to_company as owner from invoices a left join orders_export b on a.po_num = b.po_number
    left join items i on left(b.item_number, 4) = i.item_id where a.invoice_num like '%CM')
  select case when a.invoice_date < date '2001-06-01' then '2001-06-01' when a.invoice_date < date '2001-07-01' then a.invoice_date::date::varchar end as posting_date,
    case when owner in ('MAIN', 'SIDE', 'JOINT') then '64160110' when owner is not null then '13890101' end as account_no,
    case when owner in ('MAIN', 'SIDE', 'JOINT') then 'Wayfair : Booking damage 4% expenses of revenue ' || strftime(a.invoice_date, '%b%Y')
      when owner is not null then 'Wayfair : Booking damage 4% OBH ' || strftime(a.invoice_date, '%b%Y') end as descriptions, (- a.amount)::double as amount,
    case a.account_name when 'ACCT_CA' then 'CAD' else '' end as currency_code, case a.account_name when 'ACCT_CA' then 'REG-CAN' else 'REG-USA' end as region_code, a.invoice_num as external_document_no,
    case when owner in ('MAIN', 'SIDE', 'JOINT') then '' when owner is not null then 'US-MER0002-BLS' end as other_name
  from invoices a left join own on a.invoice_num = own.invoice_num where a.invoice_num like '%CM' and split_part(a.invoice_num, '_', 1) in (select original_external_doc_no from est_header
    where document_type = 'Order' and bill_to_customer not like '%INTC%' and is_processed = 1 union select original_external_doc_no from est_header where is_processed = 1)
    and a.invoice_num not in (select original_invoice_company from expense_ledger) and a.invoice_date < date '2001-06-01' and a.amount < 0""")
def damage_credit(t):
    tables = t.pick(invoices="invoices", orders_export="orders_export", items="items", expense_ledger="expense_ledger")
    # the credited orders are the returned documents here
    tables["posted_header"] = t["est_header"].withColumn("document_type", F.lit("Order")).withColumn("bill_to_customer", F.lit("131US"))
    out = expense.damage_credit(tables, GL, MERGED, "CO1", AS_OF, RUN_TS, date(2001, 6, 1), {"ACCT_CA": ("CAD", "REG-CAN"), "ACCT_US": ("", "REG-USA")})
    return out.select("posting_date", "account_no", "descriptions", "amount", "currency_code", "region_code", "external_document_no", "other_name")


# ---- accruals --------------------------------------------------------------------------------
PROMO_ACC = """
acc as (select report_month, promotion_id, platform_prd_id, platform, country, string_agg(distinct lst, '|' order by lst) as list_invoice_number, sum(eu) as est_amt_usd, sum(el) as est_amt_lcy, sum(iu) as invoiced_amt_usd, sum(il) as invoiced_amt_lcy from (
  select strftime(a.report_date, '%Y-%m') as report_month, a.promotion_id, a.platform_prd_id, a.platform, a.country, b.invoices_list as lst, a.pro_est_adj_usd as eu, a.pro_est_adj_lc as el, b.invoiced_amt_usd as iu, b.invoiced_amt_lc as il
    from estimate_log a left join promo_spend b on coalesce(a.promotion_id, '') = coalesce(b.promotion_id, '') and a.country = b.country and a.platform = b.platform and a.sale_channel = b.sale_channel
      and a.platform_prd_id = b.platform_prd_id and a.report_date = b.report_date and b.report_date between date '1995-01-01' and date '1997-12-31'
    where a.run_time < timestamp '2001-06-01' and a.report_date between date '1995-01-01' and date '1997-12-31'
  union all select strftime(report_date, '%Y-%m'), promotion_id, platform_prd_id, platform, country, invoices_list, pro_est_adj_usd, pro_est_adj_lc, invoiced_amt_usd, invoiced_amt_lc from estimate_log
    where run_time > timestamp '2001-06-01' and report_date between date '1998-01-01' and date '2001-07-25') x left join product_listings o on x.platform_prd_id = o.platform_product_id and o.platform_short = 'AMZ'
  where coalesce(o.pims_company, 'MAIN') in ('MAIN', 'SIDE', 'JOINT') group by 1, 2, 3, 4, 5)"""


def promo_detail(t, period="2001-07"):
    tables = t.pick(estimate_log="estimate_log", promo_spend="promo_spend", profiles="product_listings")
    return accrual.promo_accrual(tables, period, RUN_TS, MERGED, "2001-05", (date(1995, 1, 1), date(1997, 12, 31)), date(1998, 1, 1))


@query("accrual_promo", f"""with {PROMO_ACC} select report_month, promotion_id, platform_prd_id, platform, country, list_invoice_number, est_amt_usd::double as est_amt_usd, est_amt_lcy::double as est_amt_lcy,
  invoiced_amt_usd::double as invoiced_amt_usd, invoiced_amt_lcy::double as invoiced_amt_lcy, (case when est_amt_usd > coalesce(invoiced_amt_usd, 0) then est_amt_usd - coalesce(invoiced_amt_usd, 0) else 0 end)::double as accrual_usd,
  (case when est_amt_lcy > coalesce(invoiced_amt_lcy, 0) then est_amt_lcy - coalesce(invoiced_amt_lcy, 0) else 0 end)::double as accrual_lcy, '2001-07-25' as posting_date, 'PROMOACRAMZ' || country || '200107' as external_doc_no
  from acc""")
def accrual_promo(t):
    return promo_detail(t).drop("run_time")


@query("accrual_promo_gl", f"""with {PROMO_ACC}, s as (select country, sum(case when est_amt_usd > coalesce(invoiced_amt_usd, 0) then est_amt_usd - coalesce(invoiced_amt_usd, 0) else 0 end) as amt from acc group by 1)
  select 'AVC ' || r || ': Booking accrual Promotion expenses at Jul2001' as descriptions, amt::double as amount, '64160102' as account_no, '33510102' as bal_account_no, '2001-07-25' as posting_date, 'REG-' || r as region_code,
    'PROM-AVC ' || r || '_AMZ' as other_name, 'PROMOACRAMZ' || country || '200107' as external_document_no from (select *, case country when 'MEX' then 'MXN' else country end as r from s) where amt <> 0""")
def accrual_promo_gl(t):
    lines = accrual.marketplace_gl(promo_detail(t), "2001-07", GL, RUN_TS, "Promotion")
    return lines.select("descriptions", "amount", "account_no", "bal_account_no", "posting_date", "region_code", "other_name", "external_document_no")


CENTS = "(original_balance * 100)::bigint"


@query("promo_invoice_log", f"""with det as (select d.*, coalesce(d.promotion_id, i.promotion_id) as promo from promo_detail d left join promo_overview o on d.invoice_number = o.invoice_id left join promo_info i on i.funding_agreement = o.agreement_id
    where upper(d.funding_type) not like '%GUARANTEED%'),
  ov as (select *, case when upper(funding_type) like '%STRAIGHT PAYMENT%' and upper(agreement_title) like '%MERCHANDISING%' then 'Base Merchandising Fee' when upper(funding_type) like '%VENDOR%'
      and upper(agreement_title) not like '%VPC%' then 'Promotions' when upper(funding_type) like '%VENDOR%' and upper(agreement_title) like '%VPC%' then 'Coupon' end as promo_type from promo_overview),
  j as (select d.*, ov.invoice_id, ov.original_balance, ov.promo_type, ov.agreement_title, ov.invoice_date as o_date, ov.country as o_country,
      ((original_balance * 100)::bigint - sum((promotion_cost * 100)::bigint) over w)::bigint * quantity as num, (sum(quantity) over w)::bigint as den
    from det d full join (select * from ov where promo_type is not null) ov on d.invoice_number = ov.invoice_id window w as (partition by d.invoice_number))
  select coalesce(invoice_number, invoice_id) as invoice_number, coalesce(invoice_date, o_date)::varchar as invoice_date,
    coalesce(promo, case when promo_type = 'Base Merchandising Fee' then split_part(agreement_title, ':', 2) end, 'VM Promotion') as promotion_id, asin, coalesce(country, o_country) as country, quantity,
    coalesce(promotion_cost, original_balance)::double as promotion_cost, case when promo_type = 'Base Merchandising Fee' then 0.0::double when invoice_number is null then null
      else (sign(num) * ((2 * abs(num) + den) // (2 * den)))::double / 100 end as clp_fee, original_balance::double as invoice_amount, promo_type from j""")
def promo_invoice_log(t):
    out = accrual.promo_invoices(t.pick(promo_info="promo_info", promo_overview="promo_overview", promo_detail="promo_detail"))
    return out.select("invoice_number", "invoice_date", "promotion_id", "asin", "country", "quantity", "promotion_cost", F.round("clp_fee", 2).alias("clp_fee"), "invoice_amount", "promo_type")


ADS_ACC = """
sp as (select report_date, platform, country_code, accname, campaignid, case when upper(platform_item_id) like '%UNALLOCATED%' then 'unallocated_asin' else platform_item_id end as item, spend, fx.to_usd from ads_spend
    left join countries on country_code = country_code_3 left join ads_fx fx on major_currency_code = fx.currency_code and report_date = fx.run_date left join product_owner o on platform_item_id = o.platform_product_id
      and platform = o.platform_short
    where report_date between date '2024-01-01' and date '2024-01-25' and platform not in ('WF', 'WM') and accname <> 'GG Ads' and advertisingtype <> 'Affiliate' and coalesce(o.pims_company, 'MAIN') in ('MAIN', 'SIDE', 'JOINT')),
spa as (select platform, country_code, accname, campaignid, item, sum(spend) as spent, sum(spend * to_usd) as spent_usd from sp group by all),
bl as (select campaignid, country, currency, case when upper(platform_item_id) like '%UNALLOCATED%' then 'unallocated_asin' else platform_item_id end as item, string_agg(distinct summary_id, ' ; ' order by summary_id) as lst,
    sum(asin_allocated_inv_amt) as inv, sum(asin_allocated_inv_amt * to_usd) as inv_usd from ads_billed b left join ads_fx fx on b.currency = fx.currency_code and b.summary_invoicedate = fx.run_date
    left join product_owner o on platform_item_id = o.platform_product_id where summary_invoicedate between date '2024-01-01' and date '2024-01-25' and coalesce(o.pims_company, 'MAIN') in ('MAIN', 'SIDE', 'JOINT') group by 1, 2, 3, 4),
fin as (select coalesce(platform, 'AMZ') as platform, coalesce(country_code, country) as country, accname as account_name, coalesce(spa.campaignid, bl.campaignid) as campaignid, coalesce(spa.item, bl.item) as platform_item_id,
    lst as list_invoice_number, spent, spent_usd, coalesce(inv, 0) as inv, coalesce(inv_usd, 0) as inv_usd from spa full join bl on spa.platform = 'AMZ' and spa.campaignid = bl.campaignid and spa.item = bl.item)"""


def ads_detail(t, period, run_ts):
    tables = t.pick(profiles="product_owner", ads_spend="ads_spend", countries="countries", fx="ads_fx", ads_invoice_log="ads_invoice_log")
    return accrual.ads_accrual(tables, period, run_ts, MERGED, 2024, date(2024, 1, 1), skip_accounts=["GG Ads", "Bme - US"])


@query("accrual_ads_amz", f"""with {ADS_ACC} select platform, country, account_name, campaignid, platform_item_id, list_invoice_number, spent::double as ads_spend, spent_usd::double as ads_spend_usd, inv::double as invoiced_amount,
  inv_usd::double as invoiced_amount_usd, (case when spent > inv then spent - inv else 0 end)::double as accrual, (case when spent_usd > inv_usd then spent_usd - inv_usd else 0 end)::double as accrual_usd,
  'MKTACRAMZ' || country || '202401' as external_doc_no from fin""")
def accrual_ads_amz(t):
    return ads_detail(t, "2024-01", datetime(2024, 1, 26)).drop("posting_date", "run_time")


@query("accrual_ads_amz_gl", f"""with {ADS_ACC}, s as (select country, round(sum(case when spent_usd > inv_usd then spent_usd - inv_usd else 0 end), 2) as amt from fin group by 1)
  select 'AVC ' || country || ': Booking revert accrual Advertising expenses at Feb2024' as descriptions, amt::double as amount, '33510102' as account_no, '64160103' as bal_account_no, '2024-02-25' as posting_date,
    'MKTACRAMZ' || country || '202401' as external_document_no from s where country <> 'GBR'""")
def accrual_ads_amz_gl(t):
    lines = accrual.marketplace_gl(ads_detail(t, "2024-01", datetime(2024, 1, 26)), "2024-02", GL, RUN_TS, "Advertising", skip=["GBR"])
    return lines.select("descriptions", "amount", "account_no", "bal_account_no", "posting_date", "external_document_no")


@query("accrual_ads_wm", """select report_date::varchar as report_date, 'CHAN-WMDSV' as channel, team, sku, sum(spend_usd)::double as amount_spend, sum(unitssold14d) as quantity_sold, 'MKTACRWMDSV202401' as external_doc_no,
  '2024-01-25' as posting_date from ads_spend where platform = 'WM' and accname in ('WM 1P', 'WM 1S') and report_date between date '2023-12-26' and date '2024-01-25' group by 1, 3, 4""")
def accrual_ads_wm(t):
    return accrual.retail_ads_accrual(t["ads_spend"], "2024-01", RUN_TS, ["WM 1P", "WM 1S"]).drop("run_time")


@query("accrual_ads_wm_gl", """select case when report_date <= date '2024-01-25' then 'WM DSV : Booking revert accrual Advertising expenses at Feb2024' else 'WM DSV : Booking accrual Advertising expenses at Feb2024' end as descriptions,
  sum(spend_usd)::double as amount, case when report_date <= date '2024-01-25' then '33510102' else '64160103' end as account_no, '2024-02-25' as posting_date, 'REG-USA' as region_code from ads_spend where platform = 'WM' group by all""")
def accrual_ads_wm_gl(t):
    parts = [accrual.retail_ads_accrual(t["ads_spend"], p, RUN_TS, ["WM 1P", "WM 1S"]) for p in ("2024-01", "2024-02")]
    lines = accrual.single_gl(parts[0].unionByName(parts[1]), "2024-02", GL, RUN_TS, "amount_spend", "WM DSV ", "ADVS-WMDSV", "CHAN-WMDSV", "PLF-WM-1")
    return lines.select("descriptions", "amount", "account_no", "posting_date", "region_code")


@query("accrual_ads_gg", """select segments_date::varchar as segments_date, campaign_id, case de_accountid when 'ACC7' then 'Seventh' else de_accountid end as account_name, (metrics_costmicros::decimal(20,0) * 0.000001)::double as ad_cost,
  'MKTACRGGADS202401' as external_doc_no, '2024-01-25' as posting_date from search_costs where segments_date between date '2023-12-26' and date '2024-01-25'""")
def accrual_ads_gg(t):
    rows = accrual.search_ads_accrual(t["search_costs"], "2024-01", RUN_TS, {"ACC7": "Seventh"})
    return rows.select("segments_date", "campaign_id", "account_name", "ad_cost", "external_doc_no", "posting_date")


@query("accrual_ads_gg_gl", """select case when segments_date <= date '2024-01-25' then 'GG ADS : Booking revert accrual Advertising expenses at Feb2024' else 'GG ADS : Booking accrual Advertising expenses at Feb2024' end as descriptions,
  round(sum(metrics_costmicros::decimal(20,0) * 0.000001), 2)::double as amount, case when segments_date <= date '2024-01-25' then '33510102' else '64160103' end as account_no from search_costs group by all""")
def accrual_ads_gg_gl(t):
    parts = [accrual.search_ads_accrual(t["search_costs"], p, RUN_TS, {}) for p in ("2024-01", "2024-02")]
    lines = accrual.single_gl(parts[0].unionByName(parts[1]), "2024-02", GL, RUN_TS, "ad_cost", "GG ADS ", "ADV-AVC USA_GGA", "", "")
    return lines.select("descriptions", "amount", "account_no")


EST_SQL = """
hd as (select *, case when belong_to_company in ('SIDE', 'JOINT') then 'MAIN' else belong_to_company end as co from est_header where is_processed = 1 and posting_date >= date '2001-06-01' and posting_date < date '2001-07-01'),
ven as (select po_id, case when vendor in ('VENA', 'VENB') then 'AVC WH' when vendor = 'VENG' then 'AVC GPE' when vendor is null then 'Unidentified' else 'AVC DI' end as ch from purchase_orders),
base as (select l.document_no, l.po_number, h.posting_date, h.document_date, h.country, l.no as sku, h.co, l.quantity, l.unit_price, h.internal_sales_channel as ch,
    case when h.sales_channel = 'CHAN-WAYFAIR' then l.quantity * l.unit_price else l.amount end as amount, case when posting_description like '%Booking accrual revenue%' then 'SI Accrual' else 'SI Actual' end as type
  from est_line l join hd h on l.document_no = h.external_doc_no where internal_sales_channel in ('AVC DS', 'AVC WH', 'AVC DI', 'AVC GPE', 'WF', 'WF CG') and bill_to_customer not like '%INTC%' and document_type = 'Order'
  union all select l.document_no, l.po_number, h.posting_date, h.document_date, l.country, l.no, h.co, l.quantity, l.unit_price, case when l.po_number like '%DROPSHIP%' then 'AVC DS' else 'AVC WH' end, - l.amount, 'SRT Actual'
  from est_line l join hd h on l.document_no = h.external_doc_no left join ven on l.po_number = po_id where document_type = 'Sales Return' and (ven.ch in ('AVC DS', 'AVC WH') or ven.ch is null)
  union all select l.document_no, l.po_number, h.posting_date, h.document_date, l.country, l.no, h.co, l.quantity, l.unit_price, ven.ch, - l.amount, 'SRT Actual'
  from est_line l join hd h on l.document_no = h.external_doc_no left join ven on l.po_number = po_id where document_type = 'Sales Return' and ven.ch = 'AVC DI' and split_part(l.country, '-', 2) in ('DEU', 'JPN')),
rt as (select *, replace(document_no, '_Return', '') as doc, case when ch in ('AVC DS', 'AVC WH') then 0.09 else 0 end as r1, case when ch = 'AVC DI' and country = 'REG-DEU' then 0.02 else 0 end as r2,
    case when ch = 'AVC DI' and country = 'REG-JPN' then 0.08 else 0 end as r3, case when ch = 'AVC DI' and country = 'REG-DEU' then 0.03 else 0 end as r4,
    case when document_no not like '%Return%' and ch = 'AVC WH' then case when document_date <= date '2023-03-31' then 0.117 else 0.122 end else 0 end as r5, case when ch = 'AVC DI' and country = 'REG-DEU' then 0.02 else 0 end as r6,
    case when ch in ('WF', 'WF CG') then 0.04 else 0 end as r7, case when ch in ('AVC DS', 'AVC WH') and replace(document_no, '_Return', '') not in (select replace(external_doc_no, '_Return', '') from est_header
      where document_type = 'Sales Return') then 0.0375 else 0 end as r8, case when ch in ('AVC DS', 'AVC DI', 'AVC WH') and sku in (select pims_sku from furniture_items) then 0.013 else 0 end as r9 from base),
est as (""" + " union all ".join(
    f"select doc, po_number, posting_date, document_date, country, sku, co, quantity, unit_price, ch, amount, type, r{i} as rate, amount * r{i}::decimal(6,4) as accrual_amt, '{note}' as note from rt where r{i} <> 0"
    + (f" and amount <> 0" if i not in (4, 6) else "")
    for i, note in enumerate(("COOP_MKT", "Coop DI", "DI JPN AVS_SVS", "DI DEU GBR AVS_SVS", "Freight_Allowance", "Damage_Allowance", "Damage_Allowance", "Damage_Allowance", "Furniture_SVS_AVS"), 1)) + ")"


def estimate(t):
    tables = t.pick(posted_header="est_header", posted_line="est_line", purchase_orders="purchase_orders", furniture_items="furniture_items")
    return accrual.accrual_estimate(tables, AS_OF, merged=("SIDE", "JOINT"), main="MAIN", stock_vendors=["VENA", "VENB"], gpe_vendors=["VENG"])


@query("accrual_estimate", f"""with {EST_SQL} select doc as original_invoice, concat(doc, '_', co) as invoice_number, po_number, posting_date::varchar as posting_date, country, sku, co as company, quantity::double as quantity,
  unit_price::double as unit_price, ch as internal_sales_channel, amount::double as amount, type, rate::double as rate, accrual_amt::double as accrual_amt, note from est""")
def accrual_estimate(t):
    return estimate(t).select("original_invoice", "invoice_number", "po_number", "posting_date", "country", "sku", "company", "quantity", "unit_price", "internal_sales_channel", "amount", "type", "rate",
                              "accrual_amt", "note")


@query("accrual_estimate_log", f"""with {EST_SQL} select concat(ch, '-', right(country, 3), ': Accrual estimate ', note, ' exps Inv# ', doc, '_', co, '_', strftime(document_date, '%y%m%d')) as description, accrual_amt::double as amount,
  amount::double as si_amount, concat(doc, '_', co) as external_document_no, rate::double as rate, 'GENERAL' as journal_template_name, '2001-07-20 05:00:00' as run_time from est""")
def accrual_estimate_log(t):
    out = accrual.estimate_log(estimate(t), RUN_TS)
    return out.select("description", "amount", "si_amount", "external_document_no", "rate", "journal_template_name", "run_time").orderBy("external_document_no", "rate")


@query("accrual_estimate_final", f"""with {EST_SQL}, seen as (select distinct concat(doc, '_', co) as d, document_date as dt from est where ch = 'WF')
  select concat(doc, '_', co) as external_document_no, document_date::varchar as document_date, note, accrual_amt::double as amount, sku from est where not exists (select 1 from seen where d = concat(doc, '_', co) and dt = document_date)""")
def accrual_estimate_final(t):
    detail = estimate(t)
    stamped = lambda df, ts: accrual.estimate_log(df, ts).withColumn("sku", F.lit(None).cast("string"))
    with_sku = lambda df, ts: df.select("sku", "invoice_number", "document_date", "note", "accrual_amt", "posting_date").withColumnsRenamed(
        {"invoice_number": "external_document_no", "accrual_amt": "amount"}).withColumn("run_time", F.lit(ts))
    log = with_sku(detail, datetime(2001, 7, 19)).unionByName(with_sku(detail, RUN_TS))
    final = with_sku(detail.where("internal_sales_channel = 'WF'"), RUN_TS)
    return accrual.estimate_final(log, final, AS_OF).select("external_document_no", "document_date", "note", "amount", "sku")


@query("ads_allocate_by_asin", """with spent as (select campaignid, report_date, platform_item_id, sum(spend) as s from ads_spend group by all),
  inv as (select campaignid, report_date, summary_id, asin_allocated_inv_amt as amt from ads_billed)
  select inv.summary_id, inv.campaignid, inv.report_date::varchar as report_date, i.platform_item_id, s::double as asin_spend_amt,
    (((2 * (amt * 100)::bigint * (s * 100)::bigint + (sum(s) over w * 100)::bigint) // (2 * (sum(s) over w * 100)::bigint))::double / 100) as asin_allocated_inv_amt
  from inv left join spent i on inv.campaignid = i.campaignid and inv.report_date = i.report_date window w as (partition by inv.summary_id, inv.campaignid, inv.report_date)""")
def ads_allocate_by_asin(t):
    invoices = t["ads_billed"].select("campaignid", "report_date", "summary_id", F.col("asin_allocated_inv_amt").alias("cmp_allocated_inv_amt"))
    out = accrual.allocate_ads_by_item(invoices, t["ads_spend"])
    return out.select("summary_id", "campaignid", "report_date", "platform_item_id", "asin_spend_amt", F.round("asin_allocated_inv_amt", 2).alias("asin_allocated_inv_amt"))


@query("accrual_report", f"""with {EST_SQL} select concat(doc, '_', co) as external_document_no, posting_date::varchar as posting_date, note, accrual_amt::double as amount from est where posting_date >= date '2001-06-10'""")
def accrual_report(t):
    log = accrual.estimate_log(estimate(t), RUN_TS)
    return recon.accrual_report(log, date(2001, 6, 10)).select("external_document_no", "posting_date", "note", "amount")
