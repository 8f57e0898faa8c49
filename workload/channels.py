"""The six sales-invoice channels, each as document lines with the facts of their header."""

from datetime import date, datetime

from ledgerloom.plans import config as c
from ledgerloom.plans import sales_invoice as si
from ledgerloom.session import new_stage_path
from ledgerloom.sources.versions import SnapshotLog
from workload.registry import ORACLE, query

AS_OF = date(2001, 7, 20)
RUN_TS = datetime(2001, 7, 20, 5, 0, 0)
SINCE = date(1995, 1, 1)
CORE = ("MAIN", "SIDE", "JOINT")
PARTNERS = ("MAIN", "JOINT")

SHOWN = ["document_no", "line_no", "type", "no", "uom", "unit_price", "discount", "quantity", "location_code", "amount",
         "country", "po_number", "original_asin_sku", "posting_date", "posting_description", "location", "currency",
         "header_country", "internal_sales_channel", "belong_to_company", "name", "payment_term_code", "is_processed"]

LINE_COLS = SHOWN[:SHOWN.index("posting_date")]
HEAD_COLS = SHOWN[SHOWN.index("posting_date"):]
# what headers of one document may differ in besides; all else is one value in the candidates of a channel
TOLD_APART = ["order_date", "document_date", "customer_posting_group", "original_external_doc_no", "company_id", "original_company_id"]

# ---- oracle fragments ----
POSTING = """case when date_trunc('month', order_date) < date '2001-07-01' then date '2001-07-01'
  when date_trunc('month', order_date) = date '2001-07-01' then order_date end"""


def describe(stamp: str) -> str:
    return f"""concat(split_part(country, '-', 2), '-', split_part(sales_channel, '-', 2), ': Booking revenue, Inv#',
      external_doc_no, '_', strftime({stamp}, '%y%m%d'))"""


RUN_DAY = "date '2001-07-20'"
LOCATED = """(select transaction_id, min(loc) as loc from (select transaction_id, case warehouse when 'ANA' then '156-USA-CA'
    when 'CRA' then '156-3PL-CB' when 'FLO' then '156-3PL-FR' when 'FON' then '156-3PL-FT' else 'Unidentified' end as loc
    from {txn} where log_date >= date '1995-01-01' and ims_id is not null and qty <> 0 and not (ims_id = 0 and log_id = 0))
  group by 1 having count(distinct loc) = 1)"""


def cents(num: str, den: str) -> str:
    """Exact half-up division of a non-negative amount to cents."""
    return f"cast((2 * cast({num} * 100 as bigint) + {den}) // (2 * nullif({den}, 0)) as double) / 100"


def final_sql(lines: str, heads: str) -> str:
    """Lines joined with distinct headers, shown in the common layout."""
    return f"""
    , l as (select distinct * from ({lines})), h as (select distinct * from ({heads}))
    select l.document_no, l.line_no, l.type, l.no, case when l.no in ('33890101', '71190101', '52120101') then null else l.uom end as uom,
      cast(l.unit_price as double) as unit_price, cast(l.discount as double) as discount, cast(l.quantity as double) as quantity,
      l.location_code, cast(l.amount as double) as amount, l.country, l.po_number, l.original_asin_sku,
      cast(h.posting_date as varchar) as posting_date, h.posting_description, h.location, h.currency,
      h.country as header_country, h.internal_sales_channel, h.belong_to_company,
      coalesce(case h.belong_to_company when 'Bluestars' then 'US-MER0002-BLS' when 'Bitis' then 'US-SER0002-BTT'
        when 'A&D' then '331US-SER0019-A&D' when 'HMD' then 'US-SER0003-HUR' end, h.name) as name,
      h.payment_term_code, h.is_processed
    from l left join h on l.document_no = h.external_doc_no"""


HEAD = """order_date, posting_date, posting_description, external_doc_no, {loc} as location, currency, country, internal_sales_channel,
  belong_to_company, {name} as name, payment_term as payment_term_code, {flag} as is_processed, original_external_doc_no"""
LINE = """external_doc_no as document_no, line_no, {type} as type, {no} as no, {uom} as uom, {price} as unit_price,
  {disc} as discount, {qty} as quantity, {loc} as location_code, {amt} as amount, country, po_number, asin as original_asin_sku,
  sales_channel"""
OWN_HEAD = HEAD.format(loc="wh_location", name="cast(null as varchar)", flag="0")
OBH_HEAD = HEAD.format(loc="wh_location", name="bill_to", flag="0")
OWN_LINE = LINE.format(type="'ITEM'", no="no", uom="'pcs'", price="unit_price", disc="discount", qty="quantity", loc="wh_location", amt="amount")
OBH_LINE = LINE.format(type="'G/L Account'", no="'33890101'", uom="null", price="unit_price", disc="discount", qty="1", loc="wh_location", amt="amount")
OBH_ITEM = LINE.format(type="'ITEM'", no="no", uom="'pcs'", price="0", disc="0", qty="quantity", loc="wh_location", amt="0")
OBH_ITEM_PRICED = LINE.format(type="'ITEM'", no="no", uom="'pcs'", price="unit_price", disc="discount", qty="quantity", loc="wh_location", amt="0")


def own_sql(owners: str, anti: str, stamp: str, txn: str | None, key: str) -> str:
    place = f"coalesce(case when s.wh_location = 'Unidentified' then e.loc end, s.wh_location)" if txn else "s.wh_location"
    evidence = f"left join {LOCATED.format(txn=txn)} e on s.{key} = e.transaction_id" if txn else ""
    return f"""select s.* exclude (wh_location), {place} as wh_location, {POSTING} as posting_date,
      {describe(stamp)} as posting_description from cand s {evidence}
      where belong_to_company in ({owners}) and order_date between date '1995-01-01' and {RUN_DAY} and {anti}"""


def obh_sql(owners: str, anti: str, stamp: str, posting: str, place: str) -> str:
    return f"""select s.* exclude (wh_location), {place} as wh_location, {posting} as posting_date,
      {describe(stamp)} as posting_description from cand s
      where belong_to_company not in ({owners}) and order_date between date '1995-01-01' and {RUN_DAY} and {anti}"""


def unposted(pst: str, exc: str | None, types: str = "'ORDER'", key: str = "external_doc_no") -> str:
    lists = f"select {key} from {pst} where upper(document_type) in ({types})"
    if exc:
        lists += f" union select external_doc_no from {exc}"
    return f"(s.{key} is null or s.{key} not in (select x from ({lists}) y(x) where x is not null))"


CHANNELS = {}


def channel(name, sql):
    """Register a channel: ``fn(tables, log, shown)`` gives its headers and lines, the key shows lines with the facts of their header."""

    def register(fn):
        CHANNELS[name] = fn
        query(name, sql)(lambda t: shown_lines(*fn(t, new_log(t), [*SHOWN, *TOLD_APART])))
        return fn

    return register


def shown_lines(header, line):
    """Lines of one channel with the facts of their header. Its headers are distinct already; its lines differ in nothing but shown columns."""
    return si.document_lines(header, line.select(*LINE_COLS).distinct()).select(*SHOWN)


def new_log(t):
    return SnapshotLog(t.spark, new_stage_path(t.spark, "snapshot_log"), ["internal_sales_channel"])


def booked(log, cand, tables, cfg, **more):
    """Write the candidates to a snapshot log once, then book the newest load from it: headers and lines."""
    log.append(cand, RUN_TS, covers=[[channel] for channel in cfg.channels])
    return si.run_channel(cand, tables, cfg, AS_OF, snapshot_log=log, **more)


def core(tables, pst, exc, txn, **more):
    return {"posted_header": tables[pst], "transactions": tables[txn] if txn else None,
            **({"excluded": tables[exc]} if exc else {}), **more}


# ---- settlements -----------------------------------------------------------------------------
SETTLEMENT_CAND = f"""
with cand as (
  select settlement_date as order_date, po_id || '_' || strftime(report_date, '%Y%m%d') as external_doc_no,
    'Unidentified' as wh_location, cast(null as varchar) as currency, 'CHAN-WMMKP' as sales_channel, 'REG-USA' as country,
    10000 * row_number() over (partition by po_id || '_' || strftime(report_date, '%Y%m%d')
      order by sku, coalesce(nullif(original_item_price, 0), product_price), ship_qty, settlement_date) as line_no,
    left(sku, 4) as no, {cents('coalesce(nullif(original_item_price, 0), product_price)', 'ship_qty')} as unit_price,
    cast(null as double) as discount, ship_qty as quantity,
    coalesce(nullif(original_item_price, 0), product_price) as amount, po_id as po_number, 'WM WFS' as internal_sales_channel,
    po_id as original_external_doc_no, sku as asin, 'MAIN' as belong_to_company, '14D' as payment_term, '131US-MER0002-WM' as bill_to
  from settlements where transaction_type = 'SALE' and settlement_date between date '1995-01-01' and {RUN_DAY})"""


@channel("si_settlement", f"""{SETTLEMENT_CAND}
, own as ({own_sql("'MAIN', 'SIDE', 'JOINT'", unposted('pst_wfs', 'exc_wfs') + '''
    and s.po_number not in (select po_number from shipped_lines where not regexp_matches(location_code, 'SRT'))''', RUN_DAY, 'txn_wfs', 'po_number')})
{final_sql(f'select {OWN_LINE} from own', f'select {OWN_HEAD} from own')}""")
def si_settlement(t, log, shown=None):
    cand = si.settlement_candidates(t.pick(settlements="settlements", companies="companies"), AS_OF, RUN_TS, SINCE, "MAIN", "CO1", placed=True)
    cfg = c.settlement_channel(CORE, SINCE)
    return booked(log, cand, core(t, "pst_wfs", "exc_wfs", "txn_wfs", posted_line=t["shipped_lines"]), cfg, shown=shown)


# ---- drop-ship with promotions ---------------------------------------------------------------
DROPSHIP_CAND = f"""
with settled as (select purchase_order_id from order_lines where cast(order_date as date) between date '1995-01-01' and {RUN_DAY}
    group by 1 having count(*) = count(*) filter (where order_line_status in ('Delivered', 'Shipped', 'Cancelled'))
      and count(*) filter (where order_line_status in ('Delivered', 'Shipped')) > 0),
ids as (select supplier_stock_id, string_agg(distinct item_id, ',' order by item_id) as ids from catalogue
    where run_date = (select max(run_date) from catalogue) and fulfillment_method = 'DSV' and site_status <> 'UNPUBLISHED' group by 1),
promos as (select * from promo_log where data_updated_time = (select max(data_updated_time) from promo_log)),
pairs as (select distinct ids, item_id from (select distinct ids from ids) join promos on position(item_id in ids) > 0),
gtin as (select distinct product_gtin, supplier_stock_id from catalogue
    where run_date = (select max(run_date) from catalogue) and product_gtin is not null),
priced as (select o.*, coalesce(y.ids, z.ids) as item_ids from order_lines o
    left join ids y on o.item_sku = y.supplier_stock_id left join ids z on left(o.item_sku, 4) = z.supplier_stock_id
    where purchase_order_id in (select purchase_order_id from settled)
      and purchase_order_id not in (select original_external_doc_no from pst_dsv)),
promo_rows as (select p.*, b.current_cost from priced p left join
    (select pairs.ids, promos.* from pairs join promos on pairs.item_id = promos.item_id) b
    on p.item_ids = b.ids and p.order_date between b.promo_start_1 and b.promo_end_1),
costed as (select r.*, case when r.item_sku in (select sku_supplier_stock_id from promo_sheet)
      then unit_cost_by_logic + coalesce(s.funding_amount, 0) else coalesce(current_cost, unit_cost_by_logic) end as price
    from promo_rows r left join promo_sheet s on r.item_sku = s.sku_supplier_stock_id
      and cast(r.order_date as date) between s.promo_start_1 and s.promo_end_1),
cand as (select cast(order_date as date) as order_date, purchase_order_id as external_doc_no, 'Unidentified' as wh_location,
    cast(null as varchar) as currency, 'CHAN-WMDSV' as sales_channel, 'REG-USA' as country,
    10000 * row_number() over (partition by purchase_order_id order by item_sku, order_line_id, unit_cost_by_logic,
      order_line_quantity_amount, order_line_quantity_amount * price) as line_no,
    left(coalesce(g.supplier_stock_id, item_sku), 4) as no, unit_cost_by_logic as unit_price, cast(null as double) as discount,
    order_line_quantity_amount as quantity, round(order_line_quantity_amount * cast(price as double), 2) as amount,
    purchase_order_id as po_number, 'WM DSV' as internal_sales_channel, purchase_order_id as original_external_doc_no,
    item_sku as asin, 'MAIN' as belong_to_company, '60D' as payment_term, '131US-MER0002-WM' as bill_to
  from costed left join gtin g on item_sku = g.product_gtin)"""


@channel("si_dropship_promo", f"""{DROPSHIP_CAND}
, own as ({own_sql("'MAIN', 'SIDE', 'JOINT'", unposted('pst_dsv', 'exc_dsv'), RUN_DAY, 'txn_dsv', 'po_number')})
{final_sql(f'select {OWN_LINE} from own', f'select {OWN_HEAD} from own')}""")
def si_dropship_promo(t, log, shown=None):
    raw = t.pick(order_lines="order_lines", catalogue="catalogue", promo_log="promo_log", promo_sheet="promo_sheet",
                 companies="companies", posted_header="pst_dsv")
    cand = si.dropship_candidates(raw, AS_OF, RUN_TS, SINCE, "MAIN", "CO1", SINCE, placed=True)
    cfg = c.dropship_channel(CORE, SINCE)
    return booked(log, cand, core(t, "pst_dsv", "exc_dsv", "txn_dsv"), cfg, shown=shown)


# ---- base-cost invoices ----------------------------------------------------------------------
BASECOST_CAND = f"""
with base as (
  select cast(a.invoice_date as date) as order_date, a.invoice_num, e.belong_to_company,
    a.po_num not in (select order_id from dropship_export) as castle, a.account_name as account, a.currency as ccy,
    b.item_number, b.wholesale_price, b.quantity, c.base_cost * b.quantity as amount, a.po_num
  from invoices a join orders_export b on a.po_num = b.po_number and b.order_status <> 'Cancelled'
  left join base_cost c on b.item_number = c.supplier_part_number and b.po_date_time between c.effective_from and c.effective_to
    and a.account_name = c.account_name
  left join items e on left(b.item_number, 4) = e.item_id
  where a.amount > 0 and right(a.invoice_num, 3) not like '%CM%' and cast(a.invoice_date as date) <= {RUN_DAY}),
cand as (select order_date, case when belong_to_company in ('MAIN', 'SIDE', 'JOINT') then invoice_num
      when belong_to_company is not null then invoice_num || '-OBH-' || belong_to_company end as external_doc_no,
    case when belong_to_company = 'Bluestars' then '156-OBH-CA'
      when castle and belong_to_company not in ('MAIN', 'SIDE', 'JOINT') then '157-OBH'
      when castle and belong_to_company in ('MAIN', 'SIDE', 'JOINT') then
        case account when 'ACCT_US' then '157-WFC-US' else '157-WF-CAN' end else 'Unidentified' end as wh_location,
    nullif(ccy, 'USD') as currency, 'CHAN-WAYFAIR' as sales_channel,
    case account when 'ACCT_US' then 'REG-USA' else 'REG-CAN' end as country,
    10000 * row_number() over (partition by concat(invoice_num, belong_to_company in ('MAIN', 'SIDE', 'JOINT'),
        case when belong_to_company in ('MAIN', 'SIDE', 'JOINT') then '' else belong_to_company end)
      order by item_number, wholesale_price, quantity, amount nulls first) as line_no,
    left(item_number, 4) as no, wholesale_price as unit_price, cast(null as double) as discount, quantity, amount,
    po_num as po_number, case when castle then 'WF CG' else 'WF' end as internal_sales_channel,
    invoice_num as original_external_doc_no, item_number as asin, belong_to_company, '60D' as payment_term,
    '131US-MER0001-WF' as bill_to from base)"""
WF_SCOPED = unposted('pst_wf', 'exc_wf')


@channel("si_invoice_basecost", f"""{BASECOST_CAND}
, own as ({own_sql("'MAIN', 'SIDE', 'JOINT'", WF_SCOPED, 'order_date', 'txn_wf', 'original_external_doc_no')})
, obh as ({obh_sql("'MAIN', 'SIDE', 'JOINT'", unposted('pst_wf', None), 'order_date', POSTING,
    "case when belong_to_company = 'HMD' then null else wh_location end")})
{final_sql(f'''select {OWN_LINE} from own union all select {OBH_LINE} from obh
  union all select {OBH_ITEM_PRICED} from obh where belong_to_company in ('Bluestars', 'Bitis')''',
  f'select {OWN_HEAD} from own union all select {OBH_HEAD} from obh')}""")
def si_invoice_basecost(t, log, shown=None):
    raw = t.pick(invoices="invoices", orders_export="orders_export", base_cost="base_cost", items="items",
                 companies="companies", dropship_export="dropship_export")
    cand = si.basecost_candidates(raw, AS_OF, RUN_TS, SINCE, CORE, "CO2", "CO1", {"ACCT_US": "REG-USA", "ACCT_CA": "REG-CAN"},
                                  {"ACCT_US": "157-WFC-US", "ACCT_CA": "157-WF-CAN"}, placed=True)
    cfg = c.basecost_channel(CORE, SINCE)
    return booked(log, cand, core(t, "pst_wf", "exc_wf", "txn_wf"), cfg, shown=shown)


# ---- direct fulfilment -----------------------------------------------------------------------
DF_CAND = f"""
with base as (select cast(e.invoicedate as date) as order_date, a.invoicenumber as num, p.pims_sku, a.quantity, a.subtotal,
    a.asin, e.country as land, c.belong_to_company from df_items a join df_summary e on a.invoicenumber = e.invoicenumber
  left join profiles p on a.asin = p.platform_prd_id and p.country = e.country left join items c on p.pims_sku = c.item_id
  where e.status <> 'REJECTED' and cast(e.invoicedate as date) <= {RUN_DAY}),
cand as (select order_date, case when belong_to_company in ('MAIN', 'SIDE', 'JOINT') then num
      when belong_to_company is not null then num || '-OBH-' || belong_to_company end as external_doc_no,
    case when belong_to_company in ('MAIN', 'SIDE', 'JOINT') then 'Unidentified'
      when upper(belong_to_company) in ('HMD', 'MOONKEY') then null else '156-OBH-CA' end as wh_location,
    cast(null as varchar) as currency, 'CHAN-AVC' as sales_channel, 'REG-' || land as country,
    10000 * row_number() over (partition by num, case when belong_to_company in ('MAIN', 'SIDE', 'JOINT') then '*' else belong_to_company end
      order by asin, subtotal, quantity) as line_no,
    pims_sku as no, {cents('subtotal', 'quantity')} as unit_price, cast(null as double) as discount, quantity, subtotal as amount,
    num as po_number, 'AVC DS' as internal_sales_channel, num as original_external_doc_no, asin, belong_to_company,
    '60D' as payment_term, '131US-MER0001-AMZ' as bill_to from base)"""
DF_OPEN = """s.original_external_doc_no not in (select original_external_doc_no from pst_ds where document_type = 'Order')"""


@channel("si_direct_fulfil", f"""{DF_CAND}
, own as ({own_sql("'MAIN', 'SIDE', 'JOINT'", DF_OPEN, 'order_date', 'txn_ds', 'original_external_doc_no')})
, obh as ({obh_sql("'MAIN', 'SIDE', 'JOINT'", DF_OPEN, 'order_date', POSTING,
    "case when belong_to_company = 'HMD' then null else '156-OBH-CA' end")})
, heads as (select distinct {OWN_HEAD} from own union all select distinct {OBH_HEAD} from obh)
, mixed as (select external_doc_no from heads group by 1 having count(*) filter (where belong_to_company = 'MAIN') > 0
    and count(*) filter (where belong_to_company in ('SIDE', 'JOINT')) > 0)
{final_sql(f'''select {OWN_LINE} from own union all select {OBH_LINE} from obh
  union all select {OBH_ITEM} from obh where belong_to_company <> 'HMD' ''',
  "select * from heads where not (external_doc_no in (select external_doc_no from mixed) and belong_to_company in ('SIDE', 'JOINT'))")}""")
def si_direct_fulfil(t, log, shown=None):
    raw = t.pick(df_items="df_items", df_summary="df_summary", profiles="profiles", items="items", companies="companies")
    cand = si.direct_fulfil_candidates(raw, AS_OF, RUN_TS, SINCE, CORE, "CO1", placed=True)
    cfg = c.direct_fulfil_channel(CORE, SINCE, "MAIN")
    return booked(log, cand, core(t, "pst_ds", None, "txn_ds"), cfg, shown=shown)


# ---- payment report --------------------------------------------------------------------------
PAY_CAND = f"""
with sold as (select distinct amazon_order_id, sellersku, asin from seller_orders_a
  union all select distinct amazon_order_id, sellersku, asin from seller_orders_b),
base as (select a.*, o.asin, p.pims_sku, c.belong_to_company,
    case fulfillment when 'FBM' then fbm_product_sales when 'FBA' then fba_product_sales end as sales,
    concat(order_id, '_', strftime(date_time, '%Y%m%d')) as doc
  from payments a left join sold o on a.sku = o.sellersku and a.order_id = o.amazon_order_id
  left join profiles p on o.asin = p.platform_prd_id and p.country = a.country
  left join items c on p.pims_sku = c.item_id and c.original_company_id = a.company
  where a.type = 'Order' and date_time <= {RUN_DAY}),
cand as (select date_time as order_date, case when belong_to_company in ('MAIN', 'SIDE', 'JOINT') then doc
      else concat(doc, '-', belong_to_company) end as external_doc_no,
    case when upper(belong_to_company) in ('HMD', 'MOONKEY') then null
      when belong_to_company in ('MAIN', 'SIDE', 'JOINT') then case fulfillment when 'FBM' then 'Unidentified' else
        case country when 'USA' then '157-FA-USA' when 'CAN' then '157-FA-CAN' when 'GBR' then '157-FA-UK'
          when 'JPN' then '157-FA-JPN' when 'DEU' then '157-FA-FRA' else 'Unidentified' end end
      when belong_to_company is null then 'Unidentified' else '156-OBH-CA' end as wh_location,
    nullif(currency_code, 'USD') as currency, 'CHAN-ASC' as sales_channel, 'REG-' || country as country,
    10000 * row_number() over (partition by case when belong_to_company in ('MAIN', 'SIDE', 'JOINT') then doc
      else concat(doc, '-', belong_to_company) end order by asin nulls first, sales, quantity, - promotional_rebates,
      case fulfillment when 'FBM' then 'ASC FBM' else 'ASC FBA' end) as line_no,
    left(pims_sku, 4) as no, {cents('sales', 'quantity')} as unit_price, - promotional_rebates as discount, quantity, sales as amount,
    order_id as po_number, case fulfillment when 'FBM' then 'ASC FBM' else 'ASC FBA' end as internal_sales_channel,
    order_id as original_external_doc_no, asin, belong_to_company, '14D' as payment_term, '131US-MER0001-AMZ' as bill_to from base)"""


@channel("si_payment_report", f"""{PAY_CAND}
, own as ({own_sql("'MAIN', 'SIDE', 'JOINT'", unposted('pst_asc', 'exc_asc'), RUN_DAY, 'txn_asc', 'original_external_doc_no')})
, obh as ({obh_sql("'MAIN', 'SIDE', 'JOINT'", unposted('pst_asc', None), RUN_DAY, RUN_DAY, "s.wh_location")})
{final_sql(f'''select {OWN_LINE} from own union all select {OBH_LINE} from obh
  union all select {OBH_ITEM} from obh where belong_to_company <> 'HMD' ''',
  f'select {OWN_HEAD} from own union all select {OBH_HEAD} from obh')}""")
def si_payment_report(t, log, shown=None):
    raw = t.pick(payments="payments", seller_orders_a="seller_orders_a", seller_orders_b="seller_orders_b",
                 profiles="profiles", items="items", companies="companies")
    cand = si.payment_candidates(raw, AS_OF, RUN_TS, SINCE, CORE, placed=True)
    cfg = c.payment_channel(CORE, SINCE)
    return booked(log, cand, core(t, "pst_asc", "exc_asc", "txn_asc"), cfg, shown=shown)


# ---- vendor invoices -------------------------------------------------------------------------
VENDOR_CAND = f"""
with base as (select a.invoice_number as num, cast(a.invoice_date as date) as order_date, a.country as land, b.*,
    coalesce(p.pims_sku, s.sku) as item, c.belong_to_company,
    case when v.vendor in ('VENA', 'VENB') then 'AVC WH' when v.vendor = 'VENG' then 'AVC GPE' when v.vendor is null then 'Unidentified'
      else 'AVC DI' end as channel, v.po_id
  from vendor_invoices a join vendor_invoice_detail b on a.invoice_number = b.invoice_number
  left join purchase_orders v on b.purchase_order_id = v.po_id
  left join profiles p on b.asin = p.platform_prd_id and a.country = p.country and p.country = 'USA'
  left join second_skus s on s.amz_po = b.purchase_order_id and s.asin = b.asin
  left join items c on coalesce(p.pims_sku, s.sku) = c.item_id
  where b.invoice_number not like '%SCR' and b.invoice_number not like '%PCR' and cast(a.invoice_date as date) <= {RUN_DAY}),
cand as (select order_date, case when belong_to_company in ('MAIN', 'SIDE', 'JOINT') then num
      else concat(num, '-OBH-', belong_to_company) end as external_doc_no,
    case when belong_to_company in ('MAIN', 'SIDE', 'JOINT') then case channel
        when 'AVC DI' then '157-DI-' || land when 'AVC GPE' then '157-DI-GPE' when 'AVC WH' then 'Unidentified' end
      when upper(belong_to_company) in ('HMD', 'MOONKEY') or belong_to_company is null then null else '156-OBH-CA' end as wh_location,
    cast(null as varchar) as currency, 'CHAN-AVC' as sales_channel,
    case when channel in ('AVC DI', 'AVC GPE') then 'REG-' || land when channel = 'AVC WH' then 'REG-USA' else 'Unidentified' end as country,
    10000 * row_number() over (partition by case when belong_to_company in ('MAIN', 'SIDE', 'JOINT') then num
      else concat(num, '-OBH-', belong_to_company) end order by asin, invoice_price, invoice_quantity, purchase_order_id) as line_no,
    item as no, {cents('invoice_price', 'invoice_quantity')} as unit_price, cast(null as double) as discount,
    invoice_quantity as quantity, invoice_price as amount, purchase_order_id as po_number, channel as internal_sales_channel,
    num as original_external_doc_no, asin, belong_to_company,
    case when channel in ('AVC DI', 'AVC GPE') then '120D' else '90D' end as payment_term, '131US-MER0001-AMZ' as bill_to from base)"""
EXTRA = "external_doc_no in (select invoice_no from extra_invoices where upper(type_of_invoice) = 'EXTRA INVOICE' or invoice_vendor = 0)"
EXTRA_HEAD = HEAD.format(loc=f"case when {EXTRA} then null else wh_location end", name="cast(null as varchar)", flag=f"case when {EXTRA} then 2 else 0 end")
EXTRA_LINE = LINE.format(type=f"case when {EXTRA} then 'G/L Account' else 'ITEM' end", no=f"case when {EXTRA} then '71190101' else no end",
                         uom=f"case when {EXTRA} then null else 'pcs' end", price="unit_price", disc="discount", qty="quantity",
                         loc="wh_location", amt="amount")


@channel("si_vendor_invoice", f"""{VENDOR_CAND}
, own as ({own_sql("'MAIN', 'SIDE', 'JOINT'", unposted('pst_avc', 'exc_avc', "'ORDER', 'ACCRUAL'"), RUN_DAY, None, '')})
, obh as ({obh_sql("'MAIN', 'SIDE', 'JOINT'", "s.external_doc_no not in (select external_doc_no from pst_avc)", RUN_DAY, RUN_DAY,
    "case when belong_to_company = 'HMD' then null else '156-OBH-CA' end")})
, last_ship as (select * from (select *, row_number() over (partition by shipment_id order by run_date desc) as rn from shipments) where rn = 1)
, ship_docs as (select unnest(string_split(purchase_order, ',')) || '_' || reference_id as doc, ship_from_city from last_ship where purchase_order <> '')
, ship as (select doc, case when bool_or(ship_from_city = 'Fontana') then '156-3PL-FT' when bool_or(ship_from_city = 'Cranbury') then '156-3PL-CB'
    when bool_or(ship_from_city in ('Anaheim', 'Brea')) then '156-USA-CA' else '156-3PL-FR' end as place from ship_docs
    where ship_from_city in ('Anaheim', 'Brea', 'Fontana', 'Cranbury', 'FLORENCE') group by 1)
, heads as (select h.* replace (case when belong_to_company not in ('MAIN', 'SIDE', 'JOINT') and internal_sales_channel = 'AVC DI'
      then '157-OBH' else coalesce(ship.place, h.location) end as location)
    from (select {EXTRA_HEAD} from own union all select {OBH_HEAD} from obh) h left join ship on h.external_doc_no = ship.doc)
, lines as (select x.* replace (case when document_no in (select external_doc_no from heads where location = '157-OBH') then '157-OBH'
      else coalesce(ship.place, x.location_code) end as location_code)
    from (select {EXTRA_LINE} from own union all select {OBH_LINE} from obh union all select {OBH_ITEM} from obh where belong_to_company <> 'HMD') x
    left join ship on x.document_no = ship.doc)
{final_sql('select * from lines', 'select * from heads')}""")
def si_vendor_invoice(t, log, shown=None):
    raw = t.pick(vendor_invoices="vendor_invoices", vendor_invoice_detail="vendor_invoice_detail", purchase_orders="purchase_orders",
                 profiles="profiles", second_skus="second_skus", items="items", companies="companies")
    cand = si.vendor_candidates(raw, AS_OF, RUN_TS, SINCE, CORE, "CO1", ["VENA", "VENB"], ["VENG"], placed=True)
    cfg = c.vendor_channel(CORE, SINCE)
    return booked(log, cand, core(t, "pst_avc", "exc_avc", None), cfg, extra_invoices=t["extra_invoices"],
                  shipments=t["shipments"], shown=shown)


# ---- manual documents and the daily tables -----------------------------------------------------
MANUAL_ROWS = """select external_doc_no, order_date, asin, no, amount, quantity, discount, country, belong_to_company from (
    select po_id as external_doc_no, settlement_date as order_date, sku as asin, left(sku, 4) as no, coalesce(nullif(original_item_price, 0), product_price) as amount,
      ship_qty as quantity, cast(1.25 as decimal(18,4)) as discount, 'REG-USA' as country, 'MAIN' as belong_to_company from settlements where transaction_type = 'SALE') x"""


@query("add_in", f"""with r as ({MANUAL_ROWS}), f as (select * from r where external_doc_no not in (select external_doc_no from pst_dsv))
  select distinct 'header' as kind, external_doc_no as doc, order_date::varchar as order_date, null as item, null::double as amount, null::double as vat_amount, 'DATAMART_SI' as source_code from f
  union all select 'line', external_doc_no, null, asin, round(amount, 2)::double, 1.25, null from (select distinct external_doc_no, asin, no, amount, quantity, country from f)""")
def add_in(t):
    s = t["settlements"].where("transaction_type = 'SALE'").selectExpr(
        "po_id as external_doc_no", "settlement_date as order_date", "sku as asin", "left(sku, 4) as no", "coalesce(nullif(original_item_price, 0), product_price) as amount",
        "ship_qty as quantity", "cast(1.25 as decimal(18,4)) as discount", "'REG-USA' as country", "'MAIN' as belong_to_company")
    header, line = si.add_in(s, t["pst_dsv"], {"source_code": "DATAMART_SI"}, vat_from="discount")
    header = header.selectExpr("'header' as kind", "external_doc_no as doc", "cast(order_date as string) as order_date", "cast(null as string) as item",
                               "cast(null as decimal(18,2)) as amount", "cast(null as decimal(18,4)) as vat_amount", "source_code")
    return header.unionByName(line.selectExpr("'line' as kind", "document_no as doc", "cast(null as string) as order_date", "original_asin_sku as item", "amount", "vat_amount", "cast(null as string) as source_code"))


# ---- the daily job ---------------------------------------------------------------------------
@query("daily_documents", f"""with shown as materialized ({' union all '.join(f'select * from ({ORACLE[name]})' for name in CHANNELS)}),
  l as (select distinct {', '.join(LINE_COLS)} from shown),
  h as (select distinct document_no, {', '.join(HEAD_COLS)} from shown where internal_sales_channel is not null)
  select l.*, {', '.join(f'h.{c}' for c in HEAD_COLS)} from l left join h on l.document_no = h.document_no""")
def daily_documents(t):
    """All channels of a day, one after the other from one snapshot log, into the daily tables."""
    log = new_log(t)
    header, line = si.daily_documents([run(t, log, SHOWN) for run in CHANNELS.values()], SHOWN)
    return si.document_lines(header, line).select(*SHOWN)
