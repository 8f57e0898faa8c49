"""Reconciliation and monitoring reports on the driver tables."""

from datetime import date

from pyspark.sql import functions as F

from ledgerloom.operators.incremental import unbooked
from ledgerloom.plans import recon
from ledgerloom.plans import sales_invoice as si
from ledgerloom.session import cut_lineage
from workload import channels as ch
from workload.registry import query

AS_OF, RUN_TS, SINCE, CORE = ch.AS_OF, ch.RUN_TS, ch.SINCE, ch.CORE


def recon_sql(cand: str, doc: str, name: str, key: str, pst: str | None, day: str = "") -> str:
    """``day`` names the output for the document's date, where the report shows one row per document and date."""
    guard = f" and source_doc not in (select original_external_doc_no from {pst})" if pst else ""
    return f"""{cand}
    , src as (select {doc} as source_doc, {f"order_date as {day}," if day else ""} sum(amount::decimal(18,2)) as source_amount from cand where order_date >= date '2001-07-01' and order_date < date '2001-08-01' group by 1{", 2" if day else ""})
    , bk as (select h.{key} as booked_doc, sum(l.amount) as booked_amount from dly_{name}_h h left join dly_{name}_l l on h.external_doc_no = l.document_no group by 1)
    select source_doc, {f"{day}::varchar as {day}," if day else ""} source_amount::double as source_amount, booked_doc, booked_amount::double as booked_amount from src full join bk on source_doc = booked_doc
    where source_amount <> booked_amount or (booked_doc is null{guard})"""


def recon_query(t, cand, name, channel, pst, doc="external_doc_no", key="external_doc_no", extra=()):
    source = recon.source_totals(cand, doc, "amount", "order_date", AS_OF, extra)
    booked = recon.booked_totals(t[f"dly_{name}_h"], t[f"dly_{name}_l"], key, "internal_sales_channel", channel)
    return recon.recon_documents(source, booked, t[pst] if pst else None)


@query("recon_wm_dsv", recon_sql(ch.DROPSHIP_CAND, "external_doc_no", "dsv", "external_doc_no", None))
def recon_wm_dsv(t):
    raw = t.pick(order_lines="order_lines", catalogue="catalogue", promo_log="promo_log", promo_sheet="promo_sheet", companies="companies", posted_header="pst_dsv")
    return recon_query(t, si.dropship_candidates(raw, AS_OF, RUN_TS, SINCE, "MAIN", "CO1", SINCE, numbered=False), "dsv", ["WM DSV"], None)


@query("recon_wm_wfs", recon_sql(ch.SETTLEMENT_CAND, "external_doc_no", "wfs", "external_doc_no", "pst_wfs"))
def recon_wm_wfs(t):
    cand = si.settlement_candidates(t.pick(settlements="settlements", companies="companies"), AS_OF, RUN_TS, SINCE, "MAIN", "CO1", numbered=False)
    return recon_query(t, cand, "wfs", ["WM WFS"], "pst_wfs")


@query("recon_wf", recon_sql(ch.BASECOST_CAND, "original_external_doc_no", "wf", "original_external_doc_no", "pst_wf"))
def recon_wf(t):
    raw = t.pick(invoices="invoices", orders_export="orders_export", base_cost="base_cost", items="items", companies="companies", dropship_export="dropship_export")
    cand = si.basecost_candidates(raw, AS_OF, RUN_TS, SINCE, CORE, "CO2", "CO1", {"ACCT_US": "REG-USA", "ACCT_CA": "REG-CAN"},
                                  {"ACCT_US": "157-WFC-US", "ACCT_CA": "157-WF-CAN"}, numbered=False)
    return recon_query(t, cand, "wf", ["WF", "WF CG"], "pst_wf", "original_external_doc_no", "original_external_doc_no")


@query("recon_avc_ds", recon_sql(ch.DF_CAND, "original_external_doc_no", "ds", "original_external_doc_no", "pst_ds"))
def recon_avc_ds(t):
    raw = t.pick(df_items="df_items", df_summary="df_summary", profiles="profiles", items="items", companies="companies")
    cand = si.direct_fulfil_candidates(raw, AS_OF, RUN_TS, SINCE, CORE, "CO1", numbered=False)
    return recon_query(t, cand, "ds", ["AVC DS"], "pst_ds", "original_external_doc_no", "original_external_doc_no")


GOOD_VENDOR = """good as (select invoice_number from vendor_summary where invoice_number not in (select v.invoice_number from vendor_summary v join
    (select invoice_number, sum(invoice_price) as d from vendor_invoice_detail group by 1) x on v.invoice_number = x.invoice_number where abs(v.invoice_amount - d) > 2
    union select invoice_number from vendor_deleted))"""


@query("recon_avc_di_wh", recon_sql(ch.VENDOR_CAND.replace("with base as", f"with {GOOD_VENDOR}, base as").replace(
    "where b.invoice_number not like", "where a.invoice_number in (select invoice_number from good) and b.invoice_number not like"),
    "original_external_doc_no", "avc", "original_external_doc_no", "pst_avc", day="invoice_date"))
def recon_avc_di_wh(t):
    raw = t.pick(vendor_invoice_detail="vendor_invoice_detail", purchase_orders="purchase_orders", profiles="profiles",
                 second_skus="second_skus", items="items", companies="companies")
    detail = t["vendor_invoice_detail"].select("invoice_number", F.col("invoice_price").alias("total_amount"))
    good = cut_lineage(recon.consistent_invoices(t["vendor_summary"], detail, t["vendor_deleted"]).select("invoice_number"), "consistent")
    raw["vendor_invoices"] = t["vendor_invoices"].join(good, "invoice_number", "left_semi")
    cand = si.vendor_candidates(raw, AS_OF, RUN_TS, SINCE, CORE, "CO1", ["VENA", "VENB"], ["VENG"], numbered=False)
    out = recon_query(t, cand, "avc", ["AVC DI", "AVC WH", "AVC GPE"], "pst_avc", "original_external_doc_no", "original_external_doc_no", ["order_date"])
    return out.withColumnRenamed("order_date", "invoice_date").orderBy(F.asc_nulls_last("invoice_date"))


@query("recon_asc", f"""{ch.PAY_CAND}
  , src as (select strftime(order_date, '%Y-%m') as source_month, po_number as source_doc, sum(amount) as source_amount from cand group by 1, 2)
  , bk as (select h.original_external_doc_no as booked_doc, strftime(order_date, '%Y-%m') as booked_month, sum(l.amount) as booked_amount from dly_asc_h h
      left join dly_asc_l l on h.external_doc_no = l.document_no group by 1, 2)
  select source_month, source_doc, source_amount::double as source_amount, booked_doc, booked_month, booked_amount::double as booked_amount from src full join bk on source_doc = booked_doc
    and source_month = booked_month where booked_doc is null or (source_amount <> booked_amount and source_doc not in (select original_external_doc_no from pst_asc))""")
def recon_asc(t):
    raw = t.pick(payments="payments", seller_orders_a="seller_orders_a", seller_orders_b="seller_orders_b", profiles="profiles", items="items", companies="companies")
    cand = si.payment_candidates(raw, AS_OF, RUN_TS, SINCE, CORE, numbered=False)
    booked = recon.booked_totals(t["dly_asc_h"], t["dly_asc_l"], "original_external_doc_no", "sales_channel", ["CHAN-ASC"], month=True)
    return recon.recon_by_month(cand, booked, t["pst_asc"], "original_external_doc_no", "order_date", "amount")


PO_SQL = """with po as (select o.po_number, sum(wholesale_price * quantity) as po_amount, string_agg(item_number, ' | ' order by item_number) as sku_list, sum(base_cost * quantity) as testing
    from orders_export o left join base_cost b on o.item_number = b.supplier_part_number and o.account_name = b.account_name and o.po_date_time between effective_from and effective_to group by 1),
  si as (select po_number as document_no, sum(amount) as si_amount, sum(unit_price * quantity) as net from dly_wf_l group by 1),
  inv as (select invoice_num, invoice_date, sum(amount) as invoice_amount from inv_as_po group by 1, 2),
  res as (select invoice_num, invoice_date, sku_list, invoice_amount, coalesce(po_amount, 0) as po_amount, si_amount, testing, net from inv left join po on invoice_num = po.po_number
    left join si on invoice_num = si.document_no where abs(invoice_amount - coalesce(po_amount, 0)) >= 0.01 and invoice_date::date >= date '1996-08-01')"""
PO_COLS = """invoice_num, strftime(invoice_date, '%Y-%m-%d %H:%M:%S') as invoice_date, sku_list, invoice_amount::double as invoice_amount, po_amount::double as po_amount, si_amount::double as si_amount,
  testing::double as si_amount_testing, net::double as si_net_sales"""


def po_invoice(t):
    tables = t.pick(orders_export="orders_export", base_cost="base_cost", invoices="inv_as_po")
    # in this report documents are keyed by the purchase order
    tables["daily_line"] = t["dly_wf_l"].withColumn("document_no", F.col("po_number"))
    return recon.recon_po_invoice(tables, date(1996, 8, 1))


@query("recon_po_invoice", f"{PO_SQL} select {PO_COLS} from res")
def recon_po_invoice(t):
    return po_invoice(t)


@query("recon_net_sales", f"""{PO_SQL} select {PO_COLS} from res where invoice_amount <> net and invoice_num not in (select document_no from suffixed)
  and invoice_num not in (select external_doc_no from pst_dsv)""")
def recon_net_sales(t):
    return recon.recon_net_sales(po_invoice(t), t["suffixed"], t["pst_dsv"])


@query("source_freshness", """select 'orders' as data_source, 'A' as platform, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') as latest_run_time, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') as latest_report_date from orders
  union all select 'lines', 'A', strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S'), null from lineitem
  union all select 'events', 'B', strftime(max(ts), '%Y-%m-%d %H:%M:%S'), strftime(max(ts), '%Y-%m-%d 00:00:00') from events group by 'events'
  union all select 'none', 'B', strftime(max(ts), '%Y-%m-%d %H:%M:%S'), null from events where event_type = 'nothing' group by 'none'
  union all select 'nothing', 'B', strftime(max(ts), '%Y-%m-%d %H:%M:%S'), null from events where event_type = 'nothing'""")
def source_freshness(t):
    events = t["events"].withColumn("day", F.col("ts").cast("date"))
    none = events.where("event_type = 'nothing'")
    return recon.source_freshness([
        ("orders", "A", t["orders"], "o_orderdate", "o_orderdate"), ("lines", "A", t["lineitem"], "l_shipdate", None),
        ("events", "B", events, "ts", "day"), ("none", "B", none, "ts", None), ("nothing", "B", none, "ts", None)], by_group=("events", "none"))


@query("paid_not_booked", """select purchase_order_id, order_line_id, item_sku from order_lines where purchase_order_id in (select order_id from dropship_export)
  and purchase_order_id not in (select original_external_doc_no from pst_dsv union select external_doc_no from exc_dsv union select original_external_doc_no from dly_dsv_h)""")
def paid_not_booked(t):
    rows = unbooked(t["order_lines"], "purchase_order_id", t["dropship_export"], "order_id", (t["pst_dsv"], "original_external_doc_no"),
                    (t["exc_dsv"], "external_doc_no"), (t["dly_dsv_h"], "original_external_doc_no"))
    return rows.select("purchase_order_id", "order_line_id", "item_sku")


@query("unidentified_location", """with l as (select * from dly_wfs_l where document_no in (select external_doc_no from dly_wfs_h where location = 'Unidentified')),
  f as (select h.original_external_doc_no as inv, l.no, l.location_code, h.internal_sales_channel as chan, x.warehouse, x.ims_id from l join dly_wfs_h h on l.document_no = h.external_doc_no
    left join (select distinct order_id, po_id from settlements) s on h.original_external_doc_no = s.order_id left join txn_wfs x on coalesce(s.po_id, h.original_external_doc_no) = x.transaction_id)
  select inv as invoice_number, string_agg(distinct no, ',' order by no) as sku, string_agg(distinct location_code, ',') as location, 'WM MKP' as sales_channel,
    string_agg(distinct warehouse, ',' order by warehouse) as warehouse, string_agg(distinct ims_id::varchar, '|' order by ims_id::varchar) as ims_id from f group by 1""")
def unidentified_location(t):
    return recon.unidentified_location(t.pick(daily_header="dly_wfs_h", daily_line="dly_wfs_l", settlements="settlements", transactions="txn_wfs"))


NOTE_SQL = """note_rows as (select i.*, n.issue_date, n.issue_code, n.created_date, d.erp_warehouse from notes n join note_items i on n.note_id = i.note_id
    join warehouses w on n.warehouse_from_id = w.warehouse_id join warehouse_dim d on d.dim_short = w.short_name where status = 'COMPLETED' and issue_type = 'SALES_ORDERS'),
  sold as (select h.order_date, h.external_doc_no, h.location, h.original_external_doc_no, h.country, l.no as sku, sum(l.quantity) as quantity, sum(l.amount) as gross, sum(l.quantity * l.unit_price) as net
    from dly_wf_h h left join dly_wf_l l on h.external_doc_no = l.document_no where h.order_date >= date '2001-06-01' and h.order_date < date '2001-07-01' group by all)"""
NOTE_AGG = """sum(actual_exported_qty) as ob_qty, max(issue_date) as ob_date, string_agg(distinct issue_date::varchar, ',' order by issue_date::varchar) as outbound_date, count(distinct issue_date) as cnt_date,
    string_agg(distinct issue_code, ',' order by issue_code) as issue_code, count(distinct issue_code) as cnt_ob, string_agg(distinct erp_warehouse, ',' order by erp_warehouse) as erp_warehouse,
    count(distinct erp_warehouse) as cnt_wh"""
OUT_TABLES = dict(notes="notes", note_items="note_items", warehouses="warehouses", warehouse_dim="warehouse_dim", posted_header="dly_wf_h", posted_line="dly_wf_l",
                  daily_header="dly_wf_h", daily_line="dly_wf_l")
OUT_COLS = ["sale_order_number", "ob_sku", "ob_qty", "issue_code", "erp_warehouse", "outbound_date", "cnt_date", "cnt_ob", "cnt_wh", "external_doc_no", "location", "sku", "quantity",
            "gross_sales", "net_sales"]
OUT_SELECT = """sale_order_number, ob_sku, ob_qty, issue_code, erp_warehouse, outbound_date, cnt_date, cnt_ob, cnt_wh, external_doc_no, location, s.sku, quantity, gross::double as gross_sales,
    net::double as net_sales"""


@query("outbound_vs_invoice_sku", f"""with {NOTE_SQL}, n as (select sale_order_number, sku as ob_sku, {NOTE_AGG} from note_rows where issue_date between date '2001-01-01' and date '2001-06-15' group by 1, 2)
  select {OUT_SELECT} from n right join sold s on n.sale_order_number || n.ob_sku = s.original_external_doc_no || coalesce(s.sku, '')""")
def outbound_vs_invoice_sku(t):
    return recon.outbound_vs_invoice_sku(t.pick(**OUT_TABLES), "2001-06", ["WF"], date(2001, 1, 1), date(2001, 6, 15)).select(*OUT_COLS)


@query("outbound_located_not_listed", f"""with {NOTE_SQL} select external_doc_no, order_date::varchar as order_date from dly_wf_h where location <> 'Unidentified' and original_external_doc_no not in
  (select original_external_doc_no from sold)""")
def outbound_located_not_listed(t):
    listed = recon.outbound_vs_invoice_sku(t.pick(**OUT_TABLES), "2001-06", ["WF"], date(2001, 1, 1), date(2001, 6, 15))
    return recon.located_not_listed(t["dly_wf_h"], "WF", listed).select("external_doc_no", "order_date")


@query("outbound_vs_invoice_doc", f"""with {NOTE_SQL}, n as (select sale_order_number, string_agg(sku, ',' order by sku) as ob_sku, {NOTE_AGG} from
    (select note_rows.* replace (issue_date + interval 3 day as issue_date) from note_rows) where created_date between date '2001-01-01' and date '2001-06-20' group by 1)
  select {OUT_SELECT.replace('outbound_date', "outbound_date")} from n right join sold s on n.sale_order_number = s.original_external_doc_no where s.order_date < n.ob_date""".replace(
      "(issue_date + interval 3 day as issue_date)", "((issue_date + interval 3 day)::date as issue_date)"))
def outbound_vs_invoice_doc(t):
    tables = t.pick(**OUT_TABLES)
    tables["notes"] = tables["notes"].withColumn("issue_date", F.date_add("issue_date", 3))   # goods leave three days later
    return recon.outbound_vs_invoice_doc(tables, "2001-06", ["WF"], date(2001, 1, 1), date(2001, 6, 20)).select(*OUT_COLS)


@query("recon_ads", """with raw as (select accountinfo_name as accounts, sum(d.amount + d.tax) as amount_raw from ads_invoice_detail d join ads_invoices i on d.summary_id = i.invoice_id
    left join ads_profiles p on i.profile_id = p.profileid where i.invoicedate >= date '2001-05-25' and i.invoicedate < date '2001-07-26' group by 1),
  erp as (select split_part(descriptions, ' ', 3) as se_type, accounts, region_code, split_part(original_invoice_company, '_', 2) as company, sum(amount) as amount_erp from expense_daily
    where document_date >= date '2001-05-25' and document_date < date '2001-07-26' and amount > 0 and is_processed = 2 and regexp_matches(descriptions, 'Marketing') group by all)
  select erp.accounts, se_type, region_code, company, amount_erp::double as amount_erp, amount_raw::double as amount_raw, (amount_erp - amount_raw)::double as reconcile from erp left join raw
    on erp.accounts = raw.accounts""")
def recon_ads(t):
    return recon.recon_ads(t.pick(ads_invoices="ads_invoices", ads_profiles="ads_profiles", ads_invoice_detail="ads_invoice_detail", expense_daily="expense_daily"), AS_OF)


@query("recon_promo", """with erp as (select strftime(document_date, '%Y-%m') as year_month, 'Promotions' as se_type, region_code, sum(amount) as erp_amount from expense_daily where amount > 0
    and split_part(descriptions, ' ', 3) = 'Promotions' and ((region_code not like '%JPN%' and is_processed = 2 and document_date >= date '2001-06-01' and document_date < date '2001-07-26')
      or (region_code like '%JPN%' and document_date >= date '2001-05-01' and document_date < date '2001-08-01')) group by all),
  raw as (select strftime(invoice_date, '%Y-%m') as ym, country, sum(original_balance) as raw_amount from promo_overview where funding_type = 'Vendor Funded Sales Discount'
    and ((country <> 'JPN' and invoice_date >= date '2001-06-01' and invoice_date < date '2001-07-26') or (country = 'JPN' and invoice_date >= date '2001-05-01' and invoice_date < date '2001-08-01')) group by all)
  select year_month, se_type, region_code, erp_amount::double as erp_amount, country, raw_amount::double as raw_amount, (erp_amount - raw_amount)::double as recon from erp full join raw
    on case split_part(region_code, '-', 2) when 'MXN' then 'MEX' when 'UAE' then 'ARE' else split_part(region_code, '-', 2) end = country and year_month = ym""")
def recon_promo(t):
    return recon.recon_promo(t.pick(expense_daily="expense_daily", promo_overview="promo_overview"), AS_OF)


@query("si_report", """select h.external_doc_no, h.order_date::varchar as order_date, h.location, l.po_number, l.no, l.quantity, l.unit_price::double as unit_price_aft_promo, l.amount::double as gross_sales,
  (l.quantity * l.unit_price)::double as net_sales, l.discount::double as discount from dly_wf_h h left join dly_wf_l l on h.external_doc_no = l.document_no
  where h.order_date >= date '2001-06-01' and h.order_date < date '2001-07-01' and is_processed = 0""")
def si_report(t):
    cols = ["external_doc_no", "order_date", "location", "po_number", "no", "quantity", "unit_price_aft_promo", "gross_sales", "net_sales", "discount"]
    return recon.si_report(t["dly_wf_h"], t["dly_wf_l"], "2001-06").select(*cols)
