"""Projections, derivations, row updates and scalar functions on the driver tables."""

from datetime import date, datetime

from pyspark.sql import functions as F

from ledgerloom.functions import scalars as fn
from ledgerloom.operators import derive as d
from ledgerloom.operators.incremental import latest_per_key
from ledgerloom.operators.joins import interval_join, member_flag
from ledgerloom.plans import accrual, config as c, recon
from ledgerloom.plans.config import GlConfig
from ledgerloom.plans.expense import clean_currency, funding_class
from ledgerloom.plans.sales_invoice import reclass_extra, shipment_locations
from ledgerloom.schemas import SNAPSHOT, conform
from workload.registry import query

AS_OF = date(2001, 7, 20)
RUN_TS = datetime(2001, 7, 20, 5)
CORE = ("MAIN", "SIDE", "JOINT")
MONEY = "decimal(18,2)"
PRICE_C = "cast(round(l_extendedprice * 100) as bigint)"


def half_up(num: str, den: str, scale: int = 2) -> str:
    """Exact division of integers, rounded half away from zero to ``scale`` digits of the result."""
    return f"(sign({num}) * ((2 * abs({num}) + abs({den})) // (2 * abs({den}))))::double / {10 ** scale}"


def owned_lines(t):
    """Lines with the owner of their item."""
    items = t["items"].select("item_id", "belong_to_company")
    code = F.substring(F.lpad(F.col("l_partkey").cast("string"), 8, "0"), 5, 4)
    lines = t["lineitem"].withColumn("item_id", code).join(items, "item_id", "left")
    return lines.withColumn("doc", F.col("l_orderkey").cast("string"))


OWNED = """owned as (select l.*, cast(l_orderkey as varchar) as doc, i.belong_to_company, i.item_id from lineitem l
  left join items i on substr(lpad(cast(l_partkey as varchar), 8, '0'), 5, 4) = i.item_id)"""


@query("code_map", """select s_suppkey, case r_name when 'AFRICA' then 'REG-AFR' when 'AMERICA' then 'REG-AME' else 'Unidentified' end as region_code
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")
def code_map(t):
    rows = t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey")).join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    mapped = d.code_map("r_name", {"AFRICA": "REG-AFR", "AMERICA": "REG-AME"}, F.lit(c.UNIDENTIFIED))
    return rows.select("s_suppkey", mapped.alias("region_code"))


@query("posting_date_rule", """select o_orderkey, case when o_orderdate < date '2001-07-01' then '2001-07-01' when o_orderdate < date '2001-08-01'
    then cast(cast(o_orderdate as date) as varchar) end as posting_date,
  case when month(o_orderdate) < 7 then '2001-07-01' when month(o_orderdate) = 7 then cast(cast(o_orderdate as date) as varchar) end as by_month_number
  from orders""")
def posting_date_rule(t):
    return t["orders"].select("o_orderkey", fn.posting_date("o_orderdate", AS_OF).alias("posting_date"),
                              fn.posting_date("o_orderdate", AS_OF, legacy_month_number=True).alias("by_month_number"))


@query("period_date", """select o_orderkey, cast(cast(strftime(o_orderdate, '%Y-%m') || '-25' as date) as varchar) as posting_date,
  cast(cast(strftime(o_orderdate - interval 1 month, '%Y-%m') || '-26' as date) as varchar) as window_start, strftime(o_orderdate, '%b%Y') as label from orders""")
def period_date(t):
    month = fn.date_text("o_orderdate", "YYYY-MM")
    before = fn.date_text(F.add_months("o_orderdate", -1), "YYYY-MM")
    return t["orders"].select("o_orderkey", F.to_date(fn.concat_skip_null(month, F.lit("-25"))).alias("posting_date"),
                              F.to_date(fn.concat_skip_null(before, F.lit("-26"))).alias("window_start"),
                              fn.date_text("o_orderdate", "MonYYYY").alias("label"))


@query("doc_number", f"""with {OWNED} select doc || '_' || strftime(l_shipdate, '%Y%m%d') as dated, case when belong_to_company in ('MAIN', 'SIDE', 'JOINT') then doc
    when belong_to_company is not null then doc || '-OBH-' || belong_to_company end as routed,
  case when belong_to_company in ('MAIN', 'SIDE', 'JOINT') then doc else concat(doc, '-OBH-', belong_to_company) end as kept from owned""")
def doc_number(t):
    return owned_lines(t).select(
        fn.dated_doc("doc", "l_shipdate").alias("dated"), d.doc_number("doc", "belong_to_company", CORE).alias("routed"),
        d.doc_number("doc", "belong_to_company", CORE, keep_unknown=True).alias("kept"))


@query("posting_description", """select o_orderkey, concat(split_part('REG-USA', '-', 2), '-', split_part(case when o_orderstatus = 'P' then null else 'CHAN-AVC' end, '-', 2),
  ': Booking revenue, Inv#', o_orderkey, '_', strftime(o_orderdate, '%y%m%d')) as posting_description from orders""")
def posting_description(t):
    rows = t["orders"].withColumns({"country": F.lit("REG-USA"), "channel": F.when(F.col("o_orderstatus") != "P", F.lit("CHAN-AVC"))})
    return rows.select("o_orderkey", fn.posting_description("country", "channel", "o_orderkey", "o_orderdate").alias("posting_description"))


@query("parent_sku", """select product_gtin, item_id, left(case when item_id = '17' then 'R61J-SPECIAL' else supplier_stock_id end, 4) as parent from catalogue""")
def parent_sku(t):
    rows = t["catalogue"].withColumn("sku", F.when(F.col("item_id") == "17", F.lit("17")).otherwise(F.col("supplier_stock_id")))
    return rows.select("product_gtin", "item_id", d.parent_sku("sku", {"17": "R61J-SPECIAL"}).alias("parent"))


@query("line_amounts", f"""select l_orderkey, l_linenumber, case when l_returnflag = 'A' then null else {half_up(PRICE_C, 'l_quantity::bigint')} end as unit_price,
  case when l_linestatus = 'O' then l_extendedprice + 1 else l_extendedprice end as amount from lineitem""")
def line_amounts(t):
    price = F.col("l_extendedprice").cast(MONEY)
    original = F.when(F.col("l_linestatus") == "O", F.lit(0)).otherwise(price)
    quantity = F.when(F.col("l_returnflag") == "A", F.lit(0)).otherwise(F.col("l_quantity")).cast("int")
    best = F.coalesce(F.when(original != 0, original), price + 1)
    return t["lineitem"].select("l_orderkey", "l_linenumber", fn.unit_price(price, quantity).alias("unit_price"), F.round(best, 2).alias("amount"))


@query("promo_price", """select p_partkey, (case when p_size between 40 and 45 then p_retailprice::decimal(18,2) + case when p_type = 'PROMO' then 0 else 5.25 end
    else coalesce(case when p_size > 45 then p_retailprice::decimal(18,2) - 100 end, p_retailprice::decimal(18,2)) end)::double as price from part""")
def promo_price(t):
    cost = F.col("p_retailprice").cast(MONEY)
    rows = t["part"].withColumns({
        "cost": cost, "funding": F.when(F.col("p_type") != "PROMO", F.lit("5.25").cast(MONEY)),
        "promo_cost": F.when(F.col("p_size") > 45, cost - 100)})
    return rows.select("p_partkey", d.promo_price("p_partkey", "cost", F.col("p_size").between(40, 45), "funding", "promo_cost").alias("price"))


@query("owner_route", f"""with {OWNED} select case when belong_to_company in ('MAIN', 'SIDE', 'JOINT') then 'own' else 'on behalf' end as route,
  belong_to_company, count(*) as n from owned where belong_to_company is not null group by 1, 2""")
def owner_route(t):
    own, obh = d.owner_route(owned_lines(t), "belong_to_company", CORE)
    both = own.withColumn("route", F.lit("own")).unionByName(obh.withColumn("route", F.lit("on behalf")))
    return both.groupBy("route", "belong_to_company").agg(F.count(F.lit(1)).alias("n"))


@query("obh_line_expand", f"""with {OWNED}, obh as (select * from owned where belong_to_company not in ('MAIN', 'SIDE', 'JOINT'))
  select doc, 'G/L Account' as type, '33890101' as no, cast(null as varchar) as uom, l_extendedprice as unit_price, 1.0::double as quantity, l_extendedprice as amount from obh
  union all select doc, 'ITEM', item_id, 'pcs', 0, l_quantity, 0 from obh where belong_to_company <> 'HMD'""")
def obh_line_expand(t):
    _, obh = d.owner_route(owned_lines(t), "belong_to_company", CORE)
    rows = obh.select("doc", "belong_to_company", F.col("item_id").alias("no"), F.lit("pcs").alias("uom"), F.lit("ITEM").alias("type"),
                      F.col("l_extendedprice").cast(MONEY).alias("unit_price"), F.lit(None).cast(MONEY).alias("discount"),
                      F.col("l_quantity").cast("decimal(18,0)").alias("quantity"), F.col("l_extendedprice").cast(MONEY).alias("amount"))
    out = d.obh_expand(rows, "belong_to_company", F.col("belong_to_company") != "HMD", c.OBH_ACCOUNT)
    return out.select("doc", "type", "no", "uom", "unit_price", "quantity", "amount")


EXTRA_SET = "(select invoice_no from extra_invoices where upper(type_of_invoice) = 'EXTRA INVOICE' or invoice_vendor = 0)"


@query("extra_invoice_reclass", f"""select 'header' as kind, invoice_number as doc, null as no, null as uom, case when invoice_number in {EXTRA_SET} then null else 'WH' end as location,
    case when invoice_number in {EXTRA_SET} then 2 else 0 end as flag from vendor_invoice_detail group by all
  union all select 'line', invoice_number, case when invoice_number in {EXTRA_SET} then '71190101' else asin end, case when invoice_number in {EXTRA_SET} then null else 'pcs' end, 'WH', 0
  from vendor_invoice_detail""")
def extra_invoice_reclass(t):
    staging = conform(t["vendor_invoice_detail"].select(
        F.col("invoice_number").alias("external_doc_no"), F.col("asin").alias("no"), F.lit("pcs").alias("uom"), F.lit("ITEM").alias("type"),
        F.lit("WH").alias("wh_location")), SNAPSHOT)
    header, line = reclass_extra(staging, t["extra_invoices"])
    none = F.lit(None).cast("string")
    header = header.select(F.lit("header").alias("kind"), F.col("external_doc_no").alias("doc"), none.alias("no"), none.alias("uom"),
                           F.col("wh_location").alias("location"), F.col("is_processed").alias("flag")).distinct()
    return header.unionByName(line.select(F.lit("line").alias("kind"), F.col("external_doc_no").alias("doc"), "no", "uom",
                                          F.col("wh_location").alias("location"), F.lit(0).alias("flag")))


@query("header_line_split", """select distinct 'header' as kind, l_orderkey as doc, l_suppkey as supp, null::double as amount from lineitem
  union all select distinct 'line', l_orderkey, l_suppkey, l_extendedprice from lineitem""")
def header_line_split(t):
    doc, supp = F.col("l_orderkey"), F.col("l_suppkey")
    header, line = d.split_header_line(
        t["lineitem"], {"doc": doc, "supp": supp}, {"doc": doc, "supp": supp, "amount": F.round(F.col("l_extendedprice").cast(MONEY), 2)})
    header = header.select(F.lit("header").alias("kind"), "doc", "supp", F.lit(None).cast(MONEY).alias("amount"))
    return header.unionByName(line.withColumn("kind", F.lit("line")))


@query("update_where", """select o_orderkey, case when o_orderstatus = 'P' then 'closed' else o_orderpriority end as priority,
  case when o_orderstatus = 'P' then null else 'pcs' end as uom from orders""")
def update_where(t):
    rows = t["orders"].select("o_orderkey", F.col("o_orderpriority").alias("priority"), "o_orderstatus", F.lit("pcs").alias("uom"))
    partial = F.col("o_orderstatus") == "P"
    out = d.update_where(rows, [("priority", partial, F.lit("closed")), ("uom", F.col("priority") == "closed", F.lit(None))])
    return out.drop("o_orderstatus")


EVIDENCE = """(select transaction_id, min(warehouse) as w from txn_ds group by 1 having count(distinct warehouse) = 1)"""


@query("update_from", f"""select invoicenumber, coalesce(case when status = 'APPROVED' then w end, status) as location from df_summary left join {EVIDENCE} e
  on invoicenumber = transaction_id""")
def update_from(t):
    from ledgerloom.operators.aggs import unique_or_unknown

    rows = t["df_summary"].select("invoicenumber", F.col("status").alias("location"))
    places = unique_or_unknown(t["txn_ds"], "transaction_id", "warehouse")
    return d.update_from(rows, places, "invoicenumber", "transaction_id", "location", "warehouse", F.col("location") == "APPROVED")


@query("cent_adjust", """with line as (select concat('INV', cast(l_orderkey as varchar)) as document_no, l_orderkey, l_partkey, l_linenumber, l_quantity, p_retailprice,
    count(*) over (partition by l_orderkey) as n, substr(lpad(cast(l_partkey as varchar), 8, '0'), 5, 4) as no from lineitem join part on l_partkey = p_partkey)
  select document_no, no, l_linenumber, case when n = 1 then p_retailprice + 0.01 else p_retailprice end as unit_price from line""")
def cent_adjust(t):
    rows = t["lineitem"].join(t["part"], F.col("l_partkey") == F.col("p_partkey")).withColumns({
        "document_no": F.concat(F.lit("INV"), F.col("l_orderkey").cast("string")), "po_number": F.col("l_orderkey").cast("string"),
        "no": F.substring(F.lpad(F.col("l_partkey").cast("string"), 8, "0"), 5, 4), "quantity": F.col("l_quantity").cast("decimal(18,0)"),
        "unit_price": F.col("p_retailprice").cast(MONEY)})
    line = rows.select("document_no", "po_number", "no", "l_linenumber", "quantity", "unit_price")
    single = line.groupBy("document_no", "po_number").agg(
        F.count(F.lit(1)).alias("n"), F.min("no").alias("sku_list"),
        (F.sum(F.col("unit_price") * F.col("quantity")) + F.sum("quantity") * F.lit("0.01").cast("decimal(4,2)")).alias("amount"))
    invoices = single.select(F.col("document_no").alias("invoice_num"), "amount")
    listed = single.where("n = 1").select(F.col("po_number").alias("invoice_num"), "sku_list")
    return recon.cent_adjust(line, invoices, listed).select("document_no", "no", "l_linenumber", "unit_price")


@query("shipment_location", """with last_ship as (select * from (select *, row_number() over (partition by shipment_id order by run_date desc) as rn from shipments) where rn = 1),
  docs as (select distinct unnest(string_split(purchase_order, ',')) || '_' || reference_id as doc, ship_from_city from last_ship where purchase_order <> '')
  select doc, case max(case ship_from_city when 'Fontana' then 4 when 'Cranbury' then 3 when 'Brea' then 2 else 1 end) when 4 then '156-3PL-FT' when 3 then '156-3PL-CB'
    when 2 then '156-USA-CA' else '156-3PL-FR' end as location from docs where ship_from_city in ('Fontana', 'Cranbury', 'Brea', 'Anaheim', 'FLORENCE') group by 1""")
def shipment_location(t):
    return shipment_locations(t["shipments"]).select(F.col("_doc").alias("doc"), F.col("_ship").alias("location"))


GL = GlConfig(company_id="company-1", journal_id="journal-1", obh_journal_id="journal-2", original_company_id="CO1", batch_name="DATA")


@query("gl_line_format", """select o_orderkey, 'G/L Account' as account_type, '64160102' as account_no, '' as due_date, cast(o_totalprice as double) as amount, 'company-1' as company_id,
  'journal-1' as journal_id, cast(null as varchar) as error_type, 35 as n_columns from orders""")
def gl_line_format(t):
    rows = t["orders"].withColumn("total", F.col("o_totalprice").cast(MONEY))
    out = accrual.gl_line(rows, GL, {"account_type": F.lit("G/L Account"), "account_no": F.lit(c.PROMOTION_ACCOUNT), "amount": F.col("total"),
                                     "external_document_no": F.col("o_orderkey").cast("string")})
    return out.select(F.col("external_document_no").cast("long").alias("o_orderkey"), "account_type", "account_no", "due_date", "amount", "company_id",
                      "journal_id", "error_type", F.lit(len(out.columns)).alias("n_columns"))


TITLES = """titles as (select p_partkey, case p_type when 'STANDARD' then 'Straight Payment' when 'PROMO' then 'vendor funded' when 'LARGE' then 'Price protection'
    when 'MEDIUM' then 'guaranteed margin' when 'ECONOMY' then 'damage' else p_type end as funding,
  case when p_size < 10 then 'Merchandising: ' || p_name when p_size < 20 then 'Born to Run' when p_size < 30 then 'Vine ' || p_name
    when p_size < 40 then 'Vine straight-payment' else p_name end as title, case when p_size > 45 then 'AVS - SVS' end as tx from part)"""


@query("funding_class", f"""with {TITLES} select p_partkey, case funding when 'Straight Payment' then case when title like 'Merch%' then 'Base merchandising fee' when title = 'Born to Run' then 'Born to run'
      when title = 'Vine straight-payment' then 'VINE_old' when title like 'Vine%' then 'VINE_new' when tx is not null then 'AVS_SVS' else 'Other deduction' end
    when 'vendor funded' then 'Vendor Funded Sales Discount' when 'Price protection' then 'Price Protection' when 'guaranteed margin' then 'Guaranteed Minimum Margin'
    when 'damage' then 'Damage Allowance' end as sub_type from titles""")
def funding_class_query(t):
    rows = t["part"].selectExpr("p_partkey", """case p_type when 'STANDARD' then 'Straight Payment' when 'PROMO' then 'vendor funded' when 'LARGE' then 'Price protection'
      when 'MEDIUM' then 'guaranteed margin' when 'ECONOMY' then 'damage' else p_type end as funding""",
      """case when p_size < 10 then concat('Merchandising: ', p_name) when p_size < 20 then 'Born to Run' when p_size < 30 then concat('Vine ', p_name)
      when p_size < 40 then 'Vine straight-payment' else p_name end as title""", "case when p_size > 45 then 'AVS - SVS' end as tx")
    return rows.select("p_partkey", funding_class("funding", "title", "tx").alias("sub_type"))


@query("currency_clean", """select o_orderkey, case when o_orderstatus = 'O' then 'USD' when o_orderstatus = 'P' and o_orderpriority = '1-URGENT' then 'USD'
  when o_orderstatus = 'P' then null else 'CAD' end as currency, case when o_orderstatus = 'F' then 'CAD' end as foreign_only from orders""")
def currency_clean(t):
    rows = t["orders"].selectExpr("o_orderkey", "case o_orderstatus when 'O' then 'USA' when 'F' then 'CAD' end as ccy",
                                  "case when o_orderpriority = '1-URGENT' then 'USA' else 'CAN' end as country")
    cleaned = rows.withColumn("currency", clean_currency("ccy", "country"))
    return cleaned.select("o_orderkey", "currency", F.when(F.col("currency") != "USD", F.col("currency")).alias("foreign_only"))


def rated_lines(t):
    rows = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "concat(l_orderkey, case when l_returnflag = 'R' then '_Return' else '' end) as source_document", "l_linenumber",
        "case o_orderpriority when '1-URGENT' then 'AVC DS' when '2-HIGH' then 'AVC WH' when '3-MEDIUM' then 'AVC DI' when '4-NOT SPECIFIED' then 'WF' else 'AVC GPE' end as internal_sales_channel",
        "case o_orderstatus when 'O' then 'REG-DEU' when 'P' then 'REG-JPN' else 'REG-MXN' end as country", "cast(o_orderdate as date) as document_date", "l_partkey", "l_orderkey",
        "cast(case when l_linenumber = 3 then 0 else l_extendedprice end as decimal(18,2)) as amount", "l_returnflag")
    rules = accrual.estimate_rules(F.col("l_partkey") < 500, F.col("l_returnflag") == "R")
    return d.rate_columns(rows, rules)


RATED = """rated as (select *, case when ch in ('AVC DS', 'AVC WH') then 0.09 else 0 end as coop_mkt, case when ch = 'AVC WH' and l_returnflag <> 'R' then 0.122 else 0 end as new_freight,
    case when ch = 'AVC DI' and land in ('REG-DEU') then 0.02 else 0 end as damage, case when ch = 'AVC DI' and land = 'REG-JPN' then 0.08 else 0 end as jpn_service,
    case when ch = 'AVC DI' and land = 'REG-DEU' then 0.03 else 0 end as import_service, case when ch = 'AVC DI' and land in ('REG-DEU', 'REG-MXN') then 0.02 else 0 end as import_coop,
    case when ch = 'WF' then 0.04 else 0 end as dropship_damage, case when ch in ('AVC DS', 'AVC WH') and l_returnflag <> 'R' then 0.0375 else 0 end as stock_damage,
    case when ch in ('AVC DS', 'AVC DI', 'AVC WH') and l_partkey < 500 then 0.013 else 0 end as furniture,
    case when ch = 'AVC WH' and l_returnflag <> 'R' then case when day <= date '2023-03-31' then 0.117 else 0.122 end else 0 end as freight
  from (select *, case o_orderpriority when '1-URGENT' then 'AVC DS' when '2-HIGH' then 'AVC WH' when '3-MEDIUM' then 'AVC DI' when '4-NOT SPECIFIED' then 'WF' else 'AVC GPE' end as ch,
    case o_orderstatus when 'O' then 'REG-DEU' when 'P' then 'REG-JPN' else 'REG-MXN' end as land, cast(o_orderdate as date) as day,
    cast(case when l_linenumber = 3 then 0 else l_extendedprice end as decimal(18,2)) as amount from lineitem join orders on l_orderkey = o_orderkey))"""
RULES = ["coop_mkt", "freight", "damage", "jpn_service", "import_service", "import_coop", "dropship_damage", "stock_damage", "furniture"]


@query("rate_columns", f"""with {RATED} select l_orderkey, l_linenumber, l_partkey, {', '.join(f'{r}::double as {r}_rate, (amount * {r}::decimal(6,4))::double as {r}_amt' for r in RULES)} from rated""")
def rate_columns(t):
    return rated_lines(t).select("l_orderkey", "l_linenumber", "l_partkey", *[f"{r}_{k}" for r in RULES for k in ("rate", "amt")])


# (rule, note, what must not be zero), written out here so that a wrong note in the library shows
NOTES = [("coop_mkt", "COOP_MKT", "amount"), ("import_coop", "Coop DI", "amount"), ("jpn_service", "DI JPN AVS_SVS", "amount"),
         ("import_service", "DI DEU GBR AVS_SVS", "rate"), ("freight", "Freight_Allowance", "amount"), ("damage", "Damage_Allowance", "rate"),
         ("dropship_damage", "Damage_Allowance", "amount"), ("stock_damage", "Damage_Allowance", "amount"), ("furniture", "Furniture_SVS_AVS", "amount")]


@query("unpivot_rates", f"with {RATED} " + " union all ".join(
    f"select l_orderkey, l_linenumber, l_partkey, {r}::double as rate, (amount * {r}::decimal(6,4))::double as accrual_amt, '{note}' as note from rated where "
    + (f"{r} <> 0" if test == "rate" else f"amount * {r}::decimal(6,4) <> 0") for r, note, test in NOTES))
def unpivot_rates(t):
    triples = [(f"{r}_rate", f"{r}_amt", note, f"{r}_{test}") for r, note, test in accrual.ESTIMATE_NOTES]
    return d.unpivot_rates(rated_lines(t), triples, ["l_orderkey", "l_linenumber", "l_partkey"])


@query("sign_flip", "select l_orderkey, l_linenumber, l_partkey, case when l_returnflag = 'R' then - l_extendedprice else l_extendedprice end as amount from lineitem")
def sign_flip(t):
    price = F.col("l_extendedprice").cast(MONEY)
    return t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_returnflag") == "R", -price).otherwise(price).alias("amount"))


@query("where_predicates", """select o_orderkey from orders where o_orderdate between timestamp '1996-01-01' and timestamp '1999-12-31' and o_orderpriority in ('1-URGENT', '2-HIGH', '5-LOW')
  and o_orderpriority not like '%HI_H' and regexp_matches(o_orderpriority, 'U|L') and not regexp_matches(o_orderstatus, '^P$')
  and case when o_orderstatus = 'F' then o_totalprice > 1000 else o_totalprice > 2000 end and o_custkey is not null""")
def where_predicates(t):
    o, day, prio = t["orders"], F.col("o_orderdate"), F.col("o_orderpriority")
    case = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") > 1000).otherwise(F.col("o_totalprice") > 2000)
    return o.where(day.between(F.lit(date(1996, 1, 1)), F.lit(date(1999, 12, 31))) & prio.isin("1-URGENT", "2-HIGH", "5-LOW") & ~prio.like("%HI_H")
                   & fn.matches("o_orderpriority", "U|L") & fn.not_matches("o_orderstatus", "^P$") & case & F.col("o_custkey").isNotNull()).select("o_orderkey")


@query("cte_chain", """with paid as (select * from orders where o_orderstatus <> 'P'), big as (select l_orderkey, sum(l_quantity) as qty from lineitem group by 1),
  joined as (select p.o_custkey, big.qty from paid p join big on p.o_orderkey = big.l_orderkey) select o_custkey, sum(qty) as qty from joined group by 1""")
def cte_chain(t):
    paid = t["orders"].where("o_orderstatus <> 'P'").withColumnRenamed("o_orderkey", "l_orderkey")
    big = t["lineitem"].groupBy("l_orderkey").agg(F.sum("l_quantity").alias("qty"))
    return paid.join(big, "l_orderkey").groupBy("o_custkey").agg(F.sum("qty").alias("qty"))


@query("typed_null", "select o_orderkey, cast(null as varchar) as currency, cast(null as double) as discount, 'Order' as document_type, true as is_valid_record from orders")
def typed_null(t):
    return d.constants(t["orders"], {"currency": F.lit(None).cast("string"), "discount": F.lit(None).cast(MONEY), "document_type": "Order", "is_valid_record": True},
                       ["o_orderkey", "currency", "discount", "document_type", "is_valid_record"])


@query("accrual_reversal", """with x as (select date_trunc('month', o_orderdate)::date as m, o_orderpriority as platform, sum(cast(o_totalprice as decimal(18,2))) as amt from orders
    where o_orderdate >= date '2001-05-01' and o_orderdate < date '2001-07-01' group by 1, 2)
  select platform, amt::double as amount, case when m = date '2001-06-01' then '2001-06-25' else '2001-06-25' end as posting_date,
    case when m = date '2001-06-01' then '64160102' else '33510102' end as account_no, case when m = date '2001-06-01' then '33510102' else '64160102' end as bal_account_no from x""")
def accrual_reversal(t):
    detail = t["orders"].select(
        F.date_add(F.trunc("o_orderdate", "month"), 24).alias("posting_date"), F.col("o_orderpriority").alias("external_doc_no"),
        F.lit("AMZ").alias("platform"), F.lit("USA").alias("country"), F.col("o_totalprice").cast(MONEY).alias("accrual_usd"), F.lit(RUN_TS).alias("run_time"))
    lines = accrual.marketplace_gl(detail, "2001-06", GL, RUN_TS, "Promotion")
    return lines.select(F.col("external_document_no").alias("platform"), "amount", "posting_date", "account_no", "bal_account_no")


# ---- scalar functions ------------------------------------------------------------------------
@query("fn_concat", "select o_orderkey, concat(o_orderpriority, '-OBH-', nullif(o_orderstatus, 'P')) as doc from orders")
def fn_concat(t):
    return t["orders"].select("o_orderkey", fn.concat_skip_null("o_orderpriority", F.lit("-OBH-"), F.nullif(F.col("o_orderstatus"), F.lit("P"))).alias("doc"))


@query("fn_split_part", "select o_orderkey, split_part(o_orderpriority, '-', 2) as second, split_part(o_orderpriority, '-', 5) as fifth from orders")
def fn_split_part(t):
    return t["orders"].select("o_orderkey", fn.part("o_orderpriority", "-", 2).alias("second"), fn.part("o_orderpriority", "-", 5).alias("fifth"))


@query("fn_left_right", 'select c_custkey, left(c_name, 4) as head, right(c_name, 3) as tail from customer')
def fn_left_right(t):
    return t["customer"].select("c_custkey", fn.head("c_name", 4).alias("head"), fn.tail("c_name", 3).alias("tail"))


@query("fn_position", "select o_orderkey, position('H' in o_orderpriority) as at, position('' in o_orderpriority) > 0 as empty_hit from orders")
def fn_position(t):
    return t["orders"].select("o_orderkey", F.position(F.lit("H"), F.col("o_orderpriority")).alias("at"), fn.contains("o_orderpriority", F.lit("")).alias("empty_hit"))


@query("fn_replace_case", "select c_custkey, replace(c_name, '#', '_') as renamed, upper(c_name) as up, lower(c_mktsegment) as low, length(c_name) as len from customer")
def fn_replace_case(t):
    return t["customer"].select("c_custkey", F.replace("c_name", F.lit("#"), F.lit("_")).alias("renamed"), F.upper("c_name").alias("up"),
                                F.lower("c_mktsegment").alias("low"), F.length("c_name").alias("len"))


@query("fn_like", "select p_partkey, p_brand like 'Brand#_' as one_digit, p_name not like '%ring%' as no_ring from part")
def fn_like(t):
    return t["part"].select("p_partkey", F.col("p_brand").like("Brand#_").alias("one_digit"), (~F.col("p_name").like("%ring%")).alias("no_ring"))


@query("fn_regex", "select doc_id, regexp_matches(text, '[0-9]{3}-') as dashed, not regexp_matches(text, 'the ') as no_the from documents")
def fn_regex(t):
    return t["documents"].select("doc_id", fn.matches("text", "[0-9]{3}-").alias("dashed"), fn.not_matches("text", "the ").alias("no_the"))


@query("fn_array_split", "select shipment_id, unnest(string_split(purchase_order, ',')) as po from shipments where purchase_order <> ''")
def fn_array_split(t):
    return t["shipments"].where("purchase_order <> ''").select("shipment_id", F.explode(F.split("purchase_order", ",")).alias("po"))


@query("fn_coalesce_case", """select o_orderkey, coalesce(nullif(o_orderstatus, 'P'), o_orderpriority) as first_known, case o_orderstatus when 'O' then case when o_totalprice > 250000
  then 'open big' else 'open' end when 'F' then 'done' else 'other' end as label from orders""")
def fn_coalesce_case(t):
    label = F.when(F.col("o_orderstatus") == "O", F.when(F.col("o_totalprice") > 250000, "open big").otherwise("open")).when(F.col("o_orderstatus") == "F", "done").otherwise("other")
    return t["orders"].select("o_orderkey", F.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("P")), F.col("o_orderpriority")).alias("first_known"), label.alias("label"))


@query("fn_round_abs", f"""select l_orderkey, l_linenumber, l_partkey, abs(- l_extendedprice) as size, {half_up(PRICE_C, '8')} as eighth, {half_up('-' + PRICE_C, '8')} as negative_eighth from lineitem""")
def fn_round_abs(t):
    price = F.col("l_extendedprice").cast(MONEY)
    return t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", F.abs(-price).alias("size"), F.round(price / 8, 2).alias("eighth"),
                                F.round(-price / 8, 2).alias("negative_eighth"))


@query("fn_to_char", """select o_orderkey, strftime(o_orderdate, '%Y') as y, strftime(o_orderdate, '%Y-%m') as ym, strftime(o_orderdate, '%Y%m%d') as ymd, strftime(o_orderdate, '%y%m%d') as short,
  strftime(o_orderdate, '%b%Y') as label, upper(strftime(o_orderdate, '%b%Y')) as capital from orders""")
def fn_to_char(t):
    patterns = {"y": "YYYY", "ym": "YYYY-MM", "ymd": "YYYYMMDD", "short": "YYMMDD", "label": "MonYYYY", "capital": "MONYYYY"}
    return t["orders"].select("o_orderkey", *[fn.date_text("o_orderdate", p).alias(n) for n, p in patterns.items()])


@query("fn_date_trunc_extract", "select event_id, date_trunc('month', ts)::date::varchar as month_start, month(ts)::int as month_no, ts::date::varchar as day from events")
def fn_date_trunc_extract(t):
    return t["events"].select("event_id", fn.month_start("ts").alias("month_start"), F.month("ts").alias("month_no"), F.col("ts").cast("date").alias("day"))


@query("fn_interval", """select o_orderkey, (o_orderdate - interval 1 month)::date::varchar as month_before, (o_orderdate - interval 5 day)::date::varchar as days_before,
  (date_trunc('month', o_orderdate - interval 2 month) + interval 24 day)::date::varchar as window_start from orders""")
def fn_interval(t):
    day = F.col("o_orderdate").cast("date")
    return t["orders"].select("o_orderkey", F.add_months(day, -1).alias("month_before"), F.date_sub(day, 5).alias("days_before"),
                              F.date_add(F.trunc(F.add_months(day, -2), "month"), 24).alias("window_start"))


@query("fn_now", "select o_orderkey, '2001-07-20 05:00:00' as run_time, '2001-07-20' as as_of from orders")
def fn_now(t):
    return t["orders"].select("o_orderkey", F.lit(RUN_TS).alias("run_time"), F.lit(AS_OF).alias("as_of"))


@query("fn_cast", """select o_orderkey, cast(o_orderkey as varchar) as text_key, cast(cast(o_totalprice as decimal(10,2)) as double) as amount, o_orderdate::date::varchar as day,
  rpad(o_orderstatus, 5, ' ') as padded from orders""")
def fn_cast(t):
    return t["orders"].select("o_orderkey", F.col("o_orderkey").cast("string").alias("text_key"), F.col("o_totalprice").cast("decimal(10,2)").alias("amount"),
                              F.col("o_orderdate").cast("date").alias("day"), F.rpad("o_orderstatus", 5, " ").alias("padded"))


@query("udf_end_of_last_month", "select o_orderkey, (date_trunc('month', o_orderdate) - interval 1 day)::date::varchar as last_month_end from orders")
def udf_end_of_last_month(t):
    return t["orders"].select("o_orderkey", fn.end_of_last_month("o_orderdate").alias("last_month_end"))


@query("udf_posting_date", """select o_orderkey, case when o_orderdate < date '2000-12-01' then '2000-12-01' when o_orderdate < date '2001-01-01' then o_orderdate::date::varchar end
  as posting_date from orders""")
def udf_posting_date(t):
    return t["orders"].select("o_orderkey", fn.posting_date("o_orderdate", date(2000, 12, 9)).alias("posting_date"))


@query("udf_null_if_blank", "select shipment_id, nullif(purchase_order, '') is null as blank from shipments")
def udf_null_if_blank(t):
    return t["shipments"].select("shipment_id", fn.blank_to_null("purchase_order").isNull().alias("blank"))
