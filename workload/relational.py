"""Joins, aggregations, windows, sorting and set operations on the driver tables."""

from datetime import date

from pyspark.sql import functions as F

from ledgerloom.operators import aggs, joins, windows
from ledgerloom.operators.incremental import latest_per_key
from workload.registry import query

MONEY = "decimal(18,2)"


def money(col):
    return F.col(col).cast(MONEY)


# ---- joins -----------------------------------------------------------------------------------
@query("join_left_dims", """select l_orderkey, l_linenumber, l_partkey, p_brand, r_name, o_orderstatus from lineitem left join part on l_partkey = p_partkey
  left join supplier on l_suppkey = s_suppkey left join nation on s_nationkey = n_nationkey left join region on n_regionkey = r_regionkey
  left join orders on l_orderkey = o_orderkey and o_orderstatus <> 'P'""")
def join_left_dims(t):
    rows = t["lineitem"].join(t["part"], F.col("l_partkey") == F.col("p_partkey"), "left")
    rows = rows.join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"), "left").join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"), "left")
    rows = rows.join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"), "left")
    rows = rows.join(t["orders"].where("o_orderstatus <> 'P'"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "p_brand", "r_name", "o_orderstatus")


@query("join_header_line", """select o_orderkey, o_orderstatus, count(l_orderkey) as n_lines, sum(cast(l_extendedprice as decimal(18,2)))::double as amount
  from orders left join lineitem on o_orderkey = l_orderkey where o_orderpriority <> '5-LOW' group by 1, 2""")
def join_header_line(t):
    heads = t["orders"].where("o_orderpriority <> '5-LOW'")
    rows = heads.join(t["lineitem"], F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return rows.groupBy("o_orderkey", "o_orderstatus").agg(F.count("l_orderkey").alias("n_lines"), F.sum(money("l_extendedprice")).alias("amount"))


INTERVAL_SQL = """select a.po_number, a.item_number, a.quantity, a.wholesale_price::double as wholesale_price, c.base_cost::double as base_cost, c.effective_from::varchar as effective_from
  from orders_export a left join base_cost c on a.item_number = c.supplier_part_number and a.account_name = c.account_name
    and a.po_date_time between c.effective_from and c.effective_to"""
INTERVAL_KEYS = [("item_number", "supplier_part_number"), ("account_name", "account_name")]
INTERVAL_COLS = ["po_number", "item_number", "quantity", "wholesale_price", "base_cost", "effective_from"]


@query("join_interval", INTERVAL_SQL)
def join_interval(t):
    return joins.interval_join(t["orders_export"], t["base_cost"], INTERVAL_KEYS, "po_date_time", "effective_from", "effective_to").select(*INTERVAL_COLS)


@query("join_interval_bucketed", INTERVAL_SQL)
def join_interval_bucketed(t):
    return joins.interval_join(t["orders_export"], t["base_cost"], INTERVAL_KEYS, "po_date_time", "effective_from", "effective_to",
                               bucket_days=365).select(*INTERVAL_COLS)


@query("join_interval_ranged", INTERVAL_SQL)
def join_interval_ranged(t):
    return joins.ranged_interval_join(t["orders_export"], t["base_cost"], INTERVAL_KEYS, "po_date_time", "effective_from", "effective_to").select(*INTERVAL_COLS)


@query("join_contains", """with ids as (select supplier_stock_id, string_agg(distinct item_id, ',' order by item_id) as ids from catalogue group by 1),
  promo as (select item_id, current_cost, promo_start_1, promo_end_1 from promo_log where hour(data_updated_time) = 6 and day(data_updated_time) = 18),
  pairs as (select ids, promo.* from (select distinct ids from ids) join promo on position(item_id in ids) > 0)
  select o.purchase_order_id, o.order_line_id, o.item_sku, p.item_id as promo_item, p.current_cost::double as current_cost from order_lines o join ids i on o.item_sku = i.supplier_stock_id
  left join pairs p on i.ids = p.ids and o.order_date between p.promo_start_1 and p.promo_end_1""")
def join_contains(t):
    ids = t["catalogue"].groupBy("supplier_stock_id").agg(aggs.string_distinct("item_id", ",").alias("ids"))
    promo = t["promo_log"].where("day(data_updated_time) = 18").select(F.col("item_id").alias("promo_item"), "current_cost", "promo_start_1", "promo_end_1")
    rows = t["order_lines"].join(ids, F.col("item_sku") == F.col("supplier_stock_id"))
    out = joins.contains_join(rows, promo, "ids", "promo_item", ("order_date", "promo_start_1", "promo_end_1"), texts=ids)
    return out.select("purchase_order_id", "order_line_id", "item_sku", "promo_item", "current_cost")


@query("join_contains_token", """select s.shipment_id, p.po_id, p.vendor from shipments s left join
  (select distinct purchase_order as lst, unnest(string_split(purchase_order, ',')) as tok from shipments) x on s.purchase_order = x.lst left join purchase_orders p on x.tok = p.po_id
  where s.purchase_order <> ''""")
def join_contains_token(t):
    rows = t["shipments"].where("purchase_order <> ''").select("shipment_id", "purchase_order")
    return joins.token_join(rows, t["purchase_orders"], "purchase_order", "po_id").select("shipment_id", "po_id", "vendor")


@query("join_fallback", """with ids as (select supplier_stock_id, max(item_id) as item_id from catalogue where fulfillment_method = 'DSV' group by 1)
  select o.purchase_order_id, o.order_line_id, o.item_sku, coalesce(y.item_id, z.item_id, 'Not found') as item_id from order_lines o left join ids y on o.item_sku = y.supplier_stock_id
  left join ids z on left(o.item_sku, 4) = z.supplier_stock_id""")
def join_fallback(t):
    ids = t["catalogue"].where("fulfillment_method = 'DSV'").groupBy("supplier_stock_id").agg(F.max("item_id").alias("item_id"))
    rows = t["order_lines"].select("purchase_order_id", "order_line_id", "item_sku")
    return joins.fallback_join(rows, ids, "supplier_stock_id", "item_id", [F.col("item_sku"), F.left("item_sku", F.lit(4))], "item_id", F.lit("Not found"))


@query("join_rate_asof_day", """select i.invoice_num, i.currency, f.to_usd::double as to_usd, (i.amount * f.to_usd)::double as amount_usd from invoices i
  left join fx f on i.currency = f.currency_code and cast(i.invoice_date as date) = f.run_date""")
def join_rate_asof_day(t):
    rows = t["invoices"].withColumn("day", F.col("invoice_date").cast("date"))
    out = joins.rate_join(rows, t["fx"], "currency", "day", "currency_code", "run_date", "to_usd")
    return out.select("invoice_num", "currency", "to_usd", (F.col("amount") * F.col("to_usd")).alias("amount_usd"))


@query("join_constant_dim", """select o_orderkey, 'cid-AMERICA' as company_id, cast(null as varchar) as missing_id, twice as twice_id
  from orders cross join (select unnest(['cid-EUROPE', 'cid-SECOND']) as twice)""")
def join_constant_dim(t):
    rows = joins.constant_dim(t["orders"].select("o_orderkey"), t["companies"], F.col("company_code") == "CO1", ["company_id"])
    rows = joins.constant_dim(rows, t["companies"].withColumnRenamed("company_id", "missing_id"), F.col("company_code") == "none", ["missing_id"])
    return joins.constant_dim(rows, t["companies"].withColumnRenamed("company_id", "twice_id"), F.col("company_code") == "CO3", ["twice_id"])


FULL_SQL = """with src as (select l_orderkey as doc, sum(cast(l_extendedprice as decimal(18,2))) as src from lineitem where l_linestatus = 'O' group by 1),
  bk as (select o_orderkey as doc, cast(o_totalprice as decimal(18,2)) as bk from orders where o_orderstatus <> 'P')
  select coalesce(src.doc, bk.doc) as doc, src::double as src_amount, bk::double as booked_amount from src full join bk on src.doc = bk.doc"""


@query("join_full_outer", FULL_SQL + " where src is distinct from bk")
def join_full_outer(t):
    src = t["lineitem"].where("l_linestatus = 'O'").groupBy(F.col("l_orderkey").alias("doc")).agg(F.sum(money("l_extendedprice")).alias("src_amount"))
    booked = t["orders"].where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("doc"), money("o_totalprice").alias("booked_amount"))
    return src.join(booked, "doc", "full").where(~F.col("src_amount").eqNullSafe(F.col("booked_amount")))


@query("join_full_expr", """with a as (select case split_part(o_orderpriority, '-', 2) when 'URGENT' then 'TOP' else split_part(o_orderpriority, '-', 2) end as k, strftime(o_orderdate, '%Y-%m') as m, count(*) as n from orders
    where o_orderstatus = 'O' group by 1, 2),
  b as (select split_part(o_orderpriority, '-', 2) as k, strftime(o_orderdate, '%Y-%m') as m, count(*) as n from orders where o_orderstatus = 'F' group by 1, 2)
  select a.k as open_key, b.k as done_key, coalesce(a.m, b.m) as month, a.n as n_open, b.n as n_done from a full join b on a.k = b.k and a.m = b.m""")
def join_full_expr(t):
    kind = F.split_part("o_orderpriority", F.lit("-"), F.lit(2))
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    count = lambda df, key, k, n: df.groupBy(key.alias(k), month).agg(F.count(F.lit(1)).alias(n))
    left = count(t["orders"].where("o_orderstatus = 'O'"), F.when(kind == "URGENT", "TOP").otherwise(kind), "open_key", "n_open")
    right = count(t["orders"].where("o_orderstatus = 'F'"), kind, "done_key", "n_done").withColumnRenamed("month", "m2")
    rows = left.join(right, (F.col("open_key") == F.col("done_key")) & (F.col("month") == F.col("m2")), "full")
    return rows.select("open_key", "done_key", F.coalesce("month", "m2").alias("month"), "n_open", "n_done")


@query("join_right", """select o_orderkey, o_orderstatus, x.qty from (select l_orderkey, sum(l_quantity) as qty from lineitem where l_returnflag = 'R' group by 1) x right join orders on l_orderkey = o_orderkey""")
def join_right(t):
    out = t["lineitem"].where("l_returnflag = 'R'").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("qty"))
    return out.join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"), "right").select("o_orderkey", "o_orderstatus", "qty")


@query("join_inner_chain", """select n.note_id, i.sku, i.actual_exported_qty, d.erp_warehouse from notes n join note_items i on n.note_id = i.note_id join warehouses w on n.warehouse_from_id = w.warehouse_id
  join warehouse_dim d on d.dim_short = w.short_name where n.status = 'COMPLETED'""")
def join_inner_chain(t):
    rows = t["notes"].where("status = 'COMPLETED'").join(t["note_items"], "note_id").join(t["warehouses"], F.col("warehouse_from_id") == F.col("warehouse_id"))
    return rows.join(t["warehouse_dim"], F.col("dim_short") == F.col("short_name")).select("note_id", "sku", "actual_exported_qty", "erp_warehouse")


@query("join_semi", """select o_orderkey, case when o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R') then 'returned' else 'kept' end as label from orders
  where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')""")
def join_semi(t):
    customers = t["customer"].where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    rows = t["orders"].join(customers, "o_custkey", "left_semi")
    flagged = joins.member_flag(rows, F.col("o_orderkey"), t["lineitem"].where("l_returnflag = 'R'"), "l_orderkey", "returned")
    return flagged.select("o_orderkey", F.when(F.col("returned"), "returned").otherwise("kept").alias("label"))


@query("join_anti", "select o_orderkey from orders left join lineitem on o_orderkey = l_orderkey and l_returnflag = 'R' where l_orderkey is null")
def join_anti(t):
    return t["orders"].join(t["lineitem"].where("l_returnflag = 'R'"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")


@query("join_null_safe", """with a as (select o_orderkey, case when o_orderstatus = 'P' then null else o_orderstatus end as k, o_orderpriority as p from orders),
  b as (select coalesce(nullif(o_orderstatus, 'P'), '') as k, o_orderpriority as p, count(*) as n from orders group by 1, 2)
  select a.o_orderkey, a.k, b.n from a left join b on coalesce(a.k, '') = b.k and a.p = b.p""")
def join_null_safe(t):
    blank = lambda c: F.coalesce(c, F.lit(""))
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    a = t["orders"].select("o_orderkey", status.alias("k"), F.col("o_orderpriority").alias("p"))
    b = t["orders"].groupBy(blank(status).alias("k2"), F.col("o_orderpriority").alias("p2")).agg(F.count(F.lit(1)).alias("n"))
    return a.join(b, (blank(F.col("k")) == F.col("k2")) & (F.col("p") == F.col("p2")), "left").select("o_orderkey", "k", "n")


@query("join_text_rule", """select p.p_partkey, r.rule, r.token from part p left join (select p_brand as brand, p_type as rule, split_part(p_name, ' ', 2) as token from part group by all) r
  on p.p_brand = r.brand and position(r.token in p.p_name) > 0 and r.rule = 'PROMO'""")
def join_text_rule(t):
    rules = t["part"].where("p_type = 'PROMO'").select(
        F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"), F.split_part("p_name", F.lit(" "), F.lit(2)).alias("token")).distinct()
    out = joins.text_rule_join(t["part"], rules, [(F.col("p_brand"), "brand")], ("p_name", F.col("rule_token")))
    return out.select("p_partkey", F.col("rule_kind").alias("rule"), F.col("rule_token").alias("token"))


@query("join_scalar_subquery", "select o_orderkey, o_orderdate::date::varchar as day from orders where o_orderdate >= (select max(l_shipdate) from lineitem where l_shipdate < date '1999-01-01')")
def join_scalar_subquery(t):
    bound = t["lineitem"].where(F.col("l_shipdate") < F.lit(date(1999, 1, 1))).select(F.max("l_shipdate")).scalar()
    return t["orders"].where(F.col("o_orderdate") >= bound).select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))


# ---- aggregations ----------------------------------------------------------------------------
@query("agg_sum", """select l_orderkey, sum(cast(l_extendedprice as decimal(18,2)))::double as amount, sum(cast(l_extendedprice as decimal(18,2)) * l_quantity::int)::double as weighted from lineitem group by 1""")
def agg_sum(t):
    return t["lineitem"].groupBy("l_orderkey").agg(F.sum(money("l_extendedprice")).alias("amount"),
                                                   F.sum(money("l_extendedprice") * F.col("l_quantity").cast("int")).alias("weighted"))


@query("agg_conditional_count", """select purchase_order_id, count(*) as line_count, count(case when order_line_status in ('Delivered', 'Shipped') then 1 end) as success_line,
  count(case when order_line_status = 'Cancelled' then 1 end) as cancelled_line from order_lines group by 1 having count(case when order_line_status in ('Delivered', 'Shipped') then 1 end)
  + count(case when order_line_status = 'Cancelled' then 1 end) = count(*) and count(case when order_line_status in ('Delivered', 'Shipped') then 1 end) <> 0""")
def agg_conditional_count(t):
    return aggs.completeness(t["order_lines"], "purchase_order_id", "order_line_status", ["Delivered", "Shipped"], ["Cancelled"])


@query("agg_unique_or_unknown", "select transaction_id, string_agg(distinct warehouse, '') as warehouse from txn_ds where ims_id is not null group by 1 having count(distinct warehouse) = 1")
def agg_unique_or_unknown(t):
    return aggs.unique_or_unknown(t["txn_ds"].where("ims_id is not null"), "transaction_id", "warehouse")


@query("agg_string_distinct", "select supplier_stock_id, string_agg(distinct item_id, ',' order by item_id) as items, string_agg(distinct product_gtin, ',' order by product_gtin) as gtins from catalogue group by 1")
def agg_string_distinct(t):
    return aggs.distinct_lists(t["catalogue"], ["supplier_stock_id"], {"items": ("item_id", ","), "gtins": ("product_gtin", ",")})


@query("agg_string", "select po_number, string_agg(item_number, ' | ' order by item_number) as sku_list from orders_export group by 1")
def agg_string(t):
    return aggs.ordered_lists(t["orders_export"], ["po_number"], "item_number", " | ", "sku_list")


@query("agg_count_distinct", "select l_suppkey, count(distinct l_orderkey) as n_docs, count(distinct l_shipdate::date) as n_days, count(distinct l_partkey) as n_parts, sum(l_quantity) as qty from lineitem group by 1")
def agg_count_distinct(t):
    return t["lineitem"].groupBy("l_suppkey").agg(F.countDistinct("l_orderkey").alias("n_docs"), F.countDistinct(F.col("l_shipdate").cast("date")).alias("n_days"),
                                                  F.countDistinct("l_partkey").alias("n_parts"), F.sum("l_quantity").alias("qty"))


@query("agg_max", """select 'all' as scope, max(o_orderdate)::date::varchar as newest from orders union all select o_orderpriority, max(o_orderdate)::date::varchar from orders group by 1""")
def agg_max(t):
    newest = F.max("o_orderdate").cast("date").alias("newest")
    return t["orders"].agg(newest).withColumn("scope", F.lit("all")).unionByName(t["orders"].groupBy(F.col("o_orderpriority").alias("scope")).agg(newest))


@query("agg_group_constant", "select 'orders' as source, max(o_totalprice) as top from orders group by 1 union all select 'none', max(o_totalprice) from orders where o_orderstatus = 'X' group by 1")
def agg_group_constant(t):
    top = F.max("o_totalprice").alias("top")
    return aggs.group_constant(t["orders"], "orders", "source", top).unionByName(aggs.group_constant(t["orders"].where("o_orderstatus = 'X'"), "none", "source", top))


@query("agg_having_sum", """select l_suppkey, l_partkey, sum(case l_returnflag when 'R' then -1 when 'A' then null else 1 end * l_quantity)::double as net from lineitem group by 1, 2
  having sum(case l_returnflag when 'R' then -1 when 'A' then null else 1 end * l_quantity) <> 0""")
def agg_having_sum(t):
    signed = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).when(F.col("l_returnflag") == "N", F.col("l_quantity")).cast(MONEY)
    return aggs.nonzero_sum(t["lineitem"], ["l_suppkey", "l_partkey"], signed, "net")


@query("agg_decimal_cast", "select o_custkey, sum(cast(o_totalprice as decimal(10,2)))::double as cast_then_sum, cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(12,2))::double as sum_then_cast from orders group by 1")
def agg_decimal_cast(t):
    return t["orders"].groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast("decimal(10,2)")).alias("cast_then_sum"),
                                                F.sum(money("o_totalprice")).cast("decimal(12,2)").alias("sum_then_cast"))


OWNER_ROWS = """own as (select invoicenumber as doc, belong_to_company as owner from df_items a left join profiles p on a.asin = p.platform_prd_id and p.country = 'USA'
  left join items c on p.pims_sku = c.item_id group by all)"""


@query("agg_mixed_owner", f"""with {OWNER_ROWS}, mixed as (select doc from own group by 1 having bool_or(owner = 'MAIN') and bool_or(owner in ('SIDE', 'JOINT')))
  select doc, owner from own where not (doc in (select doc from mixed) and coalesce(owner, '') in ('SIDE', 'JOINT'))""")
def agg_mixed_owner(t):
    profile = t["profiles"].where("country = 'USA'").select(F.col("platform_prd_id").alias("asin"), F.col("pims_sku").alias("item_id"))
    rows = t["df_items"].join(profile, "asin", "left").join(t["items"], "item_id", "left").select(
        F.col("invoicenumber").alias("doc"), F.col("belong_to_company").alias("owner")).distinct()
    return aggs.drop_secondary_owners(rows, "doc", "owner", "MAIN", ["SIDE", "JOINT"])


@query("distinct_rows", "select distinct o_custkey, o_orderstatus from orders")
def distinct_rows(t):
    return t["orders"].select("o_custkey", "o_orderstatus").distinct()


GAP = "est as (select user_id, sum(case when event_type = 'click' then value::decimal(18,2) end) as e, sum(case when event_type = 'purchase' then value::decimal(18,2) end) as i from events group by 1)"


@query("agg_positive_gap", f"with {GAP} select user_id, (case when e > coalesce(i, 0) then e - coalesce(i, 0) else 0 end)::double as accrual from est")
def agg_positive_gap(t):
    from ledgerloom.functions.scalars import positive_gap

    sums = t["events"].groupBy("user_id").agg(aggs.pivot_sum(F.col("event_type") == "click", money("value")).alias("e"),
                                              aggs.pivot_sum(F.col("event_type") == "purchase", money("value")).alias("i"))
    return sums.select("user_id", positive_gap("e", "i").alias("accrual"))


@query("agg_pivot_sum", """select l_orderkey, sum(cast(l_extendedprice as decimal(18,2)))::double as gross, sum(case when l_returnflag in ('R', 'A') then cast(l_extendedprice as decimal(18,2)) end)::double as net
  from lineitem group by 1""")
def agg_pivot_sum(t):
    price = money("l_extendedprice")
    return t["lineitem"].groupBy("l_orderkey").agg(F.sum(price).alias("gross"), aggs.pivot_sum(F.col("l_returnflag").isin("R", "A"), price).alias("net"))


# ---- windows, sorting, sets ------------------------------------------------------------------
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]


@query("win_line_no", f"select l_orderkey, l_partkey, l_suppkey, 10000 * row_number() over (partition by l_orderkey order by {', '.join(LINE_ORDER)}) as line_no from lineitem")
def win_line_no(t):
    lines = t["lineitem"].select("l_orderkey", *LINE_ORDER)
    return windows.line_numbers(lines, "l_orderkey", [F.col(c) for c in LINE_ORDER], scanned=True).select("l_orderkey", "l_partkey", "l_suppkey", "line_no")


@query("win_latest", """select o_custkey, o_orderkey from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders) where rn = 1""")
def win_latest(t):
    return latest_per_key(t["orders"], ["o_custkey"], [F.col("o_orderdate").desc_nulls_first(), F.col("o_orderkey").desc()]).select("o_custkey", "o_orderkey")


@query("win_dense_rank_global", "select l_orderkey, l_linenumber, l_suppkey, l_partkey, 'GJNLGEN' || strftime(l_shipdate, '%y%m') || (10000 + dense_rank() over (order by l_partkey)) as document_no from lineitem")
def win_dense_rank_global(t):
    from ledgerloom.functions.scalars import concat_skip_null, date_text

    ranked = windows.dense_rank_global(t["lineitem"].select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate"), "l_partkey")
    number = concat_skip_null(F.lit("GJNLGEN"), date_text("l_shipdate", "YY"), date_text("l_shipdate", "MM"), F.col("rank") + 10000)
    return ranked.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", number.alias("document_no"))


RESIDUAL = "(cast(o_totalprice * 100 as bigint) - sum(cast(round(l_extendedprice * 100) as bigint)) over w)"


@query("win_allocate", f"""with x as (select l_orderkey, l_linenumber, l_partkey, (cast(round(o_totalprice * 100) as bigint) - sum(cast(round(l_extendedprice * 100) as bigint)) over w)::bigint * l_quantity::bigint as num,
    (sum(l_quantity::bigint) over w)::bigint as den from lineitem join orders on l_orderkey = o_orderkey window w as (partition by l_orderkey))
  select l_orderkey, l_linenumber, l_partkey, (sign(num) * ((2 * abs(num) + den) // (2 * den)))::double / 100 as allocated from x""")
def win_allocate(t):
    rows = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", money("o_totalprice").alias("total"), money("l_extendedprice").alias("cost"), F.col("l_quantity").cast("int").alias("qty"))
    out = windows.allocate(rows, "l_orderkey", "total", "cost", "qty")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.round("allocated", 2).alias("allocated"))


@query("sort_report", "select o_orderkey, o_orderpriority, nullif(o_orderstatus, 'P') as status from orders order by status asc nulls last, o_orderpriority desc nulls first, o_orderkey")
def sort_report(t):
    rows = t["orders"].select("o_orderkey", "o_orderpriority", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"))
    return rows.orderBy(F.asc_nulls_last("status"), F.desc_nulls_first("o_orderpriority"), F.asc_nulls_last("o_orderkey"))


@query("set_union_all", """select 'order' as kind, o_orderkey as id from orders union all select 'line', l_orderkey from lineitem union all select 'customer', c_custkey from customer
  union all select 'part', p_partkey from part union all select 'supplier', s_suppkey from supplier union all select 'event', event_id from events""")
def set_union_all(t):
    out = None
    for kind, table, key in (("order", "orders", "o_orderkey"), ("line", "lineitem", "l_orderkey"), ("customer", "customer", "c_custkey"),
                             ("part", "part", "p_partkey"), ("supplier", "supplier", "s_suppkey"), ("event", "events", "event_id")):
        part = t[table].select(F.lit(kind).alias("kind"), F.col(key).alias("id"))
        out = part if out is None else out.unionByName(part)
    return out


@query("set_union_distinct", "select o_custkey as id from orders union select c_custkey from customer union select l_partkey from lineitem")
def set_union_distinct(t):
    one = lambda table, key: t[table].select(F.col(key).alias("id"))
    return one("orders", "o_custkey").union(one("customer", "c_custkey")).union(one("lineitem", "l_partkey")).distinct()
