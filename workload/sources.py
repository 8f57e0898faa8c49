"""Sources, sinks, snapshot and incremental operators on the driver tables."""

from datetime import date, datetime

from pyspark.sql import functions as F

from ledgerloom.operators import incremental as inc
from ledgerloom.session import new_stage_path
from ledgerloom.sources import io
from ledgerloom.sources.ledgers import KeyedLedger
from ledgerloom.sources.versions import current, publish
from workload.registry import query

CUTOFF = date(1998, 1, 1)
LINE_COLS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


def stage(t, name):
    return new_stage_path(t.spark, name)


@query("scan_filter_project", """select l_orderkey, l_extendedprice from lineitem where l_returnflag = 'R'
  and l_shipdate between timestamp '1997-01-01' and timestamp '1998-12-31'""")
def scan_filter_project(t):
    pred = (F.col("l_returnflag") == "R") & F.col("l_shipdate").between(F.lit(date(1997, 1, 1)), F.lit(date(1998, 12, 31)))
    return io.scan(t.spark, t.sf_dir, "lineitem", ["l_orderkey", "l_extendedprice"], pred)


@query("query_to_frame", """select o_orderstatus, count(*) as n, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
  from orders group by 1""")
def query_to_frame(t):
    return io.query(t.spark, """select o_orderstatus, count(*) as n, sum(cast(o_totalprice as decimal(18,2))) as total
      from ledger_orders group by o_orderstatus""", {"ledger_orders": t["orders"]})


@query("adjustment_ingest", """select cast(o_orderkey as varchar) as order_key, o_orderpriority as external_doc_no,
    cast(cast(o_totalprice as decimal(18,2)) as varchar) as amount_usd, case when o_orderstatus = 'F' then null else o_orderstatus end as note_text
  from orders where o_orderpriority <> '5-LOW'""")
def adjustment_ingest(t):
    path = stage(t, "adjustments")
    t["orders"].select(
        F.col("o_orderkey").alias("Order Key"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).otherwise("").alias("External / Doc No"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("Amount \\ USD"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).otherwise("").alias("Note\nText"),
        F.lit("beyond the used columns").alias("Remark")).write.csv(path, header=True)
    return io.ingest_adjustments(t.spark, path, "external_doc_no", 4)


@query("append_sink", f"select {LINE_COLS} from lineitem")
def append_sink(t):
    path = stage(t, "append")
    columns = LINE_COLS.split(", ")
    io.append(t["lineitem"].where("l_linestatus = 'F'").select(*columns), path)
    io.append(t["lineitem"].where("l_linestatus <> 'F'").select(*reversed(columns)), path)
    return t.spark.read.parquet(path)


@query("replace_sink", "select o_orderkey, o_orderstatus, cast(o_totalprice as decimal(18,2))::double as o_totalprice from orders where o_orderstatus <> 'P'")
def replace_sink(t):
    path = stage(t, "replace")
    publish(t["orders"].select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice")), path)
    return publish(current(t.spark, path).where("o_orderstatus <> 'P'"), path)


@query("snapshot_append", """select o_orderkey, o_orderstatus, '2001-07-20 06:00:00' as data_updated_time from orders where o_orderstatus <> 'F'""")
def snapshot_append(t):
    path = stage(t, "snapshot")
    rows = t["orders"].select("o_orderkey", "o_orderstatus")
    io.snapshot_append(rows, path, datetime(2001, 7, 19, 6))
    for _ in range(2):      # writing a load again does not double it
        log = io.snapshot_append(rows.where("o_orderstatus <> 'F'"), path, datetime(2001, 7, 20, 6))
    return inc.latest_snapshot(log, io.SNAPSHOT_PARTITION).drop(io.SNAPSHOT_PARTITION)


@query("report_export", """select cast(c_custkey as varchar) as c_custkey, c_name, case when c_mktsegment = 'BUILDING' then '' else c_mktsegment end
  as segment from customer""")
def report_export(t):
    path = stage(t, "report")
    rows = t["customer"].select("c_custkey", "c_name", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"))
    io.export_report(rows, path)
    return io.report_frame(t.spark.read.csv(path, header=True))


@query("named_view", "select o_orderpriority, count(*) as n from orders where o_orderstatus = 'O' group by 1")
def named_view(t):
    build = lambda: t["orders"].where("o_orderstatus = 'O'").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return io.named_view("open_orders_by_priority", build)


@query("cutoff_delete", """select 'header' as kind, o_orderkey as doc, count(*) as n from orders where o_orderdate < date '1998-01-01' group by 2
  union all select 'line', l_orderkey, count(*) from lineitem where l_orderkey not in
    (select o_orderkey from orders where o_orderdate >= date '1998-01-01') group by 2""")
def cutoff_delete(t):
    header, line = io.cutoff_delete(t["orders"], t["lineitem"], "l_orderkey", "o_orderkey", "o_orderdate", CUTOFF)
    count = lambda df, kind, key: df.groupBy(F.col(key).alias("doc")).agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit(kind))
    return count(header, "header", "o_orderkey").unionByName(count(line, "line", "l_orderkey"))


# ---- snapshot and incremental ----------------------------------------------------------------
@query("latest_snapshot", """select event_id, event_type, user_id from events where event_type = 'purchase'
  and cast(ts as date) = (select max(cast(ts as date)) from events where event_type = 'purchase')""")
def latest_snapshot(t):
    log = t["events"].withColumn("stamp", F.col("ts").cast("date"))
    return inc.latest_snapshot(log, "stamp", F.col("event_type") == "purchase").select("event_id", "event_type", "user_id")


@query("posted_exclusion", """select o_orderkey, o_totalprice from orders where o_orderkey not in
  (select o_orderkey from orders where upper(o_orderstatus) = 'F' union select l_orderkey from lineitem where l_returnflag = 'R' and l_orderkey is not null)""")
def posted_exclusion(t):
    posted = t["orders"].where(F.upper("o_orderstatus") == "F")
    manual = t["lineitem"].where("l_returnflag = 'R'")
    return inc.exclude_posted(t["orders"], "o_orderkey", (posted, "o_orderkey"), (manual, "l_orderkey")).select("o_orderkey", "o_totalprice")


@query("posted_exclusion_scoped", """select o_orderkey, o_custkey from orders where o_custkey not in
  (select o_custkey from orders where o_orderstatus = 'F' and o_orderpriority = '1-URGENT')""")
def posted_exclusion_scoped(t):
    posted = t["orders"].where("o_orderstatus = 'F' and o_orderpriority = '1-URGENT'")
    return inc.exclude_posted(t["orders"], "o_custkey", (posted, "o_custkey")).select("o_orderkey", "o_custkey")


@query("po_exclusion", """select po_number, count(*) as n from orders_export o where po_number not in
  (select po_number from shipped_lines where location_code is not null and not regexp_matches(location_code, 'SRT')) group by 1""")
def po_exclusion(t):
    shipped = t["shipped_lines"].where(~F.col("location_code").rlike("SRT"))
    return inc.exclude_posted(t["orders_export"], "po_number", (shipped, "po_number")).groupBy("po_number").agg(F.count(F.lit(1)).alias("n"))


@query("not_in_null_aware", """select 'clean' as list, o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'A')
  union all select 'with null', o_orderkey from orders where o_orderkey not in
    (select case when l_linenumber = 1 then null else l_orderkey end from lineitem where l_returnflag = 'A')
  union all select 'empty', o_orderkey from orders where nullif(o_orderkey, 7) not in (select l_orderkey from lineitem where l_returnflag = 'X')""")
def not_in_null_aware(t):
    keys, lines = t["orders"].select("o_orderkey"), t["lineitem"]
    lists = {
        "clean": lines.where("l_returnflag = 'A'").select("l_orderkey"),
        "with null": lines.where("l_returnflag = 'A'").select(F.when(F.col("l_linenumber") != 1, F.col("l_orderkey")).alias("l_orderkey")),
        "empty": lines.where("l_returnflag = 'X'").select("l_orderkey"),
    }
    parts = [inc.not_in(keys, "o_orderkey", other, "l_orderkey").select(F.lit(name).alias("list"), "o_orderkey") for name, other in lists.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("composite_anti", """select l_orderkey, l_suppkey, l_linenumber, l_partkey from lineitem a where not exists (select 1 from lineitem b where b.l_returnflag = 'R'
  and b.l_orderkey = a.l_orderkey and b.l_suppkey = a.l_suppkey)""")
def composite_anti(t):
    other = t["lineitem"].where("l_returnflag = 'R'")
    return inc.composite_anti(t["lineitem"], other, ["l_orderkey", "l_suppkey"]).select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey")


@query("latest_per_key", """select l_suppkey, l_orderkey, l_shipdate::date::varchar as day from (select *, row_number() over (partition by l_suppkey
  order by l_shipdate desc, l_orderkey, l_linenumber, l_partkey) as rn from lineitem) where rn = 1""")
def latest_per_key(t):
    order = [F.col("l_shipdate").desc_nulls_first(), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")]
    return inc.latest_per_key(t["lineitem"], ["l_suppkey"], order).select("l_suppkey", "l_orderkey", F.col("l_shipdate").cast("date").alias("day"))


@query("first_seen_keys", "select distinct o_custkey from orders")
def first_seen_keys(t):
    return inc.keys_of(t["orders"], "o_custkey")


DAILY_H = """daily_h as (select o_orderkey as external_doc_no, o_custkey, case when o_orderstatus = 'P' then 2 else 0 end as is_processed
  from orders where o_orderdate >= date '1997-01-01')"""
FINAL_H = "final_h as (select o_orderkey as external_doc_no from orders where o_orderdate < date '1998-01-01')"


@query("promote_to_final", f"""with {DAILY_H}, {FINAL_H}, daily_l as (select l_orderkey as document_no, l_partkey, l_quantity from lineitem),
  final_l as (select document_no from daily_l where document_no in (select external_doc_no from final_h))
  select 'header' as kind, external_doc_no as doc, o_custkey as part, 0.0::double as qty from daily_h where is_processed = 0
    and external_doc_no not in (select external_doc_no from final_h)
  union all select distinct 'line', document_no, l_partkey, l_quantity from daily_l where document_no not in (select document_no from final_l)
    and document_no in (select external_doc_no from daily_h where is_processed = 0)""")
def promote_to_final(t):
    daily_h = t["orders"].where(F.col("o_orderdate") >= F.lit(date(1997, 1, 1))).select(
        F.col("o_orderkey").alias("external_doc_no"), "o_custkey", F.when(F.col("o_orderstatus") == "P", 2).otherwise(0).alias("is_processed"))
    final_h = t["orders"].where(F.col("o_orderdate") < F.lit(CUTOFF)).select(F.col("o_orderkey").alias("external_doc_no"))
    daily_l = t["lineitem"].select(F.col("l_orderkey").alias("document_no"), "l_partkey", "l_quantity")
    final_l = daily_l.join(final_h.withColumnRenamed("external_doc_no", "document_no"), "document_no", "left_semi")
    header, line = inc.promote(daily_h, daily_l, final_h, final_l)
    header = header.select(F.lit("header").alias("kind"), F.col("external_doc_no").alias("doc"), F.col("o_custkey").alias("part"), F.lit(0.0).alias("qty"))
    return header.unionByName(line.select(F.lit("line").alias("kind"), F.col("document_no").alias("doc"), F.col("l_partkey").alias("part"), F.col("l_quantity").alias("qty")))


@query("promote_to_keyed_ledger", f"""with {DAILY_H}, {FINAL_H}, daily_l as (select l_orderkey as document_no, l_partkey, l_quantity from lineitem),
  final_l as (select document_no from daily_l where document_no in (select external_doc_no from final_h)),
  new_h as (select * from daily_h where is_processed = 0 and external_doc_no not in (select external_doc_no from final_h)),
  new_l as (select distinct * from daily_l where document_no not in (select document_no from final_l)
    and document_no in (select external_doc_no from daily_h where is_processed = 0))
  select 'header' as kind, count(*) as n, count(distinct external_doc_no) as documents from (select external_doc_no from final_h union all select external_doc_no from new_h)
  union all select 'line', count(*), count(distinct document_no) from (select document_no from final_l union all select document_no from new_l)
  union all select 'second run', 0, 0""")
def promote_to_keyed_ledger(t):
    """The day's documents go into ledgers laid out by key; a second run of the day finds nothing to add."""
    daily_h = t["orders"].where(F.col("o_orderdate") >= F.lit(date(1997, 1, 1))).select(
        F.col("o_orderkey").alias("external_doc_no"), F.when(F.col("o_orderstatus") == "P", 2).otherwise(0).alias("is_processed"))
    old_h = t["orders"].where(F.col("o_orderdate") < F.lit(CUTOFF)).select(F.col("o_orderkey").alias("external_doc_no"))
    daily_l = t["lineitem"].select(F.col("l_orderkey").alias("document_no"), "l_partkey", "l_quantity")
    old_l = daily_l.join(old_h.withColumnRenamed("external_doc_no", "document_no"), "document_no", "left_semi")
    final_h = KeyedLedger(t.spark, stage(t, "final_header"), "external_doc_no", 8).replace(old_h)
    final_l = KeyedLedger(t.spark, stage(t, "final_line"), "document_no", 8).replace(old_l)
    header, line = inc.promote(daily_h, daily_l, final_h, final_l)
    final_h.append(header.select("external_doc_no"))
    # the lines were planned on the line ledger alone, so the order of the two writes doesn't matter
    final_l.append(line)
    again_h, again_l = inc.promote(daily_h, daily_l, final_h, final_l)
    tally = lambda df, kind, key: df.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n"), F.countDistinct(key).alias("documents"))
    second = again_h.select("external_doc_no").union(again_l.select("document_no"))
    return tally(final_h.rows(), "header", "external_doc_no").union(tally(final_l.rows(), "line", "document_no")).union(tally(second, "second run", "external_doc_no"))


@query("posted_exclusion_keyed", """select o_orderkey, o_totalprice from orders where o_orderkey not in
  (select o_orderkey from orders where upper(o_orderstatus) = 'F' union select l_orderkey from lineitem where l_returnflag = 'R' and l_orderkey is not null)""")
def posted_exclusion_keyed(t):
    """As ``posted_exclusion``, the posted documents and the exclusion list being one ledger laid out by key, written in two steps."""
    posted = t["orders"].where(F.upper("o_orderstatus") == "F").select("o_orderkey")
    returned = t["lineitem"].where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    ledger = KeyedLedger(t.spark, stage(t, "posted"), "o_orderkey", 8).replace(posted).append(returned)
    return inc.exclude_posted(t["orders"].select("o_orderkey", "o_totalprice"), "o_orderkey", ledger)


LEDGER = """select l_orderkey as external_document_no, l_suppkey as region_code, cast(l_shipdate as date) as posting_date,
  cast(l_shipdate as date) as document_date, case when l_linenumber = 4 then cast(0 as decimal(18,2)) else cast(l_extendedprice as decimal(18,2)) end as amount,
  {flag} as is_processed from lineitem"""


def ledger(df, flag):
    day = F.col("l_shipdate").cast("date")
    return df.select(
        F.col("l_orderkey").alias("external_document_no"), F.col("l_suppkey").alias("region_code"), day.alias("posting_date"),
        day.alias("document_date"), F.when(F.col("l_linenumber") == 4, F.lit(0)).otherwise(F.col("l_extendedprice")).cast("decimal(18,2)").alias("amount"),
        flag.cast("int").alias("is_processed"))


@query("ledger_rollover", f"""with h as ({LEDGER.format(flag='0')} where l_returnflag = 'R' and l_shipdate < date '2001-08-01'),
  n as ({LEDGER.format(flag='3')} where l_linestatus = 'O' and l_shipdate < date '2001-08-01')
  select external_document_no, region_code, posting_date::varchar as posting_date, amount::double as amount, 2 as is_processed from h
  union all select external_document_no, region_code, posting_date::varchar, amount::double, is_processed from n where amount <> 0 and not exists
    (select 1 from h where h.external_document_no = n.external_document_no and h.region_code = n.region_code)""")
def ledger_rollover(t):
    history = ledger(t["lineitem"].where("l_returnflag = 'R'"), F.lit(0)).withColumn("stamp", F.lit(datetime(2001, 7, 1)))
    log = ledger(t["lineitem"], F.lit(3))
    old = log.withColumn("stamp", F.lit(datetime(2001, 7, 1)))
    new = ledger(t["lineitem"].where("l_linestatus = 'O'"), F.lit(3)).withColumn("stamp", F.lit(datetime(2001, 7, 20)))
    keys = ["external_document_no", "region_code"]
    out = inc.rollover(history, old.unionByName(new), keys, date(2001, 7, 20), "stamp")
    return out.select(*keys, "posting_date", "amount", "is_processed")


@query("status_flip", f"""with f as ({LEDGER.format(flag="case when l_linenumber = 1 then 2 else 1 end")} where l_returnflag = 'R'),
  d as ({LEDGER.format(flag='2')} where l_linestatus = 'O'),
  m as (select * from f union all select * from d where amount <> 0 and posting_date <= date '2000-12-25' and not exists
    (select 1 from f where f.external_document_no = d.external_document_no and f.region_code = d.region_code))
  select external_document_no, region_code, posting_date::varchar as posting_date, amount::double as amount,
    case when is_processed = 2 then 0 else is_processed end as is_processed from m""")
def status_flip(t):
    final = ledger(t["lineitem"].where("l_returnflag = 'R'"), F.when(F.col("l_linenumber") == 1, 2).otherwise(1))
    daily = ledger(t["lineitem"].where("l_linestatus = 'O'"), F.lit(2))
    keys = ["external_document_no", "region_code"]
    return inc.status_flip(daily, final, keys, date(2000, 12, 25)).select(*keys, "posting_date", "amount", "is_processed")


@query("incremental_isin", """with seen as (select distinct l_orderkey as k from lineitem where l_returnflag = 'R'),
  fresh as (select l_orderkey as doc, l_partkey as item, l_quantity as qty from lineitem where l_orderkey not in (select k from seen))
  select distinct 'header' as kind, doc, cast(null as bigint) as item, 'DATAMART_SI' as source_code from fresh
  union all select 'line', doc, item, 'DATAMART_SI' from fresh""")
def incremental_isin(t):
    fresh = inc.incremental(t["lineitem"], t["lineitem"].where("l_returnflag = 'R'"), "l_orderkey")
    fresh = fresh.select(F.col("l_orderkey").alias("doc"), F.col("l_partkey").alias("item"), F.lit("DATAMART_SI").alias("source_code"))
    header = fresh.select(F.lit("header").alias("kind"), "doc", F.lit(None).cast("long").alias("item"), "source_code").dropDuplicates()
    return header.unionByName(fresh.withColumn("kind", F.lit("line")))


@query("reexpose_unbooked", """select l_orderkey, l_linenumber, l_partkey from lineitem where l_orderkey in (select o_orderkey from orders where o_orderstatus <> 'P')
  and l_orderkey not in (select o_orderkey from orders where o_orderpriority = '1-URGENT' union select o_orderkey from orders where o_totalprice > 400000
    union select o_orderkey from orders where o_orderdate < date '1996-01-01')""")
def reexpose_unbooked(t):
    o = t["orders"]
    booked = [o.where("o_orderpriority = '1-URGENT'"), o.where("o_totalprice > 400000"), o.where(F.col("o_orderdate") < F.lit(date(1996, 1, 1)))]
    rows = inc.unbooked(t["lineitem"], "l_orderkey", o.where("o_orderstatus <> 'P'"), "o_orderkey", *[(b, "o_orderkey") for b in booked])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey")
