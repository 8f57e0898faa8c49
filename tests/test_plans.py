import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from ledgerloom.plans import accrual, config as c, expense, recon, sales_invoice as si
from ledgerloom.plans.config import ChannelConfig, GlConfig
from ledgerloom.schemas import GL_LINE, HEADER, LINE, SNAPSHOT, conform
from ledgerloom.sources.io import snapshot_append
from tests.conftest import rows

AS_OF, RUN = date(2025, 1, 20), datetime(2025, 1, 20, 5)


def snapshot(spark, data):
    """Candidates from (doc, owner, no, amount, order date, location, channel)."""
    schema = "external_doc_no string, belong_to_company string, no string, amount decimal(18,2), order_date date, wh_location string, internal_sales_channel string"
    df = spark.createDataFrame(data, schema)
    return conform(df.withColumns({
        "original_external_doc_no": F.col("external_doc_no"), "po_number": F.col("external_doc_no"), "quantity": F.lit(2), "unit_price": F.col("amount") / 2,
        "is_valid_record": F.lit(True), "country": F.lit("REG-USA"), "sales_channel": F.lit("CHAN-AVC"), "uom": F.lit("pcs"), "type": F.lit("ITEM"),
        "bill_to_customer": F.lit("CUST"), "line_no": F.lit(10000), "document_type": F.lit("Order"), "data_updated_time": F.lit(RUN)}), SNAPSHOT)


def tables(spark, posted=(), excluded=(), moves=()):
    return {
        "posted_header": spark.createDataFrame(list(posted), "external_doc_no string, original_external_doc_no string, document_type string, internal_sales_channel string"),
        "excluded": spark.createDataFrame([(e,) for e in excluded], "external_doc_no string"),
        "transactions": spark.createDataFrame(list(moves), "transaction string, transaction_id string, warehouse string, log_date date, ims_id int, log_id int, qty int"),
        "posted_line": spark.createDataFrame([("p2", "156-USA"), ("p3", "156-SRT"), ("p4", None)], "po_number string, location_code string"),
    }


CFG = ChannelConfig(channels=["T"], own=["M", "S"], main="M", date_from=date(2024, 1, 1), evidence="T", dedupe_owners=False,
                    obh_stock=lambda: F.col("belong_to_company") != "HMD")
D = date(2025, 1, 5)


def test_channel_routes_posts_and_expands(spark):
    cand = snapshot(spark, [
        ("own1", "M", "A", Decimal("10.00"), D, c.UNIDENTIFIED, "T"), ("own2", "S", "A", Decimal("10.00"), date(2024, 12, 5), c.UNIDENTIFIED, "T"),
        ("posted", "M", "A", Decimal("1.00"), D, c.UNIDENTIFIED, "T"), ("manual", "M", "A", Decimal("1.00"), D, c.UNIDENTIFIED, "T"),
        ("early", "M", "A", Decimal("1.00"), date(2023, 1, 1), c.UNIDENTIFIED, "T"), ("nobody", None, "A", Decimal("1.00"), D, "x", "T"),
        ("obh1", "HMD", "B", Decimal("7.00"), D, "loc", "T"), ("obh2", "Bitis", "B", Decimal("8.00"), D, "loc", "T")])
    moves = [("T", "own1", "CRA", D, 1, 1, 1), ("T", "own1", "CRA", D, 0, 0, 9), ("T", "own2", "CRA", D, 1, 1, 1), ("T", "own2", "FLO", D, 1, 1, 1)]
    t = tables(spark, [("posted", "posted", "order", "T"), ("obh1", "obh1", "Return", "X")], ["manual"], moves)
    header, line = si.run_channel(cand, t, CFG, AS_OF)
    assert header.columns == [f.name for f in HEADER.fields] and line.columns == [f.name for f in LINE.fields]
    # obh1 is held back: any posted document with its number counts for on-behalf goods
    assert rows(header, "external_doc_no", "location", "name", "posting_date") == [
        ("obh2", "loc", "US-SER0002-BTT", AS_OF), ("own1", "156-3PL-CB", None, D), ("own2", c.UNIDENTIFIED, None, date(2025, 1, 1))]
    assert rows(line, "document_no", "type", "no", "uom", "amount") == [
        ("obh2", "G/L Account", "33890101", None, Decimal("8.00")), ("obh2", "ITEM", "B", "pcs", Decimal("0.00")),
        ("own1", "ITEM", "A", "pcs", Decimal("10.00")), ("own2", "ITEM", "A", "pcs", Decimal("10.00"))]


def test_po_exclusion_drops_only_shipped_elsewhere(spark):
    cand = snapshot(spark, [(f"p{i}", "M", "A", Decimal("1.00"), D, "x", "T") for i in (1, 2, 3, 4)])
    cfg = ChannelConfig(channels=["T"], own=["M"], date_from=date(2024, 1, 1), po_exclusion=True)
    header, _ = si.run_channel(cand, tables(spark), cfg, AS_OF)
    assert rows(header, "external_doc_no") == [("p1",), ("p3",), ("p4",)]


def test_empty_batch_does_not_take_another_channels_load(spark, tmp_path):
    path = str(tmp_path / "log")
    snapshot_append(snapshot(spark, [("t1", "M", "A", Decimal("1.00"), D, "x", "T")]), path, datetime(2025, 1, 19))
    log = snapshot_append(snapshot(spark, [("u1", "M", "A", Decimal("1.00"), D, "x", "U")]), path, datetime(2025, 1, 20))
    header, _ = si.run_channel(None, tables(spark), CFG, AS_OF, snapshot_log=log)
    assert rows(header, "external_doc_no") == [("t1",)]


def test_mixed_owner_headers_are_removed(spark):
    cand = snapshot(spark, [("d", "M", "A", Decimal("1.00"), D, "x", "T"), ("d", "S", "B", Decimal("2.00"), D, "x", "T")])
    cfg = ChannelConfig(channels=["T"], own=["M", "S"], main="M", date_from=date(2024, 1, 1), dedupe_owners=True)
    header, line = si.run_channel(cand, tables(spark), cfg, AS_OF)
    assert rows(header, "external_doc_no", "belong_to_company") == [("d", "M")] and line.count() == 2


def test_shipment_lists_with_blanks(spark):
    df = spark.createDataFrame([
        ("s1", "r", "a,b,", date(2024, 1, 2), "Brea"), ("s1", "r", "zzz", date(2024, 1, 1), "Fontana"), ("s2", "r", "", date(2024, 1, 1), "Fontana"),
        ("s3", "r", "a", date(2024, 1, 1), "Fontana"), ("s4", "r", None, date(2024, 1, 1), "Fontana"), ("s5", "r", "q", date(2024, 1, 1), "Nowhere")],
        "shipment_id string, reference_id string, purchase_order string, run_date date, ship_from_city string")
    out = rows(si.shipment_locations(df))
    assert ("a_r", "156-3PL-FT") in out and ("b_r", "156-USA-CA") in out    # first city in precedence wins
    assert not [r for r in out if r[0].startswith(("zzz", "q"))]


def test_extra_invoices_change_account(spark):
    staging = snapshot(spark, [("x1", "M", "A", Decimal("1.00"), D, "loc", "T"), ("x2", "M", "A", Decimal("1.00"), D, "loc", "T")])
    extra = spark.createDataFrame([("x1", "extra invoice", 1), ("x1", "EXTRA INVOICE", 1), ("x2", "other", None)], "invoice_no string, type_of_invoice string, invoice_vendor int")
    header, line = si.reclass_extra(staging, extra)
    assert rows(header, "external_doc_no", "wh_location", "is_processed") == [("x1", None, 2), ("x2", "loc", 0)]
    assert rows(line, "external_doc_no", "no", "uom") == [("x1", "71190101", None), ("x2", "A", "pcs")]


def test_gl_line_layout(spark):
    out = accrual.gl_line(spark.range(1), GlConfig(company_id="c"), {"amount": F.lit(5)})
    assert out.columns == [f.name for f in GL_LINE.fields] and len(out.columns) == 35
    row = out.first()
    assert row["company_id"] == "c" and row["due_date"] == "" and row["error_type"] is None


def detail(spark, data):
    return spark.createDataFrame(data, "posting_date date, external_doc_no string, platform string, country string, accrual_usd decimal(18,4), run_time timestamp")


def test_accrual_books_and_reverses_latest_run(spark):
    t1, t2 = datetime(2025, 1, 26), datetime(2025, 1, 27)
    rows_in = [(date(2025, 1, 25), "a", "AMZ", "MEX", Decimal("5.005"), t1), (date(2025, 1, 25), "a", "AMZ", "MEX", Decimal("7"), t2),
               (date(2024, 12, 25), "b", "AMZ", "ARE", Decimal("3"), t1), (date(2024, 12, 25), "z", "AMZ", "USA", Decimal("0"), t1),
               (date(2024, 12, 25), "s", "AMZ", "SGP", Decimal("9"), t1)]
    out = accrual.marketplace_gl(detail(spark, rows_in), "2025-01", GlConfig(), RUN, "Advertising", skip=["SGP"])
    assert rows(out, "external_document_no", "amount", "account_no", "bal_account_no", "region_code", "posting_date") == [
        ("a", Decimal("7.00"), "64160103", "33510102", "REG-MXN", date(2025, 1, 25)),
        ("b", Decimal("3.00"), "33510102", "64160103", "REG-UAE", date(2025, 1, 25))]
    every = accrual.marketplace_gl(detail(spark, rows_in), "2025-01", GlConfig(), RUN, "Advertising", all_stamps=True)
    assert (("a", Decimal("12.01")) in rows(every, "external_document_no", "amount"))
    texts = [r[0] for r in rows(out, "descriptions")]
    assert texts == ["AVC MXN: Booking accrual Advertising expenses at Jan2025", "AVC UAE: Booking revert accrual Advertising expenses at Jan2025"]


def test_december_period_end_day(spark):
    out = accrual.retail_ads_accrual(
        spark.createDataFrame([("WM", "WM 1P", date(2024, 12, 30), "t", "s", Decimal("1.239"), 1), ("WM", "WM 1P", date(2024, 11, 25), "t", "s", Decimal("1"), 1)],
                              "platform string, accname string, report_date date, team string, sku string, spend_usd decimal(18,4), unitssold14d int"),
        "2024-12", RUN, ["WM 1P"], end_day=31)
    assert rows(out, "report_date", "posting_date", "amount_spend") == [(date(2024, 12, 30), date(2024, 12, 31), Decimal("1.24"))]


def test_micros_are_divided_exactly(spark):
    df = spark.createDataFrame([(date(2024, 1, 3), "a", 1999999)], "segments_date date, de_accountid string, metrics_costmicros long")
    assert accrual.search_ads_accrual(df, "2024-01", RUN, {"a": "A"}).first()["ad_cost"] == Decimal("1.999999")


def test_promo_accrual_with_repeated_keys_equals_pairwise_sum(spark):
    schema = """report_date date, promotion_id string, country string, platform string, sale_channel string, platform_prd_id string, invoices_list string, pro_est_adj_usd decimal(18,2),
      pro_est_adj_lc decimal(18,2), invoiced_amt_usd decimal(18,2), invoiced_amt_lc decimal(18,2)"""
    d, one = date(2023, 7, 1), Decimal("1.00")
    spend = [(d, None, "USA", "AMZ", "AVC", "B1", f"i{i}", one, one, Decimal(i), Decimal(i)) for i in (1, 2, 3)] + [(d, "p", "USA", "AMZ", "AVC", "B2", "i9", one, one, None, None)]
    log = [(d, None, "USA", "AMZ", "AVC", "B1", None, Decimal(10 * i), Decimal(i), None, None) for i in (1, 2)] + [(d, "p", "USA", "AMZ", "AVC", "B3", None, Decimal(4), one, None, None)]
    t = {"promo_spend": spark.createDataFrame(spend, schema), "profiles": spark.createDataFrame(
        [("B9", "AMZ", "M"), ("B1", "WM", "M"), ("B1", "AMZ", "M"), ("B1", "X", "other")], "platform_product_id string, platform_short string, pims_company string"),
         "estimate_log": spark.createDataFrame(log, schema).withColumn("run_time", F.lit(datetime(2024, 4, 5)))}
    out = accrual.promo_accrual(t, "2025-01", RUN, ["M"], "2024-04", (date(2023, 6, 1), date(2023, 12, 31)), date(2024, 1, 1))
    assert rows(out, "platform_prd_id", "est_amt_usd", "invoiced_amt_usd", "list_invoice_number", "accrual_usd") == [
        ("B1", Decimal("90.00"), Decimal("12.00"), "i1|i2|i3", Decimal("78.00")), ("B3", Decimal("4.00"), None, None, Decimal("4.00"))]


def test_promo_invoice_log_has_bare_overview_rows(spark):
    t = {
        "promo_info": spark.createDataFrame([("ag1", "PX")], "funding_agreement string, promotion_id string"),
        "promo_overview": spark.createDataFrame([
            ("i1", D, "VENDOR FUNDED", "ag1", "plain", "USD", "USA", Decimal("100.00")), ("i2", D, "straight payment", "ag2", "Merchandising:M7", "USD", "USA", Decimal("40.00")),
            ("i3", D, "VENDOR", None, "VPC x", "USD", "USA", Decimal("9.00")), ("i4", D, "other", None, "x", "USD", "USA", Decimal("1.00"))],
            "invoice_id string, invoice_date date, funding_type string, agreement_id string, agreement_title string, currency string, country string, original_balance decimal(18,2)"),
        "promo_detail": spark.createDataFrame([("i1", D, "VENDOR", D, None, "B1", "USA", "USD", 1, Decimal("30.00")), ("i1", D, "VENDOR", D, "P2", "B2", "USA", "USD", 3, Decimal("30.00")),
                                               ("i5", D, "GUARANTEED", D, None, "B3", "USA", "USD", 1, Decimal("1.00")), ("i6", D, "VENDOR", D, None, "B4", "USA", "USD", 0, Decimal("1.00"))],
            "invoice_number string, invoice_date date, funding_type string, order_date date, promotion_id string, asin string, country string, cost_currency string, quantity int, promotion_cost decimal(18,2)")}
    out = accrual.promo_invoices(t)
    assert rows(out, "invoice_number", "promotion_id", "promotion_cost", "clp_fee", "promo_type") == [
        ("i1", "P2", Decimal("30.00"), Decimal("30.000000"), "Promotions"), ("i1", "PX", Decimal("30.00"), Decimal("10.000000"), "Promotions"),
        ("i2", "M7", Decimal("40.00"), Decimal("0.000000"), "Base Merchandising Fee"), ("i3", "VM Promotion", Decimal("9.00"), None, "Coupon"),
        ("i6", "VM Promotion", Decimal("1.00"), None, None)]


def test_funding_class_order(spark):
    df = spark.createDataFrame([("straight payment", "Vine Merchandising", None), ("Straight Payment", "vine straight_payment", None), ("STRAIGHT PAYMENT", "vine", None),
                                ("straight payment", "x", "AVS - SVS"), ("Vendor damage", "x", None), (None, "x", None)], "f string, t string, k string")
    got = [r[0] for r in df.select(expense.funding_class("f", "t", "k")).collect()]
    assert got == ["Base merchandising fee", "VINE_old", "VINE_new", "AVS_SVS", "Vendor Funded Sales Discount", None]


def test_closing_window():
    assert recon.closing_window(date(2025, 1, 3)) == (date(2024, 11, 25), date(2024, 12, 26))
    assert recon.closing_window(date(2025, 1, 28)) == (date(2024, 11, 25), date(2025, 1, 26))


def test_cent_adjust_only_for_single_item_documents(spark):
    line = spark.createDataFrame([("a", "a", "S123", 1, Decimal("5.00"), Decimal(2)), ("b", "b", "S123", 1, Decimal("5.00"), Decimal(2)), ("c", "c", "S123", 1, Decimal("5.00"), Decimal(2))],
                                 "document_no string, po_number string, no string, n int, unit_price decimal(18,2), quantity decimal(18,0)")
    invoices = spark.createDataFrame([("a", Decimal("10.02")), ("b", Decimal("10.03")), ("c", Decimal("10.02"))], "invoice_num string, amount decimal(18,2)")
    listed = spark.createDataFrame([("a", "S123"), ("b", "S123"), ("c", "S123 | T9")], "invoice_num string, sku_list string")
    assert rows(recon.cent_adjust(line, invoices, listed), "document_no", "unit_price") == [("a", Decimal("5.01")), ("b", Decimal("5.00")), ("c", Decimal("5.00"))]


def test_recon_promo_windows(spark):
    daily = spark.createDataFrame([
        ("x y Promotions z", "REG-MXN", date(2025, 1, 5), Decimal("5.00"), 2), ("x y Promotions z", "REG-JPN", date(2024, 11, 5), Decimal("6.00"), 0),
        ("x y Promotions z", "REG-USA", date(2024, 11, 5), Decimal("7.00"), 2), ("x y Other z", "REG-USA", date(2025, 1, 5), Decimal("8.00"), 2)],
        "descriptions string, region_code string, document_date date, amount decimal(18,2), is_processed int")
    raw = spark.createDataFrame([("Vendor Funded Sales Discount", "MEX", date(2025, 1, 6), Decimal("4.00")), ("Vendor Funded Sales Discount", "JPN", date(2024, 12, 6), Decimal("3.00"))],
                                "funding_type string, country string, invoice_date date, original_balance decimal(18,2)")
    out = recon.recon_promo({"expense_daily": daily, "promo_overview": raw}, date(2025, 1, 28))
    assert rows(out, "year_month", "region_code", "erp_amount", "country", "raw_amount", "recon") == [
        (None, None, None, "JPN", Decimal("3.00"), None), ("2024-11", "REG-JPN", Decimal("6.00"), None, None, None), ("2025-01", "REG-MXN", Decimal("5.00"), "MEX", Decimal("4.00"), Decimal("1.00"))]


def test_warehouse_evidence_ignores_blank_movements(spark):
    moves = [("T", "a", "CRA", D, 1, 1, 1), ("T", "a", "FLO", D, None, 1, 1), ("T", "a", "FLO", D, 1, 1, 0), ("T", "a", "FLO", D, 0, 0, 1), ("U", "a", "FLO", D, 1, 1, 1),
             ("T", "b", "???", D, 1, 1, 1), ("T", "c", "ANA", D, 1, 1, 1), ("T", "c", "BRE", D, 1, 1, 1)]
    t = tables(spark, moves=moves)
    out = si.warehouse_locations(t["transactions"], "T", date(2024, 1, 1))
    assert rows(out) == [("a", "156-3PL-CB"), ("b", c.UNIDENTIFIED), ("c", "156-USA-CA")]


def test_add_in_takes_vat_only_where_asked(spark):
    manual = spark.createDataFrame([("m1", "A", Decimal("5.00"), Decimal("1.00")), ("m2", "B", Decimal("6.00"), None), (None, "C", Decimal("7.00"), None)],
                                   "external_doc_no string, no string, amount decimal(18,2), discount decimal(18,2)")
    posted = spark.createDataFrame([("m2",)], "external_doc_no string")
    header, line = si.add_in(manual, posted, {"source_code": "X", "belong_to_company": F.lit("M")})
    assert rows(header, "external_doc_no", "source_code") == [(None, "X"), ("m1", "X")]
    assert rows(line, "document_no", "amount", "vat_amount") == [(None, Decimal("7.00"), None), ("m1", Decimal("5.00"), None)]
    _, line = si.add_in(manual, posted, {}, vat_from="discount")
    assert rows(line, "document_no", "vat_amount") == [(None, None), ("m1", Decimal("1.000000"))]


def test_daily_documents_do_not_double(spark):
    cand = snapshot(spark, [("d", "M", "A", Decimal("1.00"), D, "x", "T")])
    cfg = ChannelConfig(channels=["T"], own=["M"], date_from=date(2024, 1, 1))
    once = si.run_channel(cand, tables(spark), cfg, AS_OF)
    header, line = si.daily_documents([once, once])
    assert header.count() == 1 and line.count() == 1


def test_daily_documents_move_only_what_is_shown(spark, capsys):
    cand = snapshot(spark, [("d", "M", "A", Decimal("1.00"), D, "x", "T"), ("e", "Bitis", "B", Decimal("2.00"), D, "y", "T"), ("f", "HMD", None, None, D, None, "T"),
                            ("gone", "M", "A", Decimal("3.00"), D, "x", "T")])
    # lines that differ in what is not shown are one
    cand = cand.withColumn("description", F.lit("one")).union(cand.withColumn("description", F.lit("other")))
    t, shown = tables(spark, excluded=["gone"]), ["document_no", "line_no", "type", "no", "amount", "location_code", "posting_date", "location", "header_country", "name"]
    whole = si.document_lines(*si.daily_documents([si.run_channel(cand, t, CFG, AS_OF)])).select(*shown)
    runs = [si.run_channel(cand, t, CFG, AS_OF, shown=shown)] * 2
    cut = si.document_lines(*si.daily_documents(runs, shown)).select(*shown)
    assert whole.count() == 8 and rows(cut) == rows(whole.distinct()) and cut.count() == 4
    cut.explain()
    plan = capsys.readouterr().out
    assert "description" not in plan.replace("posting_description", "") and "vat_amount" not in plan and "order_date" not in plan.split("Union")[0]


def test_rows_of_a_load_move_once_to_be_numbered_and_matched(spark, tmp_path, capsys):
    """What is posted, shipped and placed is asked for the keys of documents, not for their rows."""
    lines = [(f"d{i % 8}", "M" if i % 3 else "HMD", D, f"p{i % 8}", i) for i in range(40)] + [(None, "M", D, "p9", 40), (None, "HMD", D, "p3", 41), (None, "M", date(2023, 1, 1), "p9", 42)]
    df = spark.createDataFrame(lines, "external_doc_no string, belong_to_company string, order_date date, po_number string, no int")
    cand = si.as_candidates(df.withColumn("original_external_doc_no", F.col("po_number")), {
        "internal_sales_channel": "T", "wh_location": c.UNIDENTIFIED, "country": "REG-USA", "sales_channel": "CHAN-AVC", "bill_to_customer": "CUST"}, ["no"], RUN, placed=True)
    log = snapshot_append(cand, str(tmp_path / "log"), RUN, within=["internal_sales_channel"])
    t = tables(spark, [("d1", "p1", "Order", "T"), ("d5", "p5", "Return", "T")], ["d6"], [("T", "p7", "CRA", D, 1, 1, 1), ("T", "p9", "FLO", D, 1, 1, 1)])
    for key, posted in (("po_number", "external_doc_no"), ("original_external_doc_no", "external_doc_no"), ("po_number", "original_external_doc_no")):
        cfg = ChannelConfig(channels=["T"], own=["M"], main="M", date_from=date(2024, 1, 1), po_exclusion=True, evidence="T", evidence_key=key, posted_key=posted,
                            use_excluded=posted == "external_doc_no", obh_stock=lambda: F.lit(True))
        plain = si.numbered_load(log).drop("load_stamp")
        got, want = si.run_channel(None, t, cfg, AS_OF, snapshot_log=log), si.run_channel(plain, t, cfg, AS_OF)
        for a, b in zip(got, want):
            assert a.count() > 10 and rows(a) == rows(b)
    places = si.warehouse_locations(t["transactions"], "T", D)
    placed = si.by_slice(log)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        si.stage(si.first_numbers(placed), t, cfg, AS_OF, places, placed).explain("formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [part for part in capsys.readouterr().out.split("\n\n") if "Exchange\n" in part and "bill_to_customer" in part]
    assert len(moved) == 1


def test_presets_have_the_channels_rules():
    own, since = ["M"], date(2024, 1, 1)
    made = [c.settlement_channel(own, since), c.dropship_channel(own, since), c.basecost_channel(own, since),
            c.direct_fulfil_channel(own, since, "M"), c.payment_channel(own, since), c.vendor_channel(own, since)]
    assert [m.evidence for m in made] == ["WM MKP", "WM DSV", "WF DS", "AVC DS", "ASC FBM", None]
    assert made[3].posted_key == "original_external_doc_no" and made[5].posted_types == ("ORDER", "ACCRUAL")


def test_booked_only_rows_on_request(spark):
    source = spark.createDataFrame([("a", 1.0)], "source_doc string, source_amount double")
    booked = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "booked_doc string, booked_amount double")
    assert recon.recon_documents(source, booked).count() == 0
    assert rows(recon.recon_documents(source, booked, booked_only=True), "source_doc", "booked_doc") == [(None, "b")]


def test_placed_log_numbers_documents_over_slices_and_channels(spark, tmp_path):
    """One write: the log itself. Numbers match a window over all candidates, also where a document lies in several slices and channels."""
    raw = spark.createDataFrame([(f"d{i % 3}" if i % 5 else "hot", f"sku{i % 7}", i % 11, "A" if i % 4 else "B", "M" if i % 6 else None) for i in range(400)],
                                "external_doc_no string, asin string, quantity int, internal_sales_channel string, belong_to_company string").repartition(5)
    raw = raw.unionByName(raw.where("external_doc_no = 'hot'"))
    args = ({}, ["asin", "quantity"], datetime(2025, 1, 20))
    path = str(tmp_path / "log")
    log = snapshot_append(si.as_candidates(raw, *args, placed=True), path, datetime(2025, 1, 20), within=["internal_sales_channel"])
    slices = log.where("external_doc_no = 'hot'").select(F.shiftright("log_place", 33)).distinct().count()
    assert slices > 1
    cols = ["external_doc_no", "asin", "quantity", "line_no"]
    window = Window.partitionBy("external_doc_no").orderBy("asin", "quantity")
    want = raw.withColumn("line_no", F.row_number().over(window) * 10000).withColumn("quantity", F.col("quantity").cast("decimal(18,6)"))
    assert rows(si.numbered_load(log), *cols) == rows(want, *cols)
    # a second write under the same stamp is numbered by itself
    other = raw.withColumn("internal_sales_channel", F.lit("C"))
    log = snapshot_append(si.as_candidates(other, *args, placed=True), path, datetime(2025, 1, 20), within=["internal_sales_channel"])
    assert rows(si.numbered_load(log).where("internal_sales_channel = 'C'"), *cols) == rows(want, *cols)
    assert rows(si.numbered_load(log).where("internal_sales_channel <> 'C'"), *cols) == rows(want, *cols)


def test_estimate_reads_the_lines_once(spark, tmp_path):
    day = date(2024, 4, 10)
    heads = [("D1", "Order", "AVC WH", "131US", 1), ("D2_Return", "Sales Return", "AVC WH", "131US", 1), ("D3", "Order", "AVC WH", "136INTC", 1), ("D4", "Order", "AVC WH", "131US", 0),
             ("D5", None, "AVC WH", "131US", 1)]
    header = spark.createDataFrame([(d, day, day, "REG-USA", "USD", "CHAN-AVC", chan, flag, "CO1", "Booking revenue", bill, kind, "MAIN") for d, kind, chan, bill, flag in heads],
        "external_doc_no string, posting_date date, document_date date, country string, currency string, sales_channel string, internal_sales_channel string, is_processed int, "
        "original_company_id string, posting_description string, bill_to_customer string, document_type string, belong_to_company string")
    lines = [(d, po, "1001", Decimal("2.00"), 3, Decimal("6.00"), "REG-DEU", "CHAN-AVC", "PLF") for d, po in (
        ("D1", "P1"), ("D2_Return", "P1"), ("D2_Return", "P2"), ("D2_Return", "DROPSHIP-1"), ("D2_Return", None), ("D3", "P1"), ("D4", "P1"), ("D5", "P1"))]
    spark.createDataFrame(lines, "document_no string, po_number string, no string, unit_price decimal(18,2), quantity int, amount decimal(18,2), country string, sales_channel string, "
                          "platform string").write.parquet(f"{tmp_path}/lines")
    # P1 is of two vendors, which doubles its returns and not its sales; P2 is a GPE order, which has no estimates
    orders = spark.createDataFrame([("P1", "VENA"), ("P1", "VENX"), ("P2", "VENG")], "po_id string, vendor string")
    out = accrual.estimate_base({"posted_header": header, "posted_line": spark.read.parquet(f"{tmp_path}/lines"), "purchase_orders": orders}, date(2024, 5, 20), (), "MAIN", ["VENA"], ["VENG"])
    assert rows(out, "document_no", "po_number", "country", "internal_sales_channel", "amount", "type") == sorted([
        ("D1", "P1", "REG-USA", "AVC WH", Decimal("6.00"), "SI Actual"), ("D2_Return", "P1", "REG-DEU", "AVC WH", Decimal("-6.00"), "SRT Actual"),
        ("D2_Return", "P1", "REG-DEU", "AVC DI", Decimal("-6.00"), "SRT Actual"), ("D2_Return", "DROPSHIP-1", "REG-DEU", "AVC DS", Decimal("-6.00"), "SRT Actual"),
        ("D2_Return", None, "REG-DEU", "AVC WH", Decimal("-6.00"), "SRT Actual")], key=lambda r: tuple((v is not None, str(v)) for v in r))
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1


def test_shipments_are_placed_once_for_headers_and_lines(spark):
    ships = spark.createDataFrame([("S1", "7", "P1", date(2024, 1, 1), "Fontana")], "shipment_id string, reference_id string, purchase_order string, run_date date, ship_from_city string")
    header = conform(spark.createDataFrame([("P1_7", "MAIN", "AVC WH", "x"), ("P2_7", "MAIN", "AVC WH", "x")], "external_doc_no string, belong_to_company string, internal_sales_channel string, location string"), HEADER)
    line = conform(spark.createDataFrame([("P1_7", "x")], "document_no string, location_code string"), LINE)
    header, line = si.apply_shipments(header, line, ships, ("MAIN",))
    for df in (header, line):
        assert "Window" not in df._jdf.queryExecution().executedPlan().toString()
    assert rows(header, "external_doc_no", "location") == [("P1_7", "156-3PL-FT"), ("P2_7", "x")]
    assert rows(line, "document_no", "location_code") == [("P1_7", "156-3PL-FT")]


def test_lines_meet_shipments_and_imports_at_once(spark, capsys):
    ships = spark.createDataFrame([("S1", "7", "P1,P2,P4", date(2024, 1, 1), "Fontana")], "shipment_id string, reference_id string, purchase_order string, run_date date, ship_from_city string")
    heads = [("P1_7", "MAIN", "AVC WH"), ("P2_7", "HMD", "AVC DI"), ("P3_7", "HMD", "AVC DI"), ("P5_7", "HMD", "AVC WH"), (None, "HMD", "AVC DI")]
    header = conform(spark.createDataFrame([(*h, "x") for h in heads], "external_doc_no string, belong_to_company string, internal_sales_channel string, location string"), HEADER)
    line = conform(spark.createDataFrame([(d, "x") for d in ("P1_7", "P2_7", "P3_7", "P4_7", "P5_7", None)], "document_no string, location_code string"), LINE)
    stages = spark.conf.get("spark.checkpoint.dir")
    known = lambda name: sum(f.startswith(f"{name}-") for f in os.listdir(stages))
    before = known("headers"), known("lines")
    header, line = si.apply_shipments(header, line, ships, ("MAIN",))
    assert (known("headers"), known("lines")) == (before[0] + 1, before[1] + 1)
    assert rows(header, "external_doc_no", "location") == [
        (None, c.OBH_IMPORT_LOCATION), ("P1_7", "156-3PL-FT"), ("P2_7", c.OBH_IMPORT_LOCATION), ("P3_7", c.OBH_IMPORT_LOCATION), ("P5_7", "x")]
    assert rows(line, "document_no", "location_code") == [
        (None, "x"), ("P1_7", "156-3PL-FT"), ("P2_7", c.OBH_IMPORT_LOCATION), ("P3_7", c.OBH_IMPORT_LOCATION), ("P4_7", "156-3PL-FT"), ("P5_7", "x")]


def test_owners_are_written_so_that_joins_know_their_size(spark):
    items = spark.createDataFrame([("0001", "CO1", "MAIN", "G"), ("0001", "CO1", "MAIN", "G"), ("0002", "CO2", "HMD", "G")],
                                  "item_id string, original_company_id string, belong_to_company string, customer_posting_group string")
    owners = si.item_owners(items, "CO1")
    assert rows(owners) == [("0001", "MAIN", "G")]
    assert "Aggregate" not in owners._jdf.queryExecution().executedPlan().toString()


def test_each_side_of_a_comparison_is_written_before_they_meet(spark):
    source = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("c", 1)], "source_doc string, amount int").groupBy("source_doc").agg(F.sum("amount").alias("source_amount"))
    booked = spark.createDataFrame([("a", 2), ("b", 5), ("d", 1)], "booked_doc string, amount int").groupBy("booked_doc").agg(F.sum("amount").alias("booked_amount"))
    out = recon.recon_documents(source, booked)
    assert rows(out) == [("b", 1, "b", 5), ("c", 1, None, None)]
    assert "Aggregate" not in out._jdf.queryExecution().executedPlan().toString()


def test_promotions_of_a_line_stay_in_one_row_until_it_is_numbered(spark, tmp_path):
    """The log has a row per line of an order, not one per promotion; numbers and amounts are those of all rows sorted together."""
    at = lambda day: datetime(2025, 1, day)
    lines = [("p1", "1", at(5), "0001-a", "Shipped", 2.0, Decimal("9.00")), ("p1", "2", at(5), "0001-b", "Shipped", 1.0, Decimal("9.00")),
             ("p1", "3", at(5), "0009-c", "Shipped", 3.0, Decimal("4.00")), ("p2", "1", at(19), "0001-a", "Shipped", 1.0, Decimal("9.00")),
             # one line twice, on two days: its amounts are numbered mixed
             ("p3", "1", at(5), "0001-a", "Shipped", 1.0, Decimal("9.00")), ("p3", "1", at(6), "0001-a", "Shipped", 1.0, Decimal("9.00"))]
    run = date(2025, 1, 1)
    t = {"order_lines": spark.createDataFrame(lines, "purchase_order_id string, order_line_id string, order_date timestamp, item_sku string, order_line_status string, "
                                              "order_line_quantity_amount double, unit_cost_by_logic decimal(18,2)"),
         "catalogue": spark.createDataFrame([("0001", i, None, "DSV", "PUBLISHED", run) for i in ("15", "27", "31")],
                                            "supplier_stock_id string, item_id string, product_gtin string, fulfillment_method string, site_status string, run_date date"),
         # 5 and 7 lie in the text of the list, 88 does not; 31 is over
         "promo_log": spark.createDataFrame([("5", Decimal("3.00"), at(1), at(9), at(1)), ("7", Decimal("2.00"), at(1), at(9), at(1)), ("15", Decimal("1.00"), at(1), at(9), at(1)),
                                             ("88", Decimal("0.50"), at(1), at(9), at(1)), ("31", Decimal("0.25"), at(1), at(2), at(1))],
                                            "item_id string, current_cost decimal(18,2), promo_start_1 timestamp, promo_end_1 timestamp, data_updated_time timestamp"),
         "promo_sheet": spark.createDataFrame([("none", Decimal("1.00"), run, run, at(1))], "sku_supplier_stock_id string, funding_amount decimal(18,2), promo_start_1 date, promo_end_1 date, run_time timestamp"),
         "companies": spark.createDataFrame([("CO1", "cid")], "company_code string, company_id string"),
         "posted_header": spark.createDataFrame([("old", "Order", "WM DSV")], "original_external_doc_no string, document_type string, internal_sales_channel string")}
    args = (t, AS_OF, RUN, date(2024, 1, 1), "M", "CO1", date(2024, 1, 1))
    cand = si.dropship_candidates(*args, placed=True)
    log = snapshot_append(cand, str(tmp_path / "log"), RUN, within=["internal_sales_channel"])
    assert log.where("external_doc_no <> 'p3'").count() == 4
    cols = ["external_doc_no", "asin", "line_no", "amount"]
    sums = {("p1", "0001-a"): [2, 4, 6], ("p1", "0001-b"): [1, 2, 3], ("p1", "0009-c"): [12], ("p2", "0001-a"): [9], ("p3", "0001-a"): [1, 1, 2, 2, 3, 3]}
    want, number = [], {}
    for (doc, sku), amounts in sums.items():
        for amount in amounts:
            number[doc] = number.get(doc, 0) + 10000
            want.append((doc, sku, number[doc], Decimal(f"{amount}.00")))
    assert rows(si.numbered_load(log), *cols) == sorted(want)
    assert rows(si.dropship_candidates(*args), *cols) == sorted(want)
    cfg = ChannelConfig(channels=["WM DSV"], own=["M"], main="M", date_from=date(2024, 1, 1), evidence=None, dedupe_owners=False)
    header, line = si.run_channel(None, tables(spark), cfg, AS_OF, snapshot_log=log)
    assert rows(line, "document_no", "original_asin_sku", "line_no", "amount") == sorted(want)
    assert rows(header, "external_doc_no") == [("p1",), ("p2",), ("p3",), ("p3",)]


def test_accrual_totals_gather_no_lists_and_read_the_detail_once(spark, capsys):
    schema = ("report_date date, promotion_id string, country string, platform string, sale_channel string, platform_prd_id string, invoices_list string, pro_est_adj_usd decimal(18,2), "
              "pro_est_adj_lc decimal(18,2), invoiced_amt_usd decimal(18,2), invoiced_amt_lc decimal(18,2)")
    row = lambda day, n: (day, "p", "USA", "AMZ", "AVC", "b", f"i{n}", Decimal(n), Decimal(n), Decimal(1), Decimal(1))
    log = spark.createDataFrame([row(date(2024, 1, 5), 5), row(date(2024, 1, 6), 7)], schema).withColumn("run_time", F.lit(RUN))
    t = {"estimate_log": log, "promo_spend": spark.createDataFrame([row(date(2023, 7, 1), 3)], schema),
         "profiles": spark.createDataFrame([("b", "AMZ", "M")], "platform_product_id string, platform_short string, pims_company string")}
    detail = accrual.promo_accrual(t, "2025-01", RUN, ["M"], "2024-04", (date(2023, 6, 1), date(2023, 12, 31)), date(2024, 1, 1))
    plan = lambda df: (df.explain(), capsys.readouterr().out)[1]
    assert "collect_" in plan(detail) and "collect_" not in plan(detail.select("country", "accrual_usd"))
    out = accrual.marketplace_gl(detail, "2025-01", GlConfig(), RUN, "Promotion")
    assert "accrued-" in plan(out) and "pro_est_adj_usd" not in plan(out)
    assert rows(out, "external_document_no", "amount") == [("PROMOACRAMZUSA202501", Decimal("10.00"))]
    # branches that share a month may give one row twice, which is one row
    shared = accrual.promo_accrual(t, "2025-01", RUN, ["M"], "2025-01", (date(2024, 1, 1), date(2024, 1, 9)), date(2024, 1, 1))
    assert shared.count() == shared.distinct().count()


def test_open_documents_are_gathered_once_and_sorted_from_a_written_result(spark, capsys):
    t = {"daily_header": spark.createDataFrame([("d1", "o1", "Unidentified", "WM WFS"), ("d2", "o2", "156-USA-CA", "WM WFS")],
                                               "external_doc_no string, original_external_doc_no string, location string, internal_sales_channel string"),
         "daily_line": spark.createDataFrame([("d1", "b", "L"), ("d1", "a", "L"), ("d2", "c", "L")], "document_no string, no string, location_code string"),
         "settlements": spark.createDataFrame([("o1", "p1"), ("o1", "p1")], "order_id string, po_id string"),
         "transactions": spark.createDataFrame([("p1", "W2", 7), ("p1", "W1", 7), ("p9", "W9", 1)], "transaction_id string, warehouse string, ims_id int")}
    out = recon.unidentified_location(t)
    out.explain()
    plan = capsys.readouterr().out
    assert "unidentified-" in plan and "Join" not in plan
    assert rows(out, "invoice_number", "sku", "location", "sales_channel", "warehouse", "ims_id") == [("o1", "a,b", "L", "WM MKP", "W1,W2", "7")]


PROMO = {
    "promo_stream": ("invoice_number string, transaction_type string", []),
    "promo_info": ("funding_agreement string, promotion_id string", [("ag1", "PX"), ("ag1", "PY")]),
    "clip_fees": ("invoice_number string, total_clip_fee decimal(18,2)", [("i1", Decimal("4.00")), ("i1", Decimal("4.00"))]),
    "promo_overview": ("invoice_id string, invoice_date date, funding_type string, agreement_id string, agreement_title string, currency string, country string, original_balance decimal(18,2)", [
        ("i1", D, "VENDOR", "ag1", "plain", "USD", "USA", Decimal("100.00")), ("i2", D, "straight payment", None, "Merchandising:M7", "USD", "USA", Decimal("40.00")),
        ("i3", D, "straight payment", None, "Merchandising:M8", "USD", "USA", Decimal("50.00")), (None, D, "VENDOR", "ag1", "plain", "USD", "USA", Decimal("1.00"))]),
    # i4 is in no overview, one invoice has no number, i5 is booked
    "promo_detail": ("invoice_number string, invoice_date date, funding_type string, order_date date, ship_date date, promotion_id string, asin string, country string, quantity int, promotion_cost decimal(18,2)", [
        ("i1", D, "x", D, None, None, "B1", "USA", 1, Decimal("30.00")), ("i1", D, "x", D, None, "P2", "B2", "USA", 3, Decimal("30.00")), ("i4", D, "x", D, None, "P3", "B2", "USA", 1, Decimal("7.00")),
        (None, D, "x", D, None, "P4", "B1", "USA", 2, Decimal("5.00")), ("i5", D, "x", D, None, "P5", "B1", "USA", 2, Decimal("5.00")), ("i1", date(2000, 1, 1), "x", D, None, "old", "B1", "USA", 4, Decimal("1.00"))])}


def promo_tables(spark):
    return {name: spark.createDataFrame(data, schema) for name, (schema, data) in PROMO.items()}


def test_promo_invoices_leave_booked_ones_out_before_the_lines(spark):
    t, cols = promo_tables(spark), ["invoice_number", "sub_funding_type", "booked_type", "promotion_id", "quantity", "total_quantity", "clp_fee", "cop_fee_by_sku"]
    listed = lambda *names: (spark.createDataFrame([(n,) for n in names], "k string"), "k")
    whole = expense.promo_invoice_by_sku(t, date(2024, 1, 1))
    vendor, fee = "Vendor Funded Sales Discount", "Base merchandising fee"
    i1 = [("i1", vendor, "Portal", p, q, 8, Decimal("8.00"), Decimal(c)) for p in ("PX", "PY") for q, c in ((1, "31.00"), (3, "33.00"))]
    every = [*i1, ("i4", None, "Portal", "P3", 1, 1, None, None), ("i5", None, "Portal", "P5", 2, 2, None, None), (None, None, "Portal", "P4", 2, None, None, None),
             ("i2", fee, fee, "M7", None, None, None, Decimal("40.00")), ("i3", fee, fee, "M8", None, None, None, Decimal("50.00"))]
    order = lambda rows_: sorted(rows_, key=lambda r: tuple((v is not None, str(v)) for v in r))
    assert rows(whole, *cols) == order(every)
    without = lambda *gone: order([r for r in every if r[0] not in gone])
    assert rows(expense.promo_invoice_by_sku(t, date(2024, 1, 1), [listed("i5"), listed("i3")]), *cols) == without("i5", "i3", None)
    # a null in a list empties the result, an empty list leaves even what has no number
    assert rows(expense.promo_invoice_by_sku(t, date(2024, 1, 1), [listed("i5", None)]), *cols) == []
    assert rows(expense.promo_invoice_by_sku(t, date(2024, 1, 1), [listed()]), *cols) == order(every)


def test_gl_log_joins_ranks_and_accounts_once(spark):
    lit = lambda schema, *data: spark.createDataFrame(list(data), schema)
    ads = lambda no, company, amount: (no, D, "acc", "USA", "USD", company, Decimal(amount), "AVC", "Amazon", "Shop", "CO1")
    booked = [(lit("k string", ("i5",)), "k"), (lit("k string", ("i3",)), "k")]
    t = promo_tables(spark) | {
        "old_invoices": lit("original_invoice string", ("i5",)), "withdrawn": lit("invoice_id string", ("i3",)),
        "profiles": lit("platform string, platform_prd_id string, country string, pims_company string", ("Amazon", "B1", "USA", "HMD"), ("Amazon", "B2", "USA", None)),
        "dimensions": lit("db string, erp string", ("USA", "REG-USA"), ("Amazon", "PLF-AMZ-1"), ("AVC", "CHAN-AVC")),
        "items": lit("company_id string, original_company_id string", ("cid", "CO1")),
        "journals": lit("id string, code string, company_id string, displayname string", ("J-USD", "USD-DATA", "cid", "batch")),
        "ads_detail": lit("invoice_number string, invoice_date date, acc_id string, country string, currency string, company string, invoice_amount decimal(18,2), channel string, platform string, "
                          "account_name string, original_company_id string", ads("a1", "M", "9.00"), ads("a2", "HMD", "3.00"), ads("a3", "Bitis", "2.00"))}
    account = lambda company, kind, no, name: (company, kind, no, name, "g", "Vendor", "V", "USD", "CHAN-AVC", "REG-USA", "PLF-AMZ-1", "CO1" if company != "OBH" else "else", no)
    t["gl_accounts"] = lit(", ".join(f"{name} string" for name in expense.ACCOUNT), account("M", "G/L Account", "1", "Selling exp_Promotions"), account("M", "G/L Account", "2", "Selling exp_Marketing"),
                           account("HMD", "G/L Account", "3", "any"), account("HMD", "G/L Account", "4", "other"), account("OBH", "Vendor", "5", "contra"))
    cfg = GlConfig(original_company_id="CO1", obh_journal_id="J-OBH")
    cols = ["document_no", "external_document_no", "original_invoice_company", "account_type", "account_no", "amount", "journal_id", "descriptions"]
    want = []
    def line(rank, no, company, kind, account_no, amount, text):
        own = company == "M"
        want.append((f"GJNLGEN2501{10000 + rank}", no, f"{no}_{company}", kind, account_no, Decimal(amount), "J-USD" if own else "J-OBH",
                     f"{'' if own else 'OBH-'}CHAN-AVC-USA: {text}, Inv# {no}_{company}_JAN2025"))
    ads_text, promo_text, gl = "Selling exp_Marketing", "Booking Promotions exps", "G/L Account"
    line(1, "a1", "M", gl, "2", "9.00", ads_text)
    for no in ("3", "4"):
        line(2, "a2", "HMD", gl, no, "3.00", ads_text)
        line(4, "i1", "HMD", gl, no, "62.00", promo_text)
    line(2, "a2", "HMD", "Vendor", "5", "-3.00", ads_text)
    line(3, "a3", "Bitis", gl, None, "2.00", ads_text)
    line(3, "a3", "Bitis", "Vendor", "5", "-2.00", ads_text)
    line(4, "i1", "HMD", "Vendor", "5", "-62.00", promo_text)
    line(5, "i1", "M", gl, "1", "66.00", promo_text)
    line(6, "i2", "M", gl, "1", "40.00", promo_text)
    for unbooked in (False, True):
        t["promo_by_sku"] = expense.promo_invoice_by_sku(t, date(2024, 1, 1), booked if unbooked else ())
        out = expense.gl_format_log(t, cfg, "M", ["M"], date(2025, 1, 20), RUN, unbooked=unbooked)
        found = out.where("external_document_no <> 'i4'")
        assert rows(found, *cols) == sorted(want, key=lambda r: tuple((v is not None, str(v)) for v in r))
        joins = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in line]
        assert [sum(name in line for line in joins) for name in ("_rank_key", "rule_currency_code")] == [1, 1]


def test_promotions_and_advertising_are_written_one_after_the_other(spark, monkeypatch):
    made = lambda n: spark.range(n).select(*[F.lit("x").alias(name) for name in expense.RANKED])
    written = []

    def write(df, name="stage", path=None):
        written.append((name, df.count()))
        return df

    def rank(rows, *args):
        raise StopIteration(rows.count())

    for name, stub in {"_promotions": lambda *a: made(2), "_advertising": lambda *a: made(3), "cut_lineage": write, "dense_rank_global": rank}.items():
        monkeypatch.setattr(expense, name, stub)
    with pytest.raises(StopIteration) as ranked:
        expense.gl_format_log({}, GlConfig(), "M", ["M"], AS_OF, RUN)
    assert ranked.value.value == 5 and written == [("ranked", 2), ("ranked", 3)]


def test_day_text_from_year_and_month(spark):
    days = spark.createDataFrame([(date(y, m, 7),) for y in (1, 99, 2000, 2025, 9999) for m in range(1, 13)] + [(None,)], "d date")
    days = days.union(spark.sql("select date_add(date '9999-12-31', 1)"))
    for pattern in ("YY", "MM", "MONYYYY"):
        assert days.where(~expense._day_text("d", pattern).eqNullSafe(expense.date_text("d", pattern))).count() == 0
