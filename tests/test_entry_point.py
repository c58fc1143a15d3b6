"""The deployment path: base tables as Parquet folders, one report day,
the original's own codes."""

import tempfile

import helpers as H
from shelfaudit.config import REFERENCE_CODES as R
from shelfaudit.functions.period import period_bounds
from shelfaudit.plans.report import run_audit_report
from shelfaudit.sources.tables import AuditTables

DAY = "2016-08-29"


def test_run_audit_report_from_parquet(spark):
    root = tempfile.mkdtemp(prefix="audit-tables-")
    d = DAY + " 10:00:00"
    orders = H.orders(spark, [
        (1, 11, d, 10, R.doc_stock), (1, 12, d, 10, R.doc_extra_places), (1, 13, d, 10, R.doc_promo),
        (1, 14, d, 10, R.doc_order_info), (1, 15, d, 10, R.doc_main_places),
        (1, 16, "2016-08-30 00:00:00", 10, R.doc_stock),     # next day: outside the report
        (2, 17, d, 99, R.doc_stock),                          # outlet never visited
    ])
    shelf = R.main_places["shelf"]
    attrs = H.attrs(spark, [
        (1, 11, 501, 1, R.attr_facing, "4", 1, d), (1, 11, 501, 1, R.attr_store, "2.5", 1, d),
        (1, 11, shelf, 1, R.attr_shelf, "1", 1, d),
        (1, 12, 601, 1, R.extra_places["racks"], "yes", 1, d),
        (1, 12, R.extra_places["racks"], 1, R.extra_places["racks"], "rack", 1, d),
        (1, 13, R.promo_actions["price_cut"], 1, R.promo_actions["price_cut"], "10.5", 1, d),
        (1, 14, 1, 1, R.attr_order_info, "deliver friday", 1, d),
        (1, 15, shelf, 1, 1, "on shelf", 1, d),
        (1, 16, 502, 1, R.attr_facing, "9", 1, d),
        (2, 17, 503, 1, R.attr_facing, "9", 1, d),
    ])
    visits = H.visits(spark, [(1, 10, DAY + " 09:00:00"), (2, 98, DAY + " 09:00:00")])
    items = spark.createDataFrame([(501, "Product A"), (shelf, "Shelf SKU"), (R.extra_places["racks"], "Rack SKU")],
                                  "iid long, iname string")
    faces = spark.createDataFrame([(10, "Outlet", "10", 7, 1, None)],
                                  "fid long, fname string, exid string, ftype int, ownerdistid int, faddress string")
    objattrs = spark.createDataFrame([], "id long, dictid int, attrid int, attrtext string, activeflag int")
    comments = spark.createDataFrame([], "fid long, vdate timestamp_ntz, comment string")
    att = spark.createDataFrame([], "masterfid int, docid long, fileid long, filedata binary")
    for name, df in (("orders", orders), ("order_attributes", attrs), ("object_attributes", objattrs),
                     ("items", items), ("visits", visits), ("faces", faces), ("visit_comments", comments),
                     ("attachments", att)):
        df.write.parquet(f"{root}/{name}")
    tables = AuditTables.from_parquet(spark, root)
    out = run_audit_report(spark, tables, R, period_bounds(DAY))
    rows = sorted(((r.item613_name or "", r.facing, r.store_qty, r.total_qty, r.order_info, r.shelf,
                    r.item612_name, r.racks_612, r.price_cut_611) for r in out.collect()), key=repr)
    # 613 products {501, shelf} x 612 products {601, racks id} x 611 products {price-cut id}
    assert len(rows) == 4
    assert {r[0] for r in rows} == {"Product A", "Shelf SKU"}
    a = [r for r in rows if r[0] == "Product A"]
    assert {(r[1], r[2], r[3]) for r in a} == {("4", "2.5", 6.5)}
    assert {r[4] for r in rows} == {"deliver friday"}
    assert {r[5] for r in rows if r[0] == "Shelf SKU"} == {"on shelf"}
    assert {r[7] for r in rows if r[6] == "Rack SKU"} == {"rack"}
    assert {r[8] for r in rows} == {"10,5"}



def test_run_full_report_from_parquet(spark):
    from shelfaudit.plans.full_report import report_columns, run_full_report

    root = tempfile.mkdtemp(prefix="audit-full-")
    d = DAY + " 10:00:00"
    orders = H.orders(spark, [(1, 100, d, 10, R.doc_stock_check), (1, 101, d, 10, R.doc_extra_places)])
    attrs = H.attrs(spark, [(1, 100, 501, 1, R.facing_attrs[0], "1", 1, d),
                            (1, 101, 555, 1, R.extra_places["racks"], "r1", 1, d)])
    visits = H.visits(spark, [(1, 10, DAY + " 09:00:00")])
    items = spark.createDataFrame([(501, "СКИТ item"), (555, "rack item")], "iid long, iname string")
    faces = spark.createDataFrame([(10, "Outlet", "10", 7, 1, "г. Тверь, ул. Мира, д. 3"), (1, "Agent", "1", 1, 1, None)],
                                  "fid long, fname string, exid string, ftype int, ownerdistid int, faddress string")
    objattrs = spark.createDataFrame([(10, 2, R.obj_banner_attr, "B", 1)],
                                     "id long, dictid int, attrid int, attrtext string, activeflag int")
    comments = spark.createDataFrame([], "fid long, vdate timestamp_ntz, comment string")
    att = spark.createDataFrame([], "masterfid int, docid long, fileid long, filedata binary")
    for name, df in (("orders", orders), ("order_attributes", attrs), ("object_attributes", objattrs),
                     ("items", items), ("visits", visits), ("faces", faces), ("visit_comments", comments),
                     ("attachments", att)):
        df.write.parquet(f"{root}/{name}")
    out = run_full_report(spark, AuditTables.from_parquet(spark, root), R, period_bounds(DAY))
    assert out.columns == report_columns(R)
    rows = out.collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.employee_name, r.supervisor_name, r.city, r.banner) == ("Outlet", "Agent", "Тверь", "B")
    assert (r.item_name, r.facing, r.racks_612, r.item612_name) == ("СКИТ item", "1", "r1", "rack item")


def test_line_blocks_prune_partitions(spark):
    from pyspark.sql import functions as F

    from shelfaudit.plans.facts import facts_from_heads, id_filter, id_range

    root = tempfile.mkdtemp(prefix="lines-") + "/order_attributes"
    d = DAY + " 10:00:00"
    attrs = H.attrs(spark, [(1, o, 1, 1, 0, "x", 1, d) for o in (5, 1_500_000, 2_500_000, 3_700_000)])
    attrs = attrs.unionByName(H.attrs(spark, [(1, o, 1, 1, 0, "x", 1, d) for o in (-900_000, -100_000)]))
    attrs.withColumn("orid_block", F.floor(F.col("orid") / 1_000_000)).write.partitionBy("orid_block").parquet(root)
    lines = spark.read.parquet(root)
    heads = H.orders(spark, [(1, 2_500_000, d, 10, 613)]).select("masterfid", "mfid", "orid", "ortype", "ordate")
    block = ("orid_block", 1_000_000)
    out = facts_from_heads(heads, lines, id_range(heads), block)
    assert [r.orid for r in out.collect()] == [2_500_000]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(orid_block" in plan and "orid_block#" in plan
    for ids in ((-900_000, -100_000), (-500_000, 5), (5, 2_500_000)):
        assert id_filter(lines, *ids, block).count() == id_filter(lines, *ids).count() > 0
    # a column of that name means nothing unless the layout is stated
    plan = facts_from_heads(heads, lines, id_range(heads))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(orid_block" not in plan


def test_a_day_column_is_no_layout_unless_stated(spark):
    from shelfaudit.functions.period import period_filter

    df = spark.createDataFrame([("2016-08-29 01:00:00", "2016-08-28")], "a string, b string").selectExpr(
        "cast(a as timestamp_ntz) as ordate", "cast(b as date) as ordate_day")
    assert period_filter(df, "ordate", period_bounds(DAY)).count() == 1
    assert period_filter(df, "ordate", period_bounds(DAY), day_col="ordate_day").count() == 0


def test_day_partitions_prune_document_extract(spark):
    from pyspark.sql import functions as F

    from shelfaudit.plans.extract import document_filter, extract_documents

    root = tempfile.mkdtemp(prefix="parts-")
    orders = H.orders(spark, [(1, 1, DAY + " 10:00:00", 10, R.doc_promo), (1, 2, "2016-08-30 10:00:00", 10, R.doc_promo),
                              (1, 3, "2016-08-28 23:59:59", 10, R.doc_promo)])
    orders.withColumn("ordate_day", F.to_date("ordate")).write.partitionBy("ordate_day").parquet(f"{root}/orders")
    for name, ddl in (("order_attributes", H.ATTRS), ("object_attributes", "id long, dictid int, attrid int, attrtext string, activeflag int"),
                      ("items", "iid long, iname string"), ("visits", H.VISITS),
                      ("faces", "fid long, fname string, exid string, ftype int, ownerdistid int, faddress string"),
                      ("visit_comments", "fid long, vdate timestamp_ntz, comment string"),
                      ("attachments", "masterfid int, docid long, fileid long, filedata binary")):
        spark.createDataFrame([], ddl).write.parquet(f"{root}/{name}")
    tables = AuditTables.from_parquet(spark, root, order_day="ordate_day")
    assert "ordate_day" in tables.orders.columns and "ordate_day" not in AuditTables.from_parquet(spark, root).orders.columns
    docs = extract_documents(tables.orders, document_filter(spark, period_bounds(DAY), R), R, tables.order_day)
    assert [r.orid for r in docs.collect()] == [1]
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ordate_day" in plan
    assert run_audit_report(spark, tables, R, period_bounds(DAY)).count() == 0
