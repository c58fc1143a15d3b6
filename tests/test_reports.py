import helpers as H
from pyspark.sql import functions as F

from shelfaudit.catalog.codes import TEST_CODES as C
from shelfaudit.config import REFERENCE_CODES as R
from shelfaudit.plans import extract as ext
from shelfaudit.plans.full_report import full_report
from shelfaudit.plans.full_report import report_columns as full_columns
from shelfaudit.plans.report import audit_report, report_columns
from shelfaudit.functions.period import period_bounds

DAY = "2024-01-15"


def _items(spark, rows):
    return spark.createDataFrame(rows, "iid long, iname string")


def test_live_report_product_of_assortments(spark):
    vis = H.visits(spark, [(1, 10, DAY + " 09:00:00"), (1, 11, DAY + " 09:00:00")])
    d = DAY + " 10:00:00"
    td = H.orders(spark, [(1, 1, d, 10, 613), (1, 2, d, 10, 612), (1, 3, d, 10, 611), (1, 4, d, 11, 613)])
    fx = H.facts(spark, [
        (1, 10, 1, 613, C.attr_facing, d, "5", 7, 1), (1, 10, 1, 613, 8, d, "x", 8, 1),
        (1, 10, 2, 612, C.extra_places["racks"], d, "r", C.extra_places["racks"], 1),
        (1, 10, 3, 611, 8, d, "y", 21, 1), (1, 10, 3, 611, 8, d, "y", 22, 1),
        (1, 11, 4, 613, C.attr_facing, d, "1", 7, 1),  # outlet 11 has no 612/611: dropped
    ])
    items = _items(spark, [(7, "seven"), (8, "eight"), (1, "one")])
    out = audit_report(vis, td, fx, items, C)
    assert out.columns == report_columns(C) and len(out.columns) == 38
    rows = out.collect()
    assert len(rows) == 2 * 1 * 2
    by = sorted((r.item613_name, r.facing, r.total_qty, r.item612_name, r.racks_612) for r in rows)
    assert by[0] == ("eight", "0", 0.0, "one", "r")
    assert by[-1] == ("seven", "5", 5.0, "one", "r")
    assert {r.sec613_open for r in rows} == {C.labels.open_613}
    assert {r.out_of_stock for r in rows} == {C.labels.empty}


def test_full_report_distance_chain(spark):
    d = DAY + " 10:00:00"
    vis = H.visits(spark, [(1, 10, DAY + " 09:00:00")])
    orders = H.orders(spark, [
        (1, 100, d, 10, R.doc_stock_check), (1, 101, d, 10, R.doc_extra_places),
        (1, 102, d, 10, R.doc_main_places), (1, 103, d, 10, R.doc_promo),
        (1, 106, d, 10, R.doc_order_info), (1, 99, d, 10, R.doc_photo),
        (1, 200, d, 10, R.doc_promo),  # too far from the stock check
    ])
    shelf_id = R.main_places["shelf"]
    attrs = H.attrs(spark, [
        (1, 101, 555, 1, R.extra_places["racks"], "r1", 1, d),
        (1, 102, shelf_id, 1, 1, "s1", 1, d),
        (1, 103, 777, 1, R.promo_actions["price_cut"], "1.5", 1, d),
        (1, 200, 778, 1, R.promo_actions["price_cut"], "9.9", 1, d),
        (1, 106, 1, 1, R.attr_order_info, "info", 0, d),
    ])
    obj = spark.createDataFrame(
        [(10, 2, R.obj_banner_attr, "B", 1), (10, 2, R.obj_email_attr, "a@b", 1)],
        "id long, dictid int, attrid int, attrtext string, activeflag int")
    items = _items(spark, [(shelf_id, "SKU shelf"), (555, "rack item"), (777, "promo item")])
    faces = spark.createDataFrame(
        [(10, "Outlet ten", "10", 7, 1, "г. Тверь, ул. Мира, д. 3, № 7"), (1, "Agent one", "1", 1, 1, None)],
        "fid long, fname string, exid string, ftype int, ownerdistid int, faddress string")
    vstart = H.t(DAY + " 09:00:00")
    facing = spark.createDataFrame([(10, 1, 0, 0, "0", vstart, 100, shelf_id)],
                                   "mfid long, facing long, shelf long, store long, orcomment string, "
                                   "datebegin timestamp_ntz, orid long, itid long")
    listing = spark.createDataFrame([("B", shelf_id, 4, vstart)],
                                    "attrtext string, iid long, listed long, datebegin timestamp_ntz")
    comments = spark.createDataFrame([(10, vstart, "closed early")], "fid long, vdate timestamp_ntz, comment string")
    out = full_report(vis, orders, orders, attrs, obj, items, ext.with_address_parts(faces, R),
                      facing, listing, comments, R, period_bounds(DAY))
    assert out.columns == full_columns(R) and len(out.columns) == 42
    rows = out.collect()
    assert len(rows) == 1
    r = rows[0].asDict()
    assert (r["employee_name"], r["supervisor_name"], r["banner"], r["email"]) == ("Outlet ten", "Agent one", "B", "a@b")
    assert (r["city"], r["street"], r["building"], r["outlet_no"]) == ("Тверь", "Мира", "3", "7")
    assert (r["item_name"], r["facing"], r["shelf_qty"], r["listed"], r["total_qty"], r["presence_pct"]) == \
        ("SKU shelf", "1", "", "4", 5, "25")
    assert (r["item612_name"], r["racks_612"]) == ("rack item", "r1")
    assert r["shelf"] == "s1"
    assert (r["item611_name"], r["price_cut"]) == ("promo item", "1,5")
    assert r["order_info"] == "info"
    assert r["photo"] == "199"
    assert r["visit_comment"] == "closed early"


def test_live_report_row_invariant_on_test_tables(spark):
    """Rows are at least the sum over visits of |613| x |612| x |611| assortments, which DuckDB counts."""
    import __spark_entry__ as E
    from shelfaudit.catalog.oracle import _with
    from tools.compare import duck

    sf = "/root/testdata/sf0.001"
    expect = duck(sf).execute(_with("""
      SELECT sum(a * b * c) FROM seen JOIN (
        SELECT agent, outlet, count(DISTINCT object) FILTER (kind = 613) AS a, count(DISTINCT object) FILTER (kind = 612) AS b,
               count(DISTINCT object) FILTER (kind = 611) AS c FROM fact GROUP BY ALL) USING (agent, outlet)""")).fetchone()[0]
    assert E.queries()["q15_audit_report"](spark, sf).count() >= expect > 0


def test_large_visit_is_built_in_parts(spark):
    """One visit's product of three assortments spreads over several tasks, with the same rows."""
    from shelfaudit.plans.report import audit_report

    docs, fx = [], []
    for k, kind in enumerate((C.doc_stock, C.doc_extra_places, C.doc_promo)):
        docs.append((1, 100 + k, DAY + " 10:00:00", 10, kind))
        fx += [(1, 10, 100 + k, kind, 9, DAY + " 10:00:00", "x", i, 1) for i in range(20)]
    vis = H.visits(spark, [(1, 10, DAY + " 09:00:00")])
    items = _items(spark, [(i, f"item {i}") for i in range(20)])
    tdocs, facts = H.orders(spark, docs), H.facts(spark, fx)
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = audit_report(vis, tdocs, facts, items, C, part_rows=500)
        spread = {r.p: r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()}
        whole = audit_report(vis, tdocs, facts, items, C)
        assert sum(spread.values()) == whole.count() == 8000 and len(spread) > 2
        assert sorted(map(str, out.collect())) == sorted(map(str, whole.collect()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_rows_without_a_lookup_key_are_spread(spark):
    from shelfaudit.plans.full_report import spread_left

    df = spark.range(2000).select(F.col("id").alias("fid"), F.when(F.col("id") < 20, F.col("id")).alias("k"))
    look = spark.createDataFrame([(3, "c"), (3, "d"), (None, "n")], "k long, v string")
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = spread_left(df, look, ["k"], ["fid"])
        assert out.columns == ["fid", "k", "v"] and out.count() == 2001 and out.filter("v is not null").count() == 2
        sizes = [r["count"] for r in out.filter("k is null").groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) > 1 and max(sizes) < 1200
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_repeated_product_id_keeps_rows(spark):
    from shelfaudit.plans.sections import with_item_name

    items = _items(spark, [(1, "b"), (1, "a"), (2, "c")])
    got = with_item_name(spark.createDataFrame([(1,), (2,), (3,)], "id long"), items, "id", "iname").collect()
    assert sorted((r.id, r.iname) for r in got) == [(1, "a"), (2, "c"), (3, None)]


CONSTANT = {"district", "store_category", "photo_2", "photo_3"}


def test_full_report_has_a_value_in_every_column(spark):
    import __spark_entry__ as E

    df = E.queries()["q23_full_report"](spark, "/root/testdata/sf0.01")
    filled = df.agg(*[F.max(F.coalesce(F.col(c).cast("string"), F.lit("")) != "").alias(c) for c in df.columns]).first()
    assert [c for c in df.columns if not filled[c]] == [c for c in df.columns if c in CONSTANT]


def test_full_report_is_ordered(spark):
    from shelfaudit.catalog.codes import TEST_CODES
    from shelfaudit.catalog.forms import _bounds
    from shelfaudit.plans.full_report import run_full_report
    from shelfaudit.sources import analog

    sf = "/root/testdata/sf0.001"
    vb, db = _bounds()
    rows = run_full_report(spark, analog.tables(spark, sf, TEST_CODES), TEST_CODES, vb, doc_bounds=db, keep_order=True).collect()
    keys = [(r.supervisor_name or "", r.audit_date, -1 if r.facing_doc is None else r.facing_doc) for r in rows]
    assert keys == sorted(keys) and len(keys) > 20
