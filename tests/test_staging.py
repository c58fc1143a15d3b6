import helpers as H
from shelfaudit.catalog.codes import TEST_CODES as C
from shelfaudit.plans import staging as stg

DAY = "2024-01-15"


def _faces(spark, fids):
    return spark.createDataFrame([(f, f"F{f}", str(f), 7, 1, None) for f in fids],
                                 "fid long, fname string, exid string, ftype int, ownerdistid int, faddress string")


def _items(spark):
    return spark.createDataFrame([(1, "red cup"), (2, "old bolt"), (3, "blue pen"), (4, "green")],
                                 "iid long, iname string")


def test_facing_date_rules(spark):
    """Lines at the same time, same day and next day: the initial rows see the
    first, facing and shelf the first two, store all three."""
    faces = _faces(spark, [10])
    vis = H.visits(spark, [(1, 10, DAY + " 09:00:00")])
    stock = C.doc_stock_check
    td = H.orders(spark, [(1, 50, DAY + " 10:00:00", 10, stock)])
    fa, sh, st = C.facing_attrs[0], C.shelf_attrs[0], C.store_attrs[0]
    rows = []
    for attr in (fa, sh, st):
        rows += [(1, 50, 1, 1, attr, "1", 1, DAY + " 10:00:00"),
                 (1, 50, 1, 1, attr, "1", 1, DAY + " 18:00:00"),
                 (1, 50, 1, 1, attr, "1", 1, "2024-01-16 10:00:00")]
    at = H.attrs(spark, rows)
    init = stg.facing_initial(faces, vis, td, at, _items(spark), C)
    assert [(r.mfid, r.orid, r.itid, r.facing, r.orcomment) for r in init.collect()] == [(10, 50, 1, 0, "0")]
    out = stg.facing_counts(faces, vis, td, at, _items(spark), C).collect()
    assert [(r.facing, r.shelf, r.store) for r in out] == [(2, 2, 3)]


def test_facing_rows_without_documents_keep_zero(spark):
    faces = _faces(spark, [10, 11])
    vis = H.visits(spark, [(1, 10, DAY + " 09:00:00"), (1, 10, DAY + " 15:00:00")])
    td = H.orders(spark, [(1, 50, DAY + " 10:00:00", 10, C.doc_stock_check)])
    at = H.attrs(spark, [(1, 50, 3, 1, C.facing_attrs[0], "1", 1, DAY + " 10:00:00"),
                         (1, 50, 4, 1, C.facing_attrs[0], "1", 1, DAY + " 10:00:00")])  # item 4 not named
    init = stg.facing_initial(faces, vis, td, at, _items(spark), C)
    out = stg.facing_counts(faces, vis, td, at, _items(spark), C)
    assert init.count() == out.count() == 3
    got = sorted((r.mfid, r.orid, r.itid, r.facing) for r in out.collect())
    assert got == [(10, 50, 3, 1), (10, 50, 3, 1), (11, None, None, 0)]


def test_banner_visits_product_by_outlet_id_and_listing_inflation(spark):
    # outlet 2 has an id equal to product 2 ("old bolt"), banner B, three visits
    faces = _faces(spark, [2, 4])
    obj = spark.createDataFrame(
        [(2, 2, 611, "B", 1), (4, 2, 611, "B", 1),            # outlet banners
         (2, 1, 611, "B", 1), (1, 1, 611, "B", 1), (3, 1, 611, "X", 1), (2, 1, 611, "B", 0)],  # listings
        "id long, dictid int, attrid int, attrtext string, activeflag int")
    vis = H.visits(spark, [(1, 2, DAY + " 09:00:00"), (1, 2, DAY + " 10:00:00"), (1, 2, DAY + " 11:00:00")])
    temp = stg.banner_visits(faces, obj, vis, _items(spark), C)
    rows = sorted((r.fid, r.attrtext, r.iid) for r in temp.collect())
    assert rows == [(2, "B", 2), (2, "B", 2), (2, "B", 2), (4, "B", None)]
    listing = stg.listing_counts(temp, obj, _items(spark), C)
    got = sorted((r.iid if r.iid is not None else -1, r.listed) for r in listing.collect())
    # banner B has 4 banner-visit rows; one active listing row of product 2
    assert got == [(-1, 0), (2, 4), (2, 4), (2, 4)]


def test_listing_precount_equals_literal_join(spark):
    """The two pre-counts give the count of the original's join of listing
    rows to every banner-visit row, on random data with a hot banner."""
    import random

    from pyspark.sql import functions as F

    rnd = random.Random(11)
    banners = ["HOT"] * 6 + ["A", "B", "C", None]
    temp_rows = [(i, rnd.choice(banners), None, None, None, None, rnd.choice([None, 1, 2, 3]))
                 for i in range(400)]
    temp = spark.createDataFrame(
        temp_rows, "fid long, attrtext string, datebegin timestamp_ntz, dateend timestamp_ntz, "
                   "vdate timestamp_ntz, vdateonly timestamp_ntz, iid long")
    obj = spark.createDataFrame(
        [(rnd.choice([1, 2, 3, 4]), 1, 611, rnd.choice(["HOT", "A", "B", "Z"]), rnd.choice([0, 1]))
         for _ in range(60)],
        "id long, dictid int, attrid int, attrtext string, activeflag int")
    items = _items(spark)
    got = sorted((r.attrtext, r.iid, r.listed) for r in stg.listed_counts(temp, obj, items, C).collect())
    named = items.where(F.col("iname").contains("red") | F.col("iname").contains("bolt"))
    o = obj.where("attrid = 611 AND activeflag = 1 AND dictid = 1")
    o = o.join(temp.select("attrtext").distinct(), "attrtext", "left_semi")
    literal = (
        o.join(named, named.iid == o.id)
        .join(temp.select(F.col("attrtext").alias("t_attr")), F.col("t_attr") == o.attrtext, "left")
        .groupBy(o.attrtext, named.iname, named.iid).count()
    )
    expect = sorted((r.attrtext, r.iid, r["count"]) for r in literal.collect())
    assert got == expect and len(got) > 0


def test_case_insensitive_name_tests(spark):
    from dataclasses import replace

    faces = _faces(spark, [1, 2])
    obj = spark.createDataFrame([(1, 2, 611, "B", 1), (2, 2, 611, "B", 1)],
                                "id long, dictid int, attrid int, attrtext string, activeflag int")
    items = spark.createDataFrame([(1, "RED cup"), (2, "Old BOLT")], "iid long, iname string")
    vis = H.visits(spark, [(1, 1, DAY + " 09:00:00")])
    binary = stg.banner_visits(faces, obj, vis, items, C)
    assert sorted(r.iid for r in binary.collect() if r.iid is not None) == []
    ci = stg.banner_visits(faces, obj, vis, items, replace(C, names_ci=True))
    assert sorted(r.iid for r in ci.collect() if r.iid is not None) == [1, 2]
