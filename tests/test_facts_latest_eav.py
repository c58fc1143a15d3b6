
import helpers as H
from dataclasses import replace
from shelfaudit.catalog.codes import TEST_CODES as C
from shelfaudit.functions.period import period_bounds
from shelfaudit.operators.eav import pivot_max
from shelfaudit.operators.latest import latest_documents
from shelfaudit.plans import sections as sec
from shelfaudit.plans.facts import order_facts

DAY = "2024-01-15"


def test_order_facts_two_separate_semijoins(spark):
    vis = H.visits(spark, [(1, 10, DAY + " 09:00:00"), (2, 20, DAY + " 10:00:00")])
    docs = H.orders(spark, [
        (1, 500, DAY + " 11:00:00", 20, 613),   # agent 1 never met outlet 20: passes
        (3, 501, DAY + " 11:00:00", 10, 613),   # agent 3 not visited
        (1, 502, DAY + " 11:00:00", 10, 999),   # type outside the fact types
        (1, 503, "2024-01-16 00:00:00", 10, 613),  # outside the period
    ])
    at = H.attrs(spark, [
        (1, 500, 7, 1, 0, "3", 1, None), (1, 500, 8, 1, 0, "4", 0, None),
        (3, 501, 7, 1, 0, "3", 1, None), (1, 502, 7, 1, 0, "3", 1, None), (1, 503, 7, 1, 0, "3", 1, None),
    ])
    out = order_facts(docs, at, vis, period_bounds(DAY), C.fact_doc_types).collect()
    assert [(r.orid, r.id) for r in out] == [(500, 7)]


def _tdocs(spark, rows):
    return H.orders(spark, rows)


def test_latest_keeps_ties_and_skips_null_dates(spark):
    td = _tdocs(spark, [
        (1, 1, DAY + " 10:00:00", 10, 612), (1, 2, DAY + " 10:00:00", 10, 612),
        (1, 3, DAY + " 09:00:00", 10, 612), (1, 4, None, 10, 612),
    ])
    got = sorted(r.orid for r in latest_documents(td, 612).collect())
    assert got == [1, 2]


def test_order_info_does_not_test_document_type(spark):
    td = _tdocs(spark, [
        (1, 1, DAY + " 10:00:00", 10, 610),
        (1, 2, DAY + " 10:00:00", 10, 611),   # dated like the latest 610
        (1, 3, DAY + " 08:00:00", 10, 610),
    ])
    fx = H.facts(spark, [
        (1, 10, 1, 610, C.attr_order_info, DAY + " 10:00:00", "a", 1, 1),
        (1, 10, 2, 611, C.attr_order_info, DAY + " 10:00:00", "b", 1, 1),
        (1, 10, 3, 610, C.attr_order_info, DAY + " 08:00:00", "c", 1, 1),
    ])
    got = sorted(r.order_info for r in sec.order_info(fx, td, C).collect())
    assert got == ["a", "b"]


def test_pivot_missing_code_is_empty_text(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 2, None)], "k int, a int, v string")
    r = pivot_max(df, ["k"], "a", {"one": 1, "two": 2, "three": 3}, "v").first()
    assert (r.one, r.two, r.three) == ("x", "", "")


def test_extra_places_filter_on_id_versus_attribute(spark):
    td = _tdocs(spark, [(1, 1, DAY + " 10:00:00", 10, 612)])
    code = C.extra_places["racks"]
    fx = H.facts(spark, [
        (1, 10, 1, 612, 700, DAY + " 10:00:00", "first", code, 1),   # Id 612-like, AttrId 700
        (1, 10, 1, 612, code, DAY + " 10:00:00", "second", 700, 1),  # Id 700, AttrId 612-like
    ])
    live = sec.extra_places(fx, td, C).collect()
    assert [(r.id, r.racks) for r in live] == [(code, "")]
    dormant = sec.extra_places(fx, td, replace(C, extra_places_filter_on="attrid")).collect()
    assert [(r.id, r.racks) for r in dormant] == [(700, "second")]


def test_main_places_pivot_by_object_id_keeps_id(spark):
    td = _tdocs(spark, [(1, 1, DAY + " 10:00:00", 10, 608)])
    fx = H.facts(spark, [
        (1, 10, 1, 608, 5, DAY + " 10:00:00", "s", C.main_places["shelf"], 1),
        (1, 10, 1, 608, 5, DAY + " 10:00:00", "b", C.main_places["basket"], 1),
        (1, 10, 1, 608, 5, DAY + " 10:00:00", "z", C.main_places["basket"], 2),  # dictionary 2: out
    ])
    rows = sorted((r.id, r.shelf, r.basket) for r in sec.main_places(fx, td, C).collect())
    assert rows == [(C.main_places["shelf"], "s", ""), (C.main_places["basket"], "", "b")]


def test_promo_price_cut_comma(spark):
    td = _tdocs(spark, [(1, 1, DAY + " 10:00:00", 10, 611)])
    code = C.promo_actions["price_cut"]
    fx = H.facts(spark, [(1, 10, 1, 611, code, DAY + " 10:00:00", "12.5", code, 2)])
    r = sec.promo_actions(fx, td, C).first()
    assert r.price_cut == "12,5"


def test_stock_lookups_multiply_and_default(spark):
    base = spark.createDataFrame([(1, 10, 7), (1, 10, 8)], "masterfid int, mfid long, id long")
    fx = H.facts(spark, [
        (1, 10, 1, 613, C.attr_facing, DAY + " 10:00:00", "2", 7, 1),
        (1, 10, 2, 613, C.attr_facing, DAY + " 11:00:00", "3", 7, 1),
        (1, 10, 1, 613, C.attr_shelf, DAY + " 10:00:00", "x", 7, 1),
    ])
    rows = sorted((r.id, r.facing, r.shelf_qty, r.store_qty, r.total_qty)
                  for r in sec.stock_lookups(base, fx, C).collect())
    assert rows == [(7, "2", "x", "0", 2.0), (7, "3", "x", "0", 3.0), (8, "0", "0", "0", 0.0)]


def test_join_settings_are_respected(spark):
    """No hint overrides a session that switches broadcasts off."""
    from shelfaudit.plans.facts import facts_from_heads, id_range

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        heads = H.orders(spark, [(1, 500, DAY + " 11:00:00", 20, 613), (1, 501, DAY + " 11:00:00", 20, 613)]) \
            .select("masterfid", "mfid", "orid", "ortype", "ordate")
        at = H.attrs(spark, [(1, 500, 7, 1, 0, "3", 1, None), (1, 900, 7, 1, 0, "3", 1, None)])
        assert id_range(heads) == (500, 501)
        out = facts_from_heads(heads, at, id_range(heads))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        assert [r.orid for r in out.collect()] == [500]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_latest_and_pivot_match_brute_force(spark):
    import datetime as dt
    import random

    rnd = random.Random(5)
    base = dt.datetime(2024, 1, 15)
    docs = []
    for orid in range(400):
        when = None if rnd.random() < 0.05 else base + dt.timedelta(hours=rnd.randrange(6))
        docs.append((rnd.randrange(3), orid, when, rnd.randrange(4), rnd.choice([610, 611, 612])))
    td = H.orders(spark, docs)
    for t, req in ((612, True), (610, False)):
        got = sorted(r.orid for r in latest_documents(td, t, require_type=req).collect())
        best = {}
        for m, o, w, f, ty in docs:
            if ty == t and w is not None:
                best[(m, f)] = max(best.get((m, f), w), w)
        expect = sorted(o for m, o, w, f, ty in docs
                        if w is not None and (not req or ty == t) and best.get((m, f)) == w)
        assert got == expect, (t, req)

    rows = [(rnd.randrange(5), rnd.randrange(6), rnd.choice([None, "a", "b", "zz", "9"])) for _ in range(300)]
    df = spark.createDataFrame(rows, "k int, a int, v string")
    mapping = {"c1": 1, "c3": 3, "c5": 5}
    got = {r.k: (r.c1, r.c3, r.c5) for r in pivot_max(df, ["k"], "a", mapping, "v").collect()}
    expect = {}
    for k in {r[0] for r in rows}:
        vals = []
        for code in mapping.values():
            cands = [(v if a == code else "") for kk, a, v in rows if kk == k]
            cands = [c for c in cands if c is not None]
            vals.append(max(cands) if cands else None)
        expect[k] = tuple(vals)
    assert got == expect
