"""The live report as factors: counts, expansion, parts, and rows that repeat."""

import random

import helpers as H
import pytest
from pyspark.sql import functions as F

from shelfaudit.catalog.codes import TEST_CODES as C
from shelfaudit.plans import factors as fct
from shelfaudit.plans.report import audit_report

DAY = "2024-01-15"


def _inputs(spark, products=12, repeats=3):
    """Three visits: a large one that is repeated, with repeated stock lines and order information; one like it in small; one without promo."""
    draw = random.Random(5)
    docs, fx, vis = [], [], []
    for agent, n in ((1, products), (2, 2), (3, 4)):
        kinds = (C.doc_stock, C.doc_extra_places, C.doc_promo)[: 2 if agent == 3 else 3]
        for k, kind in enumerate((*kinds, C.doc_order_info)):
            orid = agent * 100 + k
            docs.append((agent, orid, DAY + " 10:00:00", 10, kind))
            if kind == C.doc_order_info:
                fx += [(agent, 10, orid, kind, C.attr_order_info, DAY + " 10:00:00", f"info {j % 2}", 1, 1) for j in range(repeats)]
            for i in range(n if kind in kinds else 0):
                attrs = [C.attr_facing] * draw.choice((1, repeats)) + [C.attr_shelf] if kind == C.doc_stock else [9]
                fx += [(agent, 10, orid, kind, a, DAY + " 10:00:00", "5", i, 1) for a in attrs]
        vis += [(agent, 10, DAY + " 09:00:00")] * (2 if agent == 1 else 1)
    items = spark.createDataFrame([(i, f"item {i % 5}") for i in range(products)], "iid long, iname string")
    return H.visits(spark, vis), H.orders(spark, docs), H.facts(spark, fx), items


@pytest.mark.parametrize(("part_rows", "piece"), [(1_000_000, 10_000), (40, 10_000), (7, 1), (1, 2)])
def test_expansion_equals_the_report(spark, monkeypatch, part_rows, piece):
    monkeypatch.setattr(fct, "PIECE", piece)
    args = _inputs(spark, products=5)
    want = sorted(map(str, audit_report(*args, C).collect()))
    got = fct.expand(fct.report_factors(*args, C).staged(), C, part_rows=part_rows)
    assert sorted(map(str, got.collect())) == want and len(want) > 300


def test_row_counts_without_rows(spark):
    args = _inputs(spark)
    factors = fct.report_factors(*args, C).staged()
    want = {(r.masterfid, r.fid): r["count"] for r in audit_report(*args, C).groupBy("masterfid", "fid").count().collect()}
    assert {(r.masterfid, r.mfid): r.rows for r in fct.visit_rows(factors).collect()} == want
    assert want.keys() == {(1, 10), (2, 10)}  # the third has no promo products
    held = sum(getattr(factors, n).count() for n in ("visits", "stock", "places", "promo"))
    assert held < 100 < sum(want.values()) / 10


def test_large_visit_goes_along_all_blocks(spark, tmp_path):
    """More parts than stock products: the other blocks are cut too; no part is much above its size."""
    args = _inputs(spark, products=12)
    fct.report_factors(*args, C).write(str(tmp_path / "f"))
    factors = fct.ReportFactors.read(spark, str(tmp_path / "f"))
    pieces = {n: fct._pieces(getattr(factors, n), n) for n in ("stock", "places", "promo")}
    cuts = {r.masterfid: r for r in fct._cuts(pieces, factors, 50).collect()}
    rows = {r.masterfid: r.rows for r in fct.visit_rows(factors).collect()}
    parts = cuts[1]._c_stock * cuts[1]._c_places * cuts[1]._c_promo
    assert cuts[1]._c_stock == 12 and cuts[1]._c_places > 1 and parts >= rows[1] / 50
    assert fct.expand(factors, C, part_rows=50).count() == sum(rows.values())


def test_empty_inputs(spark):
    vis, docs, fx, items = _inputs(spark)
    factors = fct.report_factors(vis.limit(0), docs, fx, items, C).staged()
    assert fct.visit_rows(factors).count() == 0 and fct.expand(factors, C).count() == 0
    assert len(fct.expand(factors, C).columns) == 38


def test_part_count_follows_repeated_visits_and_lines(spark):
    from shelfaudit.plans.report import visit_parts

    vis, _, fx, _ = _inputs(spark, products=12)
    keys = vis.select("masterfid", F.col("fid").alias("mfid"))
    once = {r.masterfid: r._parts for r in visit_parts(keys.distinct(), fx.dropDuplicates(["masterfid", "ortype", "attrid", "id"]), C, 600).collect()}
    got = {r.masterfid: r._parts for r in visit_parts(keys, fx, C, 600).collect()}
    assert once[1] == 3 and got[1] == 12
