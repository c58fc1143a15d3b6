"""All sections from one aggregate of the facts: row for row what the separate sections give."""

import random
from dataclasses import replace

import helpers as H
import pytest
from pyspark.sql import functions as F

from shelfaudit.catalog.codes import TEST_CODES as C
from shelfaudit.functions.period import period_bounds
from shelfaudit.plans import one_pass as one
from shelfaudit.plans import sections as sec
from shelfaudit.plans.report import audit_report, report_inputs
from shelfaudit.sources.tables import AuditTables

DAY = "2024-01-15"
KINDS = (C.doc_stock, C.doc_extra_places, C.doc_main_places, C.doc_promo, C.doc_order_info)


def _rows(seed):
    """Documents with tied, missing and repeated dates, ids and types; lines with repeated, empty and missing texts and products."""
    draw = random.Random(seed)
    attrs = sorted({C.attr_facing, C.attr_shelf, C.attr_store, C.attr_order_info, *C.extra_places.values(), *C.promo_actions.values(), 9_999})
    ids = sorted({*C.main_places.values(), *C.extra_places.values(), *C.promo_actions.values()}) + [7, 8, None]
    dicts = [C.main_places_dict, C.extra_places_dict, C.promo_dict, 99]
    docs, lines = [], []
    for _ in range(60):
        agent, outlet, orid, kind = draw.randint(1, 2), draw.choice((10, 20)), draw.randint(1, 40), draw.choice(KINDS)
        when = draw.choice((f"{DAY} 10:00:00", f"{DAY} 10:00:00", f"{DAY} 09:00:00", None))
        docs.append((agent, orid, when, outlet, kind))
        for _ in range(draw.randint(0, 14)):
            lines.append((agent, outlet, orid, kind, draw.choice(attrs), when or f"{DAY} 08:00:00", draw.choice(("1", "2.5", "a", "A", "", None)),
                          draw.choice(ids), draw.choice(dicts)))
    return docs, lines + lines[::5]


def _same(got, want):
    want = want.select(*sorted(want.columns))
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    return want.count()


@pytest.mark.parametrize("codes", [C, replace(C, extra_places_filter_on="attrid", promo_filter_on="id")], ids=["live", "dormant"])
@pytest.mark.parametrize("seed", range(3))
def test_sections_equal_the_separate_ones(spark, seed, codes):
    docs, lines = _rows(seed)
    tdocs, fx = H.orders(spark, docs), H.facts(spark, lines)
    rows = one.staged_sections(fx, tdocs, codes)
    n = _same(one.section_pivot(rows, "main", codes), sec.main_places(fx, tdocs, codes))
    n += _same(one.section_pivot(rows, "extra", codes), sec.extra_places(fx, tdocs, codes))
    n += _same(one.section_pivot(rows, "promo", codes), sec.promo_actions(fx, tdocs, codes))
    assert n > 10
    assert _same(one.section_info(rows, tdocs, codes), sec.order_info(fx, tdocs, codes)) > 0
    for kind in KINDS[:2] + KINDS[3:4]:
        _same(sec.assortment(rows, kind), sec.assortment(fx, kind))
    base = sec.assortment(fx, C.doc_stock)
    assert _same(one.section_stock(base, rows, codes, "id"), sec.stock_lookups(base, fx, codes)) > base.count()


def test_repeated_lines_are_one_row(spark):
    """A product's third of all lines is one row with a count, and comes back as often."""
    lines = [(1, 10, 5, C.doc_stock, C.attr_facing, f"{DAY} 10:00:00", "3", 7, 1)] * 2_000
    tdocs, fx = H.orders(spark, [(1, 5, f"{DAY} 10:00:00", 10, C.doc_stock)]), H.facts(spark, lines)
    rows = one.staged_sections(fx, tdocs, C)
    assert [(r.id, r.attrtext, r.times) for r in rows.collect()] == [(7, "3", 2_000)]
    assert one.section_stock(sec.assortment(rows, C.doc_stock), rows, C, "id").count() == 2_000


def test_collated_texts_stay_apart(spark):
    lines = [(1, 10, 5, C.doc_stock, C.attr_facing, f"{DAY} 10:00:00", x, 7, 1) for x in ("a", "A", "a")]
    tdocs = H.orders(spark, [(1, 5, f"{DAY} 10:00:00", 10, C.doc_stock)])
    fx = H.facts(spark, lines).withColumn("attrtext", F.collate("attrtext", "UTF8_LCASE"))
    rows = one.section_rows(fx, tdocs, C)
    assert rows.schema["attrtext"].dataType == fx.schema["attrtext"].dataType
    assert sorted((r.attrtext, r.times) for r in rows.collect()) == [("A", 1), ("a", 2)]


def test_no_documents(spark):
    tdocs, fx = H.orders(spark, []), H.facts(spark, [])
    rows = one.staged_sections(fx, tdocs, C)
    assert rows.count() == one.section_info(rows, tdocs, C).count() == one.section_pivot(rows, "promo", C).count() == 0


def test_lines_are_read_and_aggregated_once(spark, tmp_path):
    """The report's sections come from one scan of the lines and one aggregate of them."""
    docs, lines = _rows(1)
    H.attrs(spark, [(m, o, i, dc, a, tx, 1, None) for m, _, o, _, a, _, tx, i, dc in lines]).write.parquet(str(tmp_path / "lines"))
    items = spark.createDataFrame([(7, "seven")], "iid long, iname string")
    visits = H.visits(spark, [(1, 10, f"{DAY} 09:00:00"), (2, 20, f"{DAY} 09:00:00")])
    tables = AuditTables(orders=H.orders(spark, docs), attrs=spark.read.parquet(str(tmp_path / "lines")), objattrs=None, items=items,
                         visit_source=visits, faces=None, agents=None)
    vis, tdocs, fx = report_inputs(spark, tables, C, period_bounds(DAY), stage_facts=False)
    plan = one.section_rows(fx, tdocs, C)._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan" in x and "/lines" in x for x in plan.splitlines()) == 1
    read = audit_report(vis, tdocs, fx, items, C).inputFiles()
    assert any("/sections-" in f for f in read) and not any(f"{tmp_path.name}/lines" in f for f in read)
