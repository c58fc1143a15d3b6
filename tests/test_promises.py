"""Uniqueness checks: repeated products, banners and e-mails are counted during the run, or end it."""

import helpers as H
import pytest

from shelfaudit.catalog.codes import TEST_CODES as C
from shelfaudit.operators.promises import KeyChecks
from shelfaudit.plans import staging as stg
from shelfaudit.plans.sections import with_item_name

DAY = "2024-01-15"


def _products(spark):
    return spark.createDataFrame([(1, "b"), (1, "a"), (1, "c"), (2, "d"), (3, "x"), (3, "x"), (None, "n"), (None, "m")], "iid long, iname string")


def test_repeated_products_are_counted(spark):
    checks = KeyChecks()
    df = with_item_name(spark.createDataFrame([(1,), (2,), (9,)], "id long"), _products(spark), checks=checks)
    assert sorted((r.id, r.iname) for r in df.collect()) == [(1, "a"), (2, "d"), (9, None)]
    assert checks.report() == {"iname": {"repeated": 2, "most": 3}}


def test_two_lookups_of_one_name_are_told_apart(spark):
    checks = KeyChecks()
    ids = spark.createDataFrame([(1,)], "id long")
    with_item_name(ids, _products(spark), checks=checks).collect()
    with_item_name(ids, _products(spark).where("iid = 2"), checks=checks).collect()
    assert checks.report() == {"iname": {"repeated": 2, "most": 3}, "iname'": {"repeated": 0, "most": 1}}


def test_strict_check_names_the_key(spark):
    df = with_item_name(spark.createDataFrame([(1,)], "id long"), _products(spark), checks=KeyChecks(strict=True))
    with pytest.raises(Exception, match=r"iname: key \((1|3)\) has (3|2) rows"):
        df.collect()
    once = with_item_name(spark.createDataFrame([(2,)], "id long"), _products(spark).where("iid = 2 OR iid IS NULL"), checks=KeyChecks(strict=True))
    assert [r.iname for r in once.collect()] == ["d"]


def _temp(spark, checks):
    faces = spark.createDataFrame([(f, f"F{f}", str(f), 7, 1, None) for f in (2, 4, 6)],
                                  "fid long, fname string, exid string, ftype int, ownerdistid int, faddress string")
    obj = spark.createDataFrame(
        [(2, 2, 611, "B", 1), (2, 2, 611, "D", 1), (4, 2, 611, "B", 1), (6, 2, 612, "Z", 1), (6, 2, 612, "Z", 1)],
        "id long, dictid int, attrid int, attrtext string, activeflag int")
    vis = H.visits(spark, [(1, 2, DAY + " 09:00:00"), (1, 2, DAY + " 10:00:00")])
    return stg.banner_visits(faces, obj, vis, spark.createDataFrame([(2, "old bolt")], "iid long, iname string"), C, checks)


def test_repeated_banner_keeps_its_rows_and_is_counted(spark):
    checks = KeyChecks()
    rows = sorted((r.fid, r.attrtext or "") for r in _temp(spark, checks).collect())
    assert rows == sorted((r.fid, r.attrtext or "") for r in _temp(spark, None).collect())
    assert rows == [(2, "B"), (2, "B"), (2, "D"), (2, "D"), (4, "B"), (6, "")]
    assert checks.report() == {"banner": {"repeated": 1, "most": 2}}


def test_strict_banner(spark):
    with pytest.raises(Exception, match=r"banner: key \(2\) has 2 rows"):
        _temp(spark, KeyChecks(strict=True)).collect()


def test_report_with_checks_is_the_same(spark):
    from shelfaudit.catalog.forms import _bounds
    from shelfaudit.plans.full_report import run_full_report
    from shelfaudit.plans.report import run_audit_report
    from shelfaudit.sources import analog

    tables = analog.tables(spark, "/root/testdata/sf0.001", C)
    vb, db = _bounds()
    for run, lookups in ((run_audit_report, {"item613_name", "item612_name", "item611_name"}),
                         (run_full_report, {"item612_name", "item611_name", "item_name", "banner", "email"})):
        checks = KeyChecks()
        got = run(spark, tables, C, vb, doc_bounds=db, checks=checks).collect()
        assert sorted(map(str, got)) == sorted(map(str, run(spark, tables, C, vb, doc_bounds=db).collect()))
        seen = checks.report()
        assert seen.keys() == lookups and all(r == {"repeated": 0, "most": 1} for r in seen.values())
