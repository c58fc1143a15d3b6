"""Caller's filter rows: the period as a row, rows of several ids, column codes."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from helpers import t as ts
from shelfaudit.catalog.codes import TEST_CODES as C
from shelfaudit.functions.period import period_bounds
from shelfaudit.operators.filters import FILTER_SCHEMA, Binding, FilterSet, apply_filters
from shelfaudit.plans import extract as ext
from shelfaudit.sources.columns import coded_columns, coded_schema, parse_codes
from shelfaudit.sources.tables import VISIT_COLS

VISITS = ("ownerdistid int, masterfid int, fid long, vdate timestamp_ntz, datebegin timestamp_ntz, dateend timestamp_ntz, "
          "otkazstr string, pda int, vdateonly timestamp_ntz")


def visits(spark):
    days = [("2024-01-15 10:00:00", 1), ("2024-01-15 23:59:59", 2), ("2024-01-16 09:00:00", 1), ("2024-02-01 00:00:00", None), ("2024-03-01 12:00:00", 3)]
    return spark.createDataFrame([(o, 10 + k, 100 + k, ts(d), ts(d), ts(d), "", 0, ts(d[:10])) for k, (d, o) in enumerate(days)], VISITS)


def rows(spark, *given):
    """(type, id, id2, idstr) rows."""
    return spark.createDataFrame([(t, i, i2, None, None, None, s) for t, i, i2, s in given], FILTER_SCHEMA)


def kept(spark, *given):
    found = ext.extract_visits(visits(spark), ext.caller_rows(rows(spark, *given), C), C)
    return sorted(r.fid - 100 for r in found.collect())


PERIOD, OWNER = C.flt_period, C.flt_owner


def test_period_rows_restrict(spark):
    assert kept(spark, (PERIOD, None, None, "2024-01-15 00:00:00;2024-01-15 23:59:59")) == [0, 1]
    both = [(PERIOD, None, None, "2024-01-15;2024-01-15 12:00:00"), (PERIOD, None, None, "2024-02-01;2024-03-01 11:59:59")]
    assert kept(spark, *both) == [0, 3]  # alternatives; not what lies between them
    assert kept(spark, (PERIOD, None, None, "no period")) == []
    assert kept(spark, (PERIOD, None, None, None)) == []
    assert kept(spark, (C.flt_flag, 1, None, None)) == [0, 1, 2, 3, 4]


def test_period_row_beside_a_given_period(spark):
    """The rows of one type are alternatives, whoever added them."""
    fs = ext.caller_rows(rows(spark, (PERIOD, None, None, "2024-03-01;2024-03-02")), C)
    fs = ext.caller_filter(spark, period_bounds("2024-01-16"), C, fs)
    assert sorted(r.fid - 100 for r in ext.extract_visits(visits(spark), fs, C).collect()) == [2, 4]


def _scans(df):
    """(text, rows read) of the file scans of an executed plan."""
    df.collect()
    todo, found = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        if name.startswith("Scan parquet"):
            found.append((node.toString(), node.metrics().apply("numOutputRows").value()))
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return found


def test_period_row_reaches_the_scan_at_run_time(spark, tmp_path):
    """The scan gets the row's bounds, though they are known at run time only; by day, folders outside them aren't read."""
    path, start = str(tmp_path / "by_day"), dt.datetime(2024, 1, 1)
    source = visits(spark).limit(1).drop("vdate").crossJoin(spark.range(40)).withColumn(
        "vdate", F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int"))).drop("id").select(*VISIT_COLS)
    source.withColumn("day", F.to_date("vdate")).repartition(1).write.partitionBy("day").parquet(path)
    rows(spark, (PERIOD, None, None, "2024-01-05;2024-01-06 23:59:59")).write.parquet(str(tmp_path / "rows"))
    fs = ext.caller_rows(spark.read.parquet(str(tmp_path / "rows")), C)
    found = ext.extract_visits(spark.read.parquet(path), fs, C)
    assert found.count() == 2
    (scan, n), = [s for s in _scans(found) if "vdate" in s[0]]
    assert "GreaterThanOrEqual(vdate" in scan.split("PushedFilters")[1] and n == 40
    pruned = ext.extract_visits(spark.read.parquet(path), fs, C, day_col="day")
    assert pruned.count() == 2
    (scan, n), = [s for s in _scans(pruned) if "vdate" in s[0]]
    assert n == 2


def test_owner_rows_are_pairs(spark):
    assert kept(spark, (OWNER, 2, 1, None)) == [0, 2]
    assert kept(spark, (OWNER, 99, 1, None)) == []            # another dictionary names no owner
    assert kept(spark, (OWNER, 99, 1, None), (OWNER, 2, 3, None)) == [4]
    assert kept(spark, (OWNER, None, 2, None), (OWNER, 99, 1, None)) == [1]  # any dictionary
    assert kept(spark, (OWNER, 2, None, None)) == [0, 1, 2, 3, 4]            # any owner of the dictionary
    assert kept(spark, (OWNER, 99, None, None)) == []


def test_rows_of_two_columns(spark):
    """Pairs of the extract's own columns: both must match in one row; NULL stands for any."""
    df = spark.createDataFrame([(a, b) for a in (1, 2) for b in (7, 8, None)], "a int, b int")
    bind = {5: Binding("a", "id", more=(("id2", "b"),))}

    def got(*given):
        found = apply_filters(df, FilterSet.from_rows(rows(spark, *given)), bind).collect()
        return sorted(((r.a, r.b) for r in found), key=str)

    assert got((5, 1, 8, None), (5, 2, 7, None)) == [(1, 8), (2, 7)]
    assert got((5, 1, None, None)) == [(1, 7), (1, 8), (1, None)]
    assert got((5, None, 8, None), (5, 2, 7, None)) == [(1, 8), (2, 7), (2, 8)]
    assert len(got((5, None, None, None))) == 6


def test_null_in_derived_rows_matches_nothing(spark):
    """A visit without owner makes no row that lets every owner pass."""
    fs = ext.visit_filter(visits(spark).where("ownerdistid IS NULL OR ownerdistid = 3"), C)
    faces = spark.createDataFrame([(103, "a", "", 7, 1, ""), (104, "b", "", 7, 3, "")], "fid long, fname string, exid string, ftype int, ownerdistid int, faddress string")
    assert [r.fid for r in ext.extract_faces(faces, fs, C).collect()] == [104]


def test_column_codes():
    assert parse_codes("1; 2;14;") == [1, 2, 14]
    assert coded_columns(None, C.visit_columns, VISIT_COLS) == list(VISIT_COLS)
    # the original's three texts name all columns of their tables in order
    assert coded_columns("1;2;3;4;5;6;12;13;14", C.visit_columns, ()) == list(VISIT_COLS)
    assert coded_columns("1;2;3;17;21;20;6", C.face_columns, ()) == ["fid", "fname", "exid", "ftype", "ownerdistid", "faddress"]
    assert coded_columns("6;1;7", C.document_columns, ()) == ["masterfid", "orid", "ordate"]
    for text, why in (("1;99", "unknown"), ("1;x", "not a column code"), ("1;;2", "not a column code"), ("1;1", "twice"), ("", "no column"), ("6", "no column")):
        with pytest.raises(ValueError, match=why):
            coded_columns(text, C.face_columns, ())


def test_codes_prune_the_scan(spark, tmp_path):
    path = str(tmp_path / "visits")
    visits(spark).write.parquet(path)
    source, fs = spark.read.parquet(path), ext.caller_filter(spark, period_bounds("2024-01-15"), C)
    found = ext.extract_visits(source, fs, C, columns="3;2")
    assert found.columns == ["fid", "masterfid"] and found.count() == 2
    assert coded_schema(source, "3;2", C.visit_columns).simpleString() == found.schema.simpleString()
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<masterfid:int,fid:bigint,vdate:timestamp_ntz>" in scan
    own = replace(C, visit_columns={7: "fid"})
    assert ext.extract_visits(source, fs, own, columns="7").columns == ["fid"]
