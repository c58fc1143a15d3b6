"""What a query doesn't need of the lines goes before their join and shuffle."""

import datetime as dt
import os

from pyspark.sql import functions as F

from shelfaudit.catalog.codes import TEST_CODES as C
from shelfaudit.plans.facts import own_lines
from shelfaudit.plans.full_report import used_lines
from shelfaudit.session import staged_root
from shelfaudit.sources import analog

DAY = dt.datetime(1998, 1, 5)


def tables(spark, tmp_path):
    made = {
        "customer": ([(1, "a", 0, "AUTO"), (2, "b", 1, None), (3, "c", None, "HOME")], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        "nation": ([(0, "A", 1), (1, "B", 2)], "n_nationkey int, n_name string, n_regionkey int"),
        "orders": ([(10, 1, DAY, "O", "5-LOW"), (11, 2, DAY, "F", None), (12, 3, DAY, "O", None), (13, None, DAY, "O", None)],
                   "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderstatus string, o_orderpriority string"),
        "lineitem": ([(10, 7, 1, 2.0, 0.01, "N", "O"), (10, 8, 2, 1.0, 0.02, "R", "F"), (11, 9, 1, 3.0, None, None, "O"),
                      (12, 5, 1, 2.0, 0.03, "N", "O"), (10, None, None, None, 0.04, "N", None)],
                     "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_tax double, l_returnflag string, l_linestatus string"),
        "part": ([(7, "red bolt")], "p_partkey long, p_name string"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    before = set(os.listdir(staged_root(spark).removeprefix("file:"))) if os.path.exists(staged_root(spark).removeprefix("file:")) else set()
    t = analog.tables(spark, str(tmp_path), C)
    return t, set(os.listdir(staged_root(spark).removeprefix("file:"))) - before


def test_only_the_numbered_orders_are_written(spark, tmp_path):
    """Lines, visits, outlets and listings are definitions: nothing that a query doesn't read is joined or written."""
    t, written = tables(spark, tmp_path)
    assert len(written) == 1 and next(iter(written)).startswith("analog_orders")
    base = analog.AGENT_BASE
    found = {tuple(r) for r in t.attrs.select("masterfid", "orid", "id", "dictid", "attrid", "attrtext", "activeflag").collect()}
    assert found == {(base, 1001, 7, 2, 1, "2.1", 1), (base, 1001, 4, 1, 2, "1.2", 0), (base + 1, 2001, 2, 1, None, "3.1", 1),
                     (base, 1001, 1, 2, 4, None, 0)}
    listed = {(r.id, r.attrtext) for r in t.objattrs.where((F.col("dictid") == C.product_dict) & (F.col("attrid") == C.obj_banner_attr)).collect()}
    assert listed == {(7, "AUTO"), (9, None), (5, "HOME")}  # a customer without a nation has listings, but no documents


def test_documents_go_below_the_lines_join(spark, tmp_path):
    t, _ = tables(spark, tmp_path)
    docs = t.orders.where("mfid = 2").select("masterfid", "orid")
    lines = own_lines(t.attrs, docs)
    assert [r.attrtext for r in lines.collect()] == ["3.1"]
    plan = lines._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = {kind: next(line.index("Join") for line in plan if f"Join {kind}, ((" in line or f"Join {kind}, (l_" in line) for kind in ("Inner", "LeftSemi")}
    assert depth["Inner"] < depth["LeftSemi"], "\n".join(plan)


def test_own_lines_are_those_of_a_semi_join(spark):
    lines = spark.createDataFrame([(1, 10, "a"), (1, 10, "a"), (1, 11, "b"), (2, 10, "c"), (None, 10, "d"), (1, None, "e")], "masterfid int, orid long, t string")
    docs = spark.createDataFrame([(1, 10), (1, 10), (2, 11), (None, 10), (1, None)], "masterfid int, orid long")
    assert [r.t for r in own_lines(lines, docs).collect()] == ["a", "a"]


def test_used_lines_are_those_of_any_section(spark):
    place, other = next(iter(C.main_places.values())), 99
    rows = [(other, 1, 0, True), (other, 1, 5, True), (other, 1, 8, False), (place, C.product_dict, 8, True),
            (place, C.product_dict + 1, 8, False), (place, C.product_dict, None, True), (None, None, None, False), (None, None, 2, True)]
    df = spark.createDataFrame(rows, "id long, dictid int, attrid int, used boolean")
    assert [r.used for r in df.where(used_lines(C)).collect()] == [True] * sum(r[3] for r in rows)
