"""The whole report's order, and texts under a collation."""

import glob
import random

import pyarrow.parquet as pq

from shelfaudit.config import REFERENCE_CODES
from shelfaudit.operators.eav import pivot_max
from shelfaudit.operators.ordering import whole_position, write_ordered
from shelfaudit.plans import staging as stg
from shelfaudit.sources.tables import AuditTables, with_collation

KEYS = ("name", "day", "doc")


def _rows(n=600):
    draw = random.Random(4)
    return [(draw.choice([None, "a", "b", "hot", "hot", "hot"]), draw.choice([None, *range(30)]), draw.choice([None, *range(9)]), k) for k in range(n)]


def _first_null(r):
    return tuple((x is not None, "" if x is None else f"{x:>5}" if isinstance(x, str) else f"{x:05d}") for x in r[:3])


def test_whole_position_equals_brute_force(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "name string, day int, doc int, k int").repartition(7)
    place = {key: n for n, key in enumerate(sorted({_first_null(r) for r in rows}), 1)}
    got = whole_position(df, KEYS).collect()
    assert len(got) == len(rows) and {(r.k, r.order_no) for r in got} == {(r[3], place[_first_null(r)]) for r in rows}


def test_position_plan_has_no_window_over_a_key(spark):
    """Windows are over slices and over one row a slice, never over a group of the report."""
    df = spark.createDataFrame(_rows(), "name string, day int, doc int, k int")
    out = whole_position(df, KEYS)
    windows = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in x]
    assert windows and all("_slice" in x and "[name" not in x.split("windowspec")[0] for x in windows)
    assert whole_position(df.limit(0), KEYS).count() == 0


def test_ordered_files_read_back_in_order(spark, tmp_path):
    rows, path = _rows(), str(tmp_path / "report")
    write_ordered(spark.createDataFrame(rows, "name string, day int, doc int, k int").repartition(5), KEYS, path)
    back = [tuple(r.values()) for f in sorted(glob.glob(f"{path}/part-*")) for r in pq.read_table(f).to_pylist()]
    assert len(back) == len(rows) and [_first_null(r) for r in back] == sorted(_first_null(r) for r in rows)


def test_texts_under_a_collation(spark):
    """Spellings of a banner are one banner; product names and maxima ignore case."""
    objattrs = spark.createDataFrame([(1, 2, 611, "Mega", 1), (2, 2, 611, "MEGA", 1), (10, 1, 611, "mega", 1), (11, 1, 611, "mEGA", 1), (12, 1, 611, "other", 1)],
                                     "id long, dictid int, attrid int, attrtext string, activeflag int")
    items = spark.createDataFrame([(10, "КУШ 1"), (11, "скит 2"), (12, "куш 3"), (13, "x")], "iid long, iname string")
    temp = spark.createDataFrame([("Mega", 10, 1), ("MEGA", 10, 1), ("mega", 11, 2)], "attrtext string, iid long, datebegin int")
    plain = AuditTables(orders=None, attrs=temp, objattrs=objattrs, items=items, visit_source=None, faces=None, agents=None)
    counted = stg.listed_counts(temp, objattrs, items, REFERENCE_CODES).collect()
    assert counted == []
    t = with_collation(plain)
    counted = stg.listing_counts(t.attrs, t.objattrs, t.items, REFERENCE_CODES).collect()
    assert sorted((r.attrtext.lower(), r.iid, r.listed, r.datebegin) for r in counted) == [("mega", 10, 3, 1), ("mega", 11, 3, 2)]
    texts = spark.createDataFrame([(1, 5, "b"), (1, 5, "C"), (1, 6, "x")], "g int, k int, attrtext string")
    assert pivot_max(texts, ["g"], "k", {"v": 5}).first().v == "b"
    t = with_collation(AuditTables(orders=None, attrs=texts, objattrs=objattrs, items=items, visit_source=None, faces=None, agents=None))
    assert pivot_max(t.attrs, ["g"], "k", {"v": 5}).first().v == "C"
