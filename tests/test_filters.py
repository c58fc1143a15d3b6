from pyspark.sql import functions as F

from helpers import t as ts
from shelfaudit.catalog.codes import TEST_CODES as C
from shelfaudit.functions.period import period_bounds
from shelfaudit.operators.filters import Binding, FilterSet, apply_filters
from shelfaudit.plans import extract as ext


def _visits(spark):
    return spark.createDataFrame(
        [(1, 10, 100, ts("2024-01-15 10:00:00")), (1, 11, 101, ts("2024-01-15 11:00:00")),
         (2, 20, 100, ts("2024-01-15 12:00:00"))],
        "ownerdistid int, masterfid int, fid long, vdate timestamp_ntz",
    )


def test_visit_filter_rows(spark):
    fs = ext.visit_filter(_visits(spark), C)
    rows = sorted((r.type, r.id, r.id2) for r in fs.rows.collect())
    assert rows == [(6, 2, 1), (6, 2, 2), (440003, 10, None), (440003, 11, None), (440003, 20, None),
                    (440008, 100, None), (440008, 101, None)]
    assert fs.types == {440003, 440008, 6}


def test_constant_rows_collapse(spark):
    fs = FilterSet.empty(spark).add_constants(440011, [611, 612, 611, 608]).add_constants(440200, [1])
    assert sorted((r.type, r.id) for r in fs.rows.collect()) == [(440011, 608), (440011, 611), (440011, 612), (440200, 1)]
    assert dict(fs.constants)[440011] == (611, 612, 608)


def test_faces_agents_or_outlets_and_owner(spark):
    faces = spark.createDataFrame(
        [(10, 1), (100, 1), (100, 9), (555, 1), (20, 2)], "fid long, ownerdistid int")
    fs = ext.visit_filter(_visits(spark), C)
    b = {440003: Binding("fid", group="p"), 440008: Binding("fid", group="p"), 6: Binding("ownerdistid", "id2")}
    got = sorted(tuple(r) for r in apply_filters(faces, fs, b).collect())
    assert got == [(10, 1), (20, 2), (100, 1)]


def test_unbound_types_ignored_and_empty_type_keeps_nothing(spark):
    docs = spark.createDataFrame([(611, 1), (999, 2)], "ortype int, k int")
    fs = FilterSet.empty(spark).add_constants(440011, [611]).add_constants(440200, [1])
    assert [r.k for r in apply_filters(docs, fs, {440011: Binding("ortype")}).collect()] == [1]
    empty = FilterSet.empty(spark).add_ids(440011, docs.where("k > 5"), "ortype")
    assert apply_filters(docs, empty, {440011: Binding("ortype")}).count() == 0


def test_period_row_and_pushdown(spark):
    fs = ext.document_filter(spark, period_bounds("2024-01-15"), C)
    prow = fs.rows.where(F.col("type") == C.flt_period).first()
    assert prow.idstr == "2024-01-15 00:00:00;2024-01-15 23:59:59"
    docs = spark.createDataFrame(
        [(ts("2024-01-15 23:59:59.5"), 611), (ts("2024-01-15 08:00:00"), 611), (ts("2024-01-15 08:00:00"), 613)],
        "ordate timestamp_ntz, ortype int")
    got = apply_filters(docs, fs, {C.flt_doc_type: Binding("ortype")}, period_column="ordate").collect()
    assert [(r.ortype, r.ordate.hour) for r in got] == [(611, 8)]


def test_caller_rows_copied_without_extra_columns(spark):
    rows = spark.createDataFrame([(440003, 5, None, None, None, None, None, "x")],
                                 "type int, id long, id2 long, id3 long, id4 long, id5 long, idstr string, "
                                 "datjoin string")
    fs = FilterSet.from_rows(rows, [440003])
    assert fs.rows.columns == ["type", "id", "id2", "id3", "id4", "id5", "idstr"]
    assert fs.cleared().rows.count() == 0


def test_caller_filter_restricts_visits(spark):
    """The caller's rows (an agent) plus the report period restrict the visit extract."""
    visit_rows = spark.createDataFrame(
        [(1, 10, 100, ts("2024-01-15 10:00:00"), ts("2024-01-15 10:00:00"), ts("2024-01-15 10:00:00"), "", 0,
          ts("2024-01-15 00:00:00")),
         (1, 11, 101, ts("2024-01-15 11:00:00"), ts("2024-01-15 11:00:00"), ts("2024-01-15 11:00:00"), "", 0,
          ts("2024-01-15 00:00:00")),
         (1, 10, 102, ts("2024-01-16 09:00:00"), ts("2024-01-16 09:00:00"), ts("2024-01-16 09:00:00"), "", 0,
          ts("2024-01-16 00:00:00"))],
        "ownerdistid int, masterfid int, fid long, vdate timestamp_ntz, datebegin timestamp_ntz, "
        "dateend timestamp_ntz, otkazstr string, pda int, vdateonly timestamp_ntz")
    caller = spark.createDataFrame([(C.flt_agent, 10, None, None, None, None, None, "ignored")],
                                   "type int, id long, id2 long, id3 long, id4 long, id5 long, idstr string, "
                                   "datjoin string")
    base = FilterSet.from_rows(caller, [C.flt_agent])
    fs = ext.caller_filter(spark, period_bounds("2024-01-15"), C, base)
    got = [(r.masterfid, r.fid) for r in ext.extract_visits(visit_rows, fs, C).collect()]
    assert got == [(10, 100)]
    assert sorted(r.type for r in fs.rows.collect()) == sorted([C.flt_agent, C.flt_period])


def test_filter_semantics_match_brute_force(spark):
    import random

    rnd = random.Random(9)
    rows = [(rnd.randrange(8), rnd.randrange(8), rnd.randrange(3)) for _ in range(200)]
    df = spark.createDataFrame(rows, "a long, b long, c long")
    ids_a = {rnd.randrange(8) for _ in range(3)}
    ids_b = {rnd.randrange(8) for _ in range(3)}
    ids_c = {rnd.randrange(3)}
    src = lambda vals: spark.createDataFrame([(v,) for v in vals] or [], "v long")
    fs = (FilterSet.empty(spark).add_ids(1, src(ids_a), "v").add_ids(2, src(ids_b), "v")
          .add_ids(3, src(ids_c), "v").add_constants(9, [1]))
    bind = {1: Binding("a", group="g"), 2: Binding("b", group="g"), 3: Binding("c")}
    got = sorted(tuple(r) for r in apply_filters(df, fs, bind).collect())
    expect = sorted(r for r in rows if (r[0] in ids_a or r[1] in ids_b) and r[2] in ids_c)
    assert got == expect
    empty = FilterSet.empty(spark).add_ids(3, src([]), "v")
    assert apply_filters(df, empty, bind).count() == 0


def test_types_found_in_the_rows_restrict(spark):
    """A caller's set binds by its rows, declared or not; a declared type without rows keeps nothing."""
    rows = spark.createDataFrame([(7, 1)], "type int, id long")
    for c in ("id2", "id3", "id4", "id5"):
        rows = rows.selectExpr("*", f"cast(null as long) as {c}")
    rows = rows.selectExpr("*", "cast(null as string) as idstr")
    df = spark.createDataFrame([(1,), (2,)], "a long")
    assert apply_filters(df, FilterSet.from_rows(rows), {7: Binding("a")}).count() == 1
    assert apply_filters(df, FilterSet.from_rows(rows, [9]), {7: Binding("a"), 9: Binding("a")}).count() == 0
