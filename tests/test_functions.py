from pyspark.sql import functions as F

from helpers import t as ts
from shelfaudit.functions import period as P
from shelfaudit.functions import text as T


def test_period_end_bound_excludes_last_fraction(spark):
    df = spark.createDataFrame(
        [(1, ts("2024-01-15 23:59:59")), (2, ts("2024-01-15 23:59:59.500000")), (3, ts("2024-01-16 00:00:00")),
         (4, ts("2024-01-15 00:00:00"))],
        "k int, t timestamp_ntz",
    )
    got = sorted(r.k for r in df.where(P.in_period("t", P.period_bounds("2024-01-15"))).collect())
    assert got == [1, 4]


def test_period_bounds_from_moment_are_midnight(spark):
    b, e = P.period_bounds(ts("2024-01-15 13:45:00"))
    row = spark.range(1).select(b.alias("b"), e.alias("e")).first()
    assert row.b == ts("2024-01-15 00:00:00") and row.e == ts("2024-01-15 23:59:59")


def test_day_tests_agree(spark):
    df = spark.createDataFrame(
        [(ts("2024-01-15 23:59:59.5"),), (ts("2024-01-16 00:00:00"),), (ts("2023-01-15 10:00:00"),)], "t timestamp_ntz"
    )
    rows = df.select(P.day_parts_equal("t", "2024-01-15").alias("a"),
                     P.same_calendar_day("t", "2024-01-15").alias("b")).collect()
    assert [(r.a, r.b) for r in rows] == [(True, True), (False, False), (False, False)]


def test_text_to_number_rules(spark):
    df = spark.createDataFrame([(None,), ("",), ("7",), (" 7 ",), ("1,5",)], "x string")
    got = [r.v for r in df.select(T.to_number("x").alias("v")).collect()]
    assert got == [0.0, 0.0, 7.0, 7.0, 0.0]


def test_text_or_zero_is_text(spark):
    df = spark.createDataFrame([(None,), ("5",)], "x string")
    out = df.select(T.text_or_zero("x").alias("v"))
    assert dict(out.dtypes)["v"] == "string"
    assert [r.v for r in out.collect()] == ["0", "5"]


def test_blank_zero_and_presence_percent(spark):
    df = spark.createDataFrame(
        [(0, 5), (3, 0), (1, 3), (12, 24), (None, 4), (None, 0)], "f long, n long"
    )
    rows = df.select(T.blank_zero("f").alias("bf"), T.presence_percent("f", "n").alias("p")).collect()
    assert [r.p for r in rows] == ["", "", "33", "50", None, ""]
    assert [r.bf for r in rows] == ["", "3", "1", "12", None, None]


def test_count_total_treats_null_as_zero(spark):
    df = spark.createDataFrame([(1, None, 2, None)], "a long, b long, c long, d long")
    assert df.select(T.count_total("a", "b", "c", "d").alias("t")).first().t == 3


def test_replace_prefix_contains_concat(spark):
    df = spark.createDataFrame([("red bolt", "1.5"), ("Blue gear", None)], "n string, x string")
    r = df.select(
        T.dot_to_comma("x").alias("c"),
        T.prefix_in("n", ["red", "blu"]).alias("p"),
        T.prefix_in("n", ["red", "blu"], ci=True).alias("pci"),
        T.contains_any("n", ["bolt", "gear"]).alias("s"),
        T.concat_strict(F.lit(1), F.lit("_"), "x").alias("cc"),
    ).collect()
    assert [x.c for x in r] == ["1,5", None]
    assert [x.p for x in r] == [True, False]
    assert [x.pci for x in r] == [True, True]
    assert [x.s for x in r] == [True, True]
    assert [x.cc for x in r] == ["1_1.5", None]


def test_split_address(spark):
    df = spark.createDataFrame([("г. Тверь, ул. Ленина, д. 5, № 12",), ("no address",)], "a string")
    from shelfaudit.config import DEFAULT_ADDRESS_FIELDS

    r = df.select(*[c.alias(k) for k, c in T.split_address("a", DEFAULT_ADDRESS_FIELDS).items()]).collect()
    assert tuple(r[0]) == ("Тверь", "Ленина", "5", "12")
    assert tuple(r[1]) == ("", "", "", "")


def test_scale_conf_partitions():
    from shelfaudit.session import scale_conf

    assert scale_conf(shuffle_bytes=1 << 40, total_cores=1000)["spark.sql.shuffle.partitions"] == "8192"
    assert scale_conf(shuffle_bytes=1 << 40, total_cores=8000)["spark.sql.shuffle.partitions"] == "16000"
    assert scale_conf(1 << 20, 16)["spark.sql.shuffle.partitions"] == "32"


def test_date_in_period_matches_cast_form(spark):
    rows = [(ts(x),) for x in ("2024-01-14 23:59:59.9", "2024-01-15 00:00:00", "2024-01-16 23:59:59.999",
                               "2024-01-17 00:00:00")]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    b = P.period_bounds("2024-01-15", "2024-01-16")
    got = [r.x for r in df.select(P.date_in_period("t", b).alias("x")).collect()]
    assert got == [False, True, True, False]
    plan = df.where(P.date_in_period("t", b))._jdf.queryExecution().optimizedPlan().toString()
    assert "cast(" not in plan.split("Filter")[1].split("\n")[0].lower()


def test_only_plain_numbers_count(spark):
    from shelfaudit.functions.text import to_number

    texts = ["5", " -2.5 ", "1e2", ".5", "5.", "5d", "5f", "0x1p3", "NaN", "Infinity", "", None, "1,5", "1e", "--1"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.n for r in df.select("t", to_number("t").alias("n")).collect()}
    assert got == {t: {"5": 5.0, " -2.5 ": -2.5, "1e2": 100.0, ".5": 0.5, "5.": 5.0}.get(t, 0.0) for t in texts}
