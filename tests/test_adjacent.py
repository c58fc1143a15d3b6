import random


from shelfaudit.operators.adjacent import attach, band_join, distance_lookup, offset_join


def _lr(spark, left, right):
    l = spark.createDataFrame(left, "lk int, lp int, lv string")
    r = spark.createDataFrame(right, "rk int, rp int, rv string")
    return l, r


def test_neighbour_in_minus_one_one(spark):
    l, r = _lr(spark, [(1, 10, "x")], [(1, 9, "a"), (1, 11, "b"), (1, 12, "c"), (1, 10, "d"), (2, 11, "e")])
    got = sorted(x.rp for x in offset_join(l, r, [("lk", "rk")], "lp", "rp", [-1, 1]).collect())
    assert got == [9, 11]


def _brute(left, right, lo, hi, how):
    out = []
    for lk, lp, lv in left:
        m = [(lk, lp, lv, rk, rp, rv) for rk, rp, rv in right
             if lk is not None and lk == rk and lp is not None and rp is not None and lo <= rp - lp <= hi]
        if m:
            out += m
        elif how == "left":
            out.append((lk, lp, lv, None, None, None))
    return sorted(out, key=repr)


def _rows(df):
    return sorted((tuple(r) for r in df.select("lk", "lp", "lv", "rk", "rp", "rv").collect()), key=repr)


def test_band_join_matches_brute_force(spark):
    rnd = random.Random(3)
    left = [(rnd.randrange(5), rnd.choice([None] + list(range(40))), f"l{i}") for i in range(300)]
    left += left[:20]  # duplicates must survive
    right = [(rnd.randrange(5), rnd.randrange(45), f"r{i}") for i in range(300)]
    l, r = _lr(spark, left, right)
    for lo, hi in ((1, 1), (1, 4), (-1, 7), (1, 100), (-20, 40)):
        for how in ("inner", "left"):
            got = _rows(band_join(l, r, [("lk", "rk")], "lp", "rp", lo, hi, how=how))
            assert got == _brute(left, right, lo, hi, how), (lo, hi, how)


def test_distance_lookup_attach_keeps_rows_and_nulls(spark):
    wide = spark.createDataFrame(
        [(1, 10, "a"), (1, 10, "a"), (1, None, "b"), (2, 5, "c")], "k int, pos int, payload string")
    right = spark.createDataFrame([(1, 11), (1, 13), (1, 20), (2, 50)], "rk int, rpos int")
    look = distance_lookup(wide, right, [("k", "rk")], "pos", "rpos", band=(1, 4))
    got = [(r.k, r.pos, r.payload, r.rpos) for r in attach(wide, look, ["k"], "pos").collect()]
    assert sorted(got, key=repr) == sorted([(1, 10, "a", 11), (1, 10, "a", 13), (1, 10, "a", 11), (1, 10, "a", 13),
                                            (1, None, "b", None), (2, 5, "c", None)], key=repr)


def test_bands_of_large_and_negative_ids(spark):
    for base in (2 ** 54, -500_000, 2 ** 62):
        left = [(1, base + i, f"l{i}") for i in range(200)]
        right = [(1, base + i, f"r{i}") for i in range(0, 200, 2)]
        l = spark.createDataFrame(left, "lk int, lp long, lv string")
        r = spark.createDataFrame(right, "rk int, rp long, rv string")
        for lo, hi in ((1, 7), (1, 4), (-3, 2)):
            for how in ("inner", "left"):
                got = _rows(band_join(l, r, [("lk", "rk")], "lp", "rp", lo, hi, how=how))
                assert got == _brute(left, right, lo, hi, how), (base, lo, hi, how)


def test_fractional_positions_are_refused(spark):
    import pytest

    l = spark.createDataFrame([(1, 1.0, "x")], "lk int, lp double, lv string")
    r = spark.createDataFrame([(1, 3.5, "a")], "rk int, rp double, rv string")
    with pytest.raises(TypeError):
        band_join(l, r, [("lk", "rk")], "lp", "rp", 1, 4)
    with pytest.raises(TypeError):
        offset_join(l, r, [("lk", "rk")], "lp", "rp", [1])


def test_left_join_reads_each_side_once(spark):
    l, r = _lr(spark, [(1, 10, "x")], [(1, 9, "a")])
    for df in (offset_join(l, r, [("lk", "rk")], "lp", "rp", [-1, 1], "left"), band_join(l, r, [("lk", "rk")], "lp", "rp", 1, 7, "left")):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2
