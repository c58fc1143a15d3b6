import random

from shelfaudit.operators.ranking import running_count_rank, top_by_running_count


def _files(spark):
    return spark.createDataFrame(
        [(1, "a", 5), (2, "a", 5), (3, "a", 7), (4, "a", None), (5, "a", 9), (6, "b", None), (7, None, 3)],
        "k int, doc string, file int")


def test_running_count_rank_ties_high_and_nulls_zero(spark):
    got = {r.k: r.rnk for r in running_count_rank(_files(spark), "doc", "file").collect()}
    assert got == {1: 2, 2: 2, 3: 3, 4: 0, 5: 4, 6: 0, 7: 0}


def test_top_files_below_four(spark):
    got = {r.k: r.rnk for r in top_by_running_count(_files(spark), "doc", "file", 4).collect()}
    assert got == {1: 2, 2: 2, 3: 3, 4: 0, 6: 0, 7: 0}


def test_top_matches_brute_force_with_hot_group(spark):
    rnd = random.Random(7)
    rows = []
    for k in range(3000):
        doc = "hot" if rnd.random() < 0.4 else f"d{rnd.randrange(40)}"
        f = None if rnd.random() < 0.1 else rnd.randrange(60)
        rows.append((k, doc, f))
    df = spark.createDataFrame(rows, "k int, doc string, file int")
    expect = {}
    for k, doc, f in rows:
        r = 0 if f is None else sum(1 for _, d2, f2 in rows if d2 == doc and f2 is not None and f2 <= f)
        if r < 4:
            expect[k] = r
    got = {r.k: r.rnk for r in top_by_running_count(df, "doc", "file", 4).collect()}
    assert got == expect


def test_full_rank_matches_brute_force_with_hot_group(spark):
    rnd = random.Random(21)
    rows = []
    for k in range(2500):
        doc = "hot" if rnd.random() < 0.4 else f"d{rnd.randrange(30)}"
        f = None if rnd.random() < 0.1 else rnd.randrange(400)
        rows.append((k, doc, f))
    rows.append((9999, None, 3))
    df = spark.createDataFrame(rows, "k int, doc string, file int")
    expect = {}
    for k, doc, f in rows:
        if f is None or doc is None:
            expect[k] = 0
        else:
            expect[k] = sum(1 for _, d2, f2 in rows if d2 == doc and f2 is not None and f2 <= f)
    for slices in (1, 7):
        got = {r.k: r.rnk for r in running_count_rank(df, "doc", "file", slices=slices).collect()}
        assert got == expect, slices
