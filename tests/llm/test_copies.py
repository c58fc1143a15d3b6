"""Exact dedup and SimHash near-dedup against brute force."""

import hashlib
import random

import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfaudit.llm import exact_dedup as exact
from shelfaudit.llm import simhash
from tests.llm.conftest import EDGE


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        sha = hashlib.sha256(t.encode()).hexdigest()
        first = True
        for i in sorted(ids, key=lambda x: (x is None, -(x or 0))):
            out.append((i, keep, len(ids), first, sha))
            first = False
    return out


def test_exact_dedup(docs_of):
    rows = EDGE + [(100 + i, "same") for i in range(300)] + [(1000 + i, f"text {i % 40}") for i in range(200)]
    random.Random(1).shuffle(rows)
    got = exact.exact_dedup(docs_of(rows).repartition(5), capacity=8).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_exact(rows)))
    assert exact.exact_dedup(docs_of(rows).limit(0)).count() == 0


def test_equal_hashes_are_chained(docs_of, monkeypatch):
    """Different texts of one hash stay apart, because bytes are compared."""
    texts = [b"a", b"b", b"a", b"c", b"b"]
    batch = pa.RecordBatch.from_arrays([pa.array([7] * 5, pa.int64()), pa.array(texts, pa.binary()), pa.array([[k] for k in range(5)], pa.list_(pa.int64())), pa.array([0] * 5, pa.int32()), pa.array([1] * 5, pa.int32())], ["h", "text", "ids", "share", "shares"])
    (out,) = exact._chain(iter([batch]))
    assert out.column(1).to_pylist() == [0, 1, 0, 2, 1]


def test_directory_doubles_until_buckets_fit(spark):
    hashes = spark.createDataFrame([(random.Random(i).getrandbits(64) - (1 << 63),) for i in range(2000)] + [(5,)] * 500, "h long")
    buckets = exact.directory(hashes, capacity=50)
    assert sum(1 / (1 << d) for d, _ in buckets) == 1  # they tile the key space, in order
    at = [p / (1 << d) for d, p in buckets]
    assert at == sorted(at) and len(buckets) > 40
    assert exact.directory(hashes.limit(0)) == [(0, 0)]


def brute_simhash(text, n=3):
    w = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = [x for x in __import__("re").findall(r"[^\x20\x09-\x0D]+", w)]
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + n]).encode(), 42) for i in range(max(1, len(w) - n + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps, bits):
    """Smallest id reachable, of (id, fp)."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i][1] ^ fps[j][1]).count("1") <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    out = {}
    for i, (d, _) in enumerate(fps):
        if d is not None:
            out[find(i)] = min(out.get(find(i), d), d)
    return [out.get(find(i)) for i in range(len(fps))]


def test_simhash_fingerprints(docs_of):
    rows = [r for r in EDGE if r[0] != 8] + [(50, " ".join(f"w{k % 50}" for k in range(400)))]
    got = sorted((str(r.id), r.fp & (1 << 64) - 1) for r in simhash.fingerprints(docs_of(rows)).collect())
    assert got == sorted((str(i), brute_simhash(t)) for i, t in rows)


@pytest.mark.parametrize(("bits", "limit"), [(2, 64), (2, 2), (1, 2), (0, 64)])
def test_links_and_components(spark, monkeypatch, bits, limit):
    """Chains, stars and full blocks: pairs in small blocks, one-bit neighbours in fuller ones."""
    monkeypatch.setattr(simhash, "BLOCK_LIMIT", limit)
    draw = random.Random(3)
    fps = set()
    for _ in range(25):
        x = draw.getrandbits(64)
        fps.add(x)
        for _ in range(12):  # walks whose steps flip up to three bits
            for _ in range(draw.choice((1, 2, 3))):
                x ^= 1 << draw.randrange(64)
            fps.add(x)
    ids = [(k, x) for k, x in enumerate(sorted(fps, key=lambda _: draw.random()))]
    signed = [(i, x - (1 << 64) if x >> 63 else x) for i, x in ids]
    edges = simhash.links(spark.createDataFrame([(x,) for _, x in signed], "fp long"), bits)
    assert edges.filter(f"bit_count(a ^ b) > {bits}").count() == 0
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    back = {x: i for i, x in signed}
    smallest = {}
    for i, x in signed:
        smallest.setdefault(roots.get(x, x), []).append(i)
    got = [min(smallest[roots.get(x, x)]) for _, x in signed]
    assert got == classes(ids, bits)
    assert back


def test_simhash_near_dedup(docs_of):
    base = " ".join(f"word{k * k % 97}" for k in range(900))
    rows = [r for r in EDGE if r[0] != 8] + [(60, base), (61, base.replace("word4 ", "wurd4 ", 1)), (59, base + " end"), (62, "something else here")]
    got = {(str(r.id), r.fp): r.component_id for r in simhash.simhash_near_dedup(docs_of(rows)).collect()}
    fps = [(i, brute_simhash(t)) for i, t in rows]
    want = {(str(i), x - (1 << 64) if x >> 63 else x): c for (i, x), c in zip(fps, classes(fps, 2))}
    assert got == want
    assert simhash.simhash_near_dedup(docs_of(rows).limit(0)).count() == 0


def test_no_owner_is_idle(spark, docs_of):
    """16 owners of key ranges: each has rows, and none many more than another."""
    docs = docs_of([(i, f"text {i}") for i in range(4000)], clash=False)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        pages = exact.index(docs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    owners = [r["n"] for r in pages.groupBy(F.shiftright("page_row", 33).alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(owners) == 16 and sum(owners) == 4000 and max(owners) <= 2 * min(owners)


def test_a_hot_text_has_many_owners(spark, docs_of, monkeypatch):
    """A third of all rows share a text: it goes to several owners, arrives at each about as often as there are slices
    for it, and the second round makes one chain; other hashes keep one owner."""
    monkeypatch.setattr(exact, "HOT_ROWS", 100)
    rows = [(i if i % 50 else None, f"text {i}" if i % 3 else "hot") for i in range(9000)] + [(i, None) for i in range(1500)]
    docs = docs_of(rows).repartition(12)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        pages = exact.index(docs)
        owners = pages.filter("first IS NOT NULL").groupBy("text_sha256").agg(F.countDistinct(F.shiftright("page_row", 33)).alias("n"), F.count(F.lit(1)).alias("copies")).collect()
        got = exact.exact_dedup(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(owners) == 2 and all(2 <= r.n <= 6 and r.copies == r.n for r in owners)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_exact(rows)))


def test_second_round_compares_bytes():
    """Two texts of one hash in several owners, numbered differently by each."""
    batch = pa.RecordBatch.from_arrays(
        [pa.array([7, 7, 7, 7, 9]), pa.array([0, 0, 1, 1, 0], pa.int32()), pa.array([0, 1, 0, 1, 0], pa.int32()), pa.array([b"a", b"b", b"b", b"a", b"a"])],
        ["h", "share", "link", "first"])
    (out,) = exact._settle(iter([batch]))
    assert out.column(3).to_pylist() == [0, 1, 1, 0, 0]
