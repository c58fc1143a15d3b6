"""License scan, mixing and decontamination against brute force; edge rows; native plans."""

import hashlib
import re

import pytest

from shelfaudit.llm.decontaminate import decontaminate
from shelfaudit.llm.license_rules import RULES, STEMS
from shelfaudit.llm.license_scan import BASE, license_scan
from shelfaudit.llm.mixing import mix, source_targets
from tests.llm.conftest import EDGE

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


LICENSES = [
    (20, "Licensed under the Apache License, Version 2.0."), (21, "apache license. APACHE-LICENSE; mit license"),
    (22, "GNU General Public License v3 or CC BY-NC 4.0, cc by, cc-by"), (23, "submit license; limit license mit licenses"),
    (24, "SPDX-License-Identifier: GPL-3.0-or-later"), (25, "This is free and unencumbered software released into the public domain. BSD 3-Clause License"),
    (26, "the GNU Lesser General Public License, version 2.1"), (27, "Mozilla Public License 2.0 Mozilla Public License 2.0"),
]


def expected_license(text):
    w = words(text)
    starts, labels = [], set()
    for phrase, label in BASE:
        p = phrase.split()
        found = [i for i in range(len(w)) if w[i:i + len(p)] == p]
        starts += found
        labels |= {label} if found else set()
    s = " " + " ".join(w) + " "
    found = sorted((s[:m.start(1)].count(" ") - 1, -(s[:m.start(1)].count(" ") + m.group(1).count(" ")), r.priority, r.label, r.confidence) for r in RULES for m in re.finditer(f" ({r.pattern})(?= )", s))
    far, kept = 0, []
    for d in found:
        if -d[1] > far:
            far = -d[1]
            kept.append(d)
    best = max([d[4] for d in kept] + [0.8] * bool(labels) + [0.0])
    return (len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | {d[3] for d in kept})), best)


def test_license_scan_equals_brute_force(docs_of):
    rows = EDGE + LICENSES
    got = license_scan(docs_of(rows)).collect()
    key = lambda x: (x[0] is None, x[0] or 0, str(x[1:]))
    assert sorted([(r.id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in got], key=key) == sorted([(i, *expected_license(t)) for i, t in rows], key=key)
    by = {r.id: r for r in got}
    assert by[24].labels == "gpl-3.0-or-later" and by[24].score == 1.0
    # the lesser license's interval holds the plain one's
    assert by[26].labels == "lgpl-2.1" and [(d.start, d.to) for d in by[26].detections] == [(1, 9)]
    assert by[27].detections[0].to == by[27].detections[1].start


def samples(pattern):
    """Strings of a rule's pattern: each optional part left out and put in, each alternative."""
    m = re.search(r"\(\?:([^()]*)\)(\?|\*|\{0,6\})?", pattern)
    if m:
        out = []
        for a in m.group(1).split("|") + ([""] if m.group(2) else []):
            out += samples(pattern[:m.start()] + a + pattern[m.end():])
        return out[:64]
    p = re.sub(r"\[\^ \]\+", "x", re.sub(r"\[0-9\]\{3\}", "999", pattern))
    p = re.sub(r"\[a-z0-9\]\+|\[0-9\]\+", "7", p)
    p = re.sub(r"\[(.)[^\]]*\]", r"\1", p)
    m = re.search(r"(.)\?", p)
    return samples(p[:m.start()] + p[m.end():]) + samples(p[:m.start()] + m.group(1) + p[m.end():]) if m else [p]


def test_license_prefilters_are_necessary():
    assert len(RULES) > 200
    for r in RULES:
        assert any(s in r.literal for s in STEMS), r
        for s in samples(r.pattern):
            assert re.fullmatch(r.pattern, s), (r, s)
            assert r.literal in s and not re.search(r"[^a-z0-9 ]", s), (r, s)


def brute_decontaminate(docs, items, window=10):
    wins = {}
    for item, t in items:
        w = words(t)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[i:i + n]), set()).add("" if item is None else str(item))
    lens = {len(k) for k in wins}
    out = []
    for d, t in docs:
        w, hit, held = words(t), set(), set()
        for n in lens:
            for i in range(len(w) - n + 1):
                k = tuple(w[i:i + n])
                if k in wins:
                    hit |= set(range(i, i + n))
                    held |= wins[k]
        out.append((d, len(w), len(hit), len(held), hashlib.sha256(",".join(sorted(held)).encode()).hexdigest(), bool(hit)))
    return out


def items_of(spark, items):
    return spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id long")


def seq(a, b):
    return " ".join(f"t{i}" for i in range(a, b))


DOCS = EDGE + [
    (30, seq(0, 40)), (31, seq(3, 12)), (32, seq(0, 10) + " x " + seq(5, 30)), (33, "the the the the the the the the the the the the"),
    (34, "Short ITEM!"), (35, "short, item short item"), (36, seq(20, 33) + " " + seq(20, 33)), (36, seq(20, 33)), (37, "solo"),
]
ITEMS = [(1, seq(0, 25)), (2, seq(20, 33)), (20, seq(20, 33)), (3, "short item"), (4, "the " * 10), (5, None), (6, " ,. "), (None, seq(50, 60)), (7, "solo"), (7, "solo")]


@pytest.mark.parametrize("items", [ITEMS, [(5, None)]])
def test_decontaminate_equals_brute_force(spark, docs_of, items):
    got = decontaminate(docs_of(DOCS), items_of(spark, items)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_decontaminate(DOCS, items)))


def test_decontaminate_in_blocks(spark, docs_of, monkeypatch):
    from shelfaudit.llm import decontaminate as module

    monkeypatch.setattr(module, "BLOCK", 7)
    got = decontaminate(docs_of(DOCS), items_of(spark, ITEMS)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_decontaminate(DOCS, ITEMS)))


@pytest.mark.parametrize("block", [200_000, 3])
def test_decontaminate_reads_documents_once(spark, tmp_path, monkeypatch, block):
    """Items of one, two and twelve words, with and without the bitmap in front of a shuffle."""
    from pyspark.sql import functions as F

    from shelfaudit.llm import decontaminate as module

    monkeypatch.setattr(module, "BLOCK", block)
    spark.createDataFrame([(1, seq(0, 30) + " solo two words")], "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    windows, _ = module._windows(items_of(spark, [(1, "solo"), (2, "two words"), (3, seq(4, 16))]), 10, 3, "item_id", "text")
    grams = windows.select("k", F.explode("grams").alias("g")).distinct().withColumn("gram_id", F.monotonically_increasing_id())
    places = module._places(docs, grams, 3, "doc_id", "text")
    plan = places._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan" in x and str(tmp_path) in x for x in plan.splitlines()) == 1
    assert sorted(r.pos for r in places.filter("gram_id is not null").collect()) == [*range(4, 14), 30, 31]
    assert ("bitmap_construct_agg" in plan) == (block == 3)


def test_mix_fills_targets(docs_of):
    rows = [(i, "w " * (1 + i % 7), f"s{i % 3}" if i % 11 else None) for i in range(400)] + [(i, t, "e") for i, t in EDGE]
    got = mix(docs_of(rows)).collect()
    assert len(got) == len(rows)
    total = sum(r.size for r in got)
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        size, target = sum(r.size for r in own), own[0].target
        assert all(r.source_size == size and r.target == target for r in own)
        assert target <= 3 * size + 1e-6
        assert abs(sum(r.taken for r in own) - target) <= max(r.size for r in got)
    assert abs(sum({r.source: r.target for r in got}.values()) - total) < 1e-6 * total
    assert sum(r.taken for r in got) <= total
    assert all(r.taken % r.size == 0 and r.taken <= 3 * r.size if r.size else r.taken == 0 for r in got)
    again = mix(docs_of(rows).repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mix_refines_ranges(docs_of, monkeypatch):
    from shelfaudit.llm import mixing

    rows = [(i, "w " * (1 + i % 5), f"s{i % 4}") for i in range(300)]
    whole = sorted(map(str, mix(docs_of(rows)).collect()))
    monkeypatch.setattr(mixing, "LAST_RANGE", 1)
    monkeypatch.setattr(mixing, "RANGE_BITS", 4)
    assert sorted(map(str, mix(docs_of(rows)).collect())) == whole


def test_targets_stop_at_their_cap(spark):
    sized = spark.createDataFrame([("a", 1), ("b", 1000), ("c", 10), (None, 2)], "source string, size long")
    got = {r.source: r.target for r in source_targets(sized).collect()}
    # weights 5, 2, 1 and again 5; a and null stop at 3 and 6, c at 30, b takes the rest
    assert got == {"a": 3.0, None: 6.0, "c": 30.0, "b": 974.0}


@pytest.mark.parametrize("seed", range(3))
def test_targets_equal_a_plain_loop(spark, seed):
    import random

    rng = random.Random(seed)
    size = {f"s{i:03d}": rng.choice([0, 1, 7, 50, 4_000, 100_000, 9_000_000]) for i in range(120)}
    got = {r.source: r.target for r in source_targets(spark.createDataFrame(list(size.items()), "source string, size long")).collect()}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(size))}
    total, full = sum(size.values()), set()
    while True:
        share = (total - sum(3 * size[s] for s in full)) / sum(w for s, w in weight.items() if s not in full)
        more = {s for s in size if weight[s] * share > 3 * size[s]} | full
        if more == full:
            break
        full = more
    want = {s: 3.0 * size[s] if s in full else weight[s] * share for s in size}
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s], rel=1e-12) for s in want)


def test_mix_cuts_rows_of_one_id(docs_of):
    from shelfaudit.llm import mixing

    rows = [(None, "w " * (1 + i % 3), "hot") for i in range(3_000)] + [(i, "w", "b") for i in range(50)]
    sized = mixing.sizes(docs_of(rows).repartition(8))
    ordered = mixing._in_order(sized, 42).filter("source = 'hot'").collect()
    upto, so_far = sorted(r.upto for r in ordered), 0
    for size, end in zip(sorted(r.size for r in ordered), upto, strict=True):  # one id: by size
        so_far += size
        assert end == so_far


def test_empty_tables(spark, docs_of):
    none = docs_of(EDGE).limit(0)
    assert license_scan(none).count() == 0
    assert mix(none).count() == 0
    assert decontaminate(none, items_of(spark, ITEMS)).count() == 0


def test_native_plans_have_no_python(spark, docs_of):
    docs = docs_of(EDGE)
    for df in (license_scan(docs), mix(docs), decontaminate(docs, items_of(spark, ITEMS))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
