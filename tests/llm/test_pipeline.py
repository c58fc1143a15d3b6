"""The corpus pipeline against brute force, stage by stage, and on edge rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from shelfaudit.llm import toxicity
from tests.llm.conftest import EDGE
from tests.llm.test_copies import brute_exact, brute_simhash, classes
from tests.llm.test_models import prose, toxic
from tests.llm.test_native import brute_decontaminate, seq


@pytest.fixture(scope="module")
def tables(spark, docs_of, tmp_path_factory):
    """A folder of documents, labels and benchmark: half of the texts labelled; copies, near copies, leaks."""
    rows = []
    for i in range(240):
        rows.append((i, toxic(120) if i % 5 == 0 else prose(40 + i), f"s{i % 4}"))
    rows += [(300 + i, rows[7][1], "s1") for i in range(20)] + [(330, rows[8][1] + " tail", "s0"), (331, seq(0, 60), "s2"), (332, seq(100, 160), "s2")]
    rows += [(i + 1000 if i is not None else None, t, "e") for i, t in EDGE if i != 8] + [(1001, "ein anderer Text", None), (1004, "One", "e")]
    path = str(tmp_path_factory.mktemp("tables"))
    docs_of(rows, clash=False).withColumn("taken", F.lit("own")).withColumn("kept", F.lit(1)).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, seq(10, 40))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=str)


def one_of_each_class(rows):
    """Of each SimHash class of (id, text) rows one with the smallest id; null last."""
    by_place = [(n, brute_simhash(t)) for n, (_, t) in enumerate(rows)]
    best = {}
    for n, c in enumerate(classes(by_place, 2)):
        key = (rows[n][0] is None, rows[n][0] or 0, n)
        best[c] = min(best.get(c, key), key)
    return sorted((rows[k[-1]] for k in best.values()), key=str)


def without_leaks(rows):
    """Rows by themselves, whatever their ids."""
    return [r for r in rows if not brute_decontaminate([(0, r[1])], [(1, seq(10, 40))])[0][-1]]


def test_decisions_go_by_row(spark, docs_of, tables):
    """Contaminated, copied and near-copied rows under null and repeated ids: those go, rows that share their id stay."""
    text = [prose(60 + i) for i in range(8)]
    leak = seq(0, 60)
    rows = [(None, text[0]), (None, leak), (None, text[1]), (7, text[2]), (7, leak + " x"), (7, text[2]), (7, text[3]), (None, text[3]), (None, text[3]),
            (9, text[4]), (9, text[5]), (None, text[4] + " tail"), (3, text[4] + " tail"), (None, None), (9, ""), (None, ""), (11, text[6]), (11, text[6] + " tail"), (12, "clean")]
    docs = docs_of(rows, clash=False)
    docs = spark.createDataFrame(docs.collect(), docs.schema)

    clean = pairs(pipeline.drop_contaminated(spark, docs, tables))
    assert clean == sorted(without_leaks(rows), key=str) and len(clean) == len(rows) - 2
    near = pairs(pipeline.drop_near_copies(spark, docs, tables))
    assert [r[0] for r in near] == [r[0] for r in one_of_each_class(rows)] and len(near) < len(rows)
    best = {}
    for i, t in rows:
        best[t or ""] = max(best.get(t or "", -1), -1 if i is None else i)
    got = pairs(pipeline.drop_copies(spark, docs, tables))
    assert sorted(((-1 if i is None else i), t or "") for i, t in got) == sorted((i, t) for t, i in best.items())


def test_stages_equal_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns = docs.columns
    steps = dict(pipeline.STAGES)
    assert list(steps) == ["toxicity", "exact dedup", "simhash near-dedup", "benchmark decontamination", "mixing to target weights"]

    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{tables}/labels.parquet"))
    score = docs.withColumn("p", toxicity.score_column(model, F.col("text")))
    clean = steps["toxicity"](spark, docs, tables)
    assert clean.columns == columns
    assert pairs(clean) == pairs(score.filter("p < 0.7"))
    left = {i for i, _ in pairs(clean)}
    assert not any(i in left for i in range(0, 240, 5)) and all(i in left for i in range(240) if i % 5)
    clean = spark.createDataFrame(clean.collect(), clean.schema)

    unique = steps["exact dedup"](spark, clean, tables)
    assert unique.columns == columns
    want = []
    for i, _, _, kept, sha in brute_exact(pairs(clean)):
        want += [(i, sha)] if kept else []
    got = [(r.doc_id, r.sha) for r in unique.select("doc_id", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha")).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    unique = spark.createDataFrame(unique.collect(), unique.schema)

    apart = steps["simhash near-dedup"](spark, unique, tables)
    assert apart.columns == columns
    rows = pairs(unique)
    assert pairs(apart) == one_of_each_class(rows)
    apart = spark.createDataFrame(apart.collect(), apart.schema)

    kept = steps["benchmark decontamination"](spark, apart, tables)
    assert kept.columns == columns
    rows = pairs(apart)
    assert pairs(kept) == without_leaks(rows)
    assert {r[0] for r in rows} - {r[0] for r in pairs(kept)} == {331}
    kept = spark.createDataFrame(kept.collect(), kept.schema)

    mixed = steps["mixing to target weights"](spark, kept, tables).collect()
    sizes = {}
    for r in kept.select("doc_id", "text", "source").collect():
        sizes[r.doc_id, r.source] = len((r.text or "").encode().split())
    assert mixed and all(r["size"] == sizes[r.doc_id, r.source] and 0 < r.taken <= 3 * r["size"] for r in mixed)
    for source in {r.source for r in mixed}:
        own = [r for r in mixed if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 2 * max(sizes.values())


def test_mix_goes_by_row(spark, docs_of):
    """Rows with a null or one repeated id come back as the mix took them: each with its size, none that it left out."""
    from shelfaudit.llm.mixing import mix

    rows = [(None if i % 2 else 7, prose(3 + i), f"s{i % 3}") for i in range(120)]
    docs = docs_of(rows, clash=False)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    got = pipeline.mix_sources(spark, docs, "").collect()
    want = mix(docs).filter("taken > 0").collect()
    figures = lambda r: (str(r.doc_id if "doc_id" in r else r.id), r.source, r["size"], r.taken)
    assert sorted(map(figures, got)) == sorted(map(figures, want)) and len(got) < len(rows)
    assert all(r["size"] == len(r.text.split()) for r in got)


def test_run_and_empty_table(spark, tables, docs_of, tmp_path):
    assert pipeline.ORACLE_SQL is None
    assert pipeline.run(spark, tables).filter("taken > 0").count() > 0
    docs_of(EDGE).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{tables}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_without_small_side_broadcast(spark, tables, monkeypatch):
    from shelfaudit.llm import common

    docs = spark.read.parquet(f"{tables}/documents.parquet")
    whole = pairs(pipeline.drop_copies(spark, docs, tables))
    monkeypatch.setattr(common, "BROADCAST_IDS", 0)
    assert pairs(pipeline.drop_copies(spark, docs, tables)) == whole
