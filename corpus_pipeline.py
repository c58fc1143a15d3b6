"""The corpus pipeline: five stages over `documents`, each on all that its predecessor kept.

Toxic documents go, then exact copies (the largest id stays), then SimHash
near-duplicates (the smallest id of each group stays), then documents that
hold a benchmark passage; what is left is mixed to the sources' target weights.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame: all but the
last the columns of ``docs``, the last one the columns of ``docs`` with size,
source_size, target and taken (words the mix takes, repeats counted) of each
document it takes at least once.

Decisions go by row, never by id: a stage that needs an operator's verdict
writes its rows once with a number each, gives the operator that number as the
id, and joins the verdict back by it. Null and repeated ids therefore lose
nothing; where one row of a group stays, it is chosen by ``doc_id`` (null last),
then by row.

Defined results: null or empty texts are clean, equal each other, and have
size 0, so the mix leaves them out; of equal rows one stays; an empty table
runs through; further columns are passed on (the mix's own four replace any of
these names).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfaudit.llm import decontaminate as decon
from shelfaudit.llm import exact_dedup as exact
from shelfaudit.llm import mixing, simhash, toxicity
from shelfaudit.llm.common import BROADCAST_IDS, keep_ids, table
from shelfaudit.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score doesn't reject; learned from `labels` of all folds but the held-out one."""
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.score_column(model, F.col("text")) < toxicity.CUT)


def _numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with ``__row``, written once, so that the number of a row stays what it is."""
    return stage(docs.withColumn("__row", F.monotonically_increasing_id()), name)


def _one_of_each(rows: DataFrame, groups: DataFrame, largest: bool) -> DataFrame:
    """``rows`` without those of a group (row, group) that aren't its one row with the largest (smallest) id."""
    order = F.col("doc_id").cast("long")
    first = F.struct(F.col("doc_id").isNull().alias("none"), (-order if largest else order).alias("id"), F.col("row").alias("row"))
    members = stage(groups.join(rows.select(F.col("__row").alias("row"), "doc_id"), "row"), "pipeline-members")
    stays = members.groupBy("group").agg(F.min(first)["row"].alias("row"))
    gone = members.join(stays, "row", "left_anti").select("row")  # by row: a group may hold a third of all
    return keep_ids(rows, "__row", stage(gone, "pipeline-gone"), "left_anti").drop("__row")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the largest id."""
    rows = _numbered(docs, "pipeline-exact")
    found = exact.exact_dedup(rows, id_col="__row")
    return _one_of_each(rows, found.select(F.col("id").alias("row"), F.col("keep_id").alias("group")), largest=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the smallest id."""
    rows = _numbered(docs, "pipeline-near")
    found = simhash.simhash_near_dedup(rows, words=3, max_bits=2, id_col="__row")
    return _one_of_each(rows, found.select(F.col("id").alias("row"), F.col("component_id").alias("group")), largest=False)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    rows = _numbered(docs, "pipeline-leaks")
    found = decon.decontaminate(rows, table(spark, sf_dir, "benchmark"), window=10, id_col="__row")
    gone = stage(found.filter("contaminated").select("id"), "pipeline-contaminated")
    return keep_ids(rows, "__row", gone, "left_anti").drop("__row")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with size, source_size, target and taken."""
    figures = ["size", "source_size", "target", "taken"]
    docs = _numbered(docs.drop(*figures), "pipeline-rows")
    found = stage(mixing.mix(docs, row_col="__row").filter("taken > 0").select(F.col("row").alias("__taken"), *figures), "pipeline-mix")
    few = found.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return docs.join(F.broadcast(found) if few else found, F.col("__row") == F.col("__taken")).drop("__row", "__taken")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing to target weights", mix_sources),
]

#: The toxicity model and XXH64 have no SQL form; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{k}")
    return docs
