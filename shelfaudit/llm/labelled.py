"""The bounded training sample of the two classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfaudit.llm.common import binary, fold_of
from shelfaudit.session import stage

#: Documented bounds: labelled rows a classifier is fitted on, the first by a hash of their id; bytes of their texts; and of one text.
TRAIN_ROWS, TRAIN_BYTES, LONGEST = 4000, 24 << 20, 1 << 20


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, folds: int, held_fold: int, rows: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Staged (t binary, y int): up to ``rows`` whole labelled texts of ``most_bytes`` together, outside the held-out fold.

    A null label or id is no label; an id labelled twice counts with its larger
    label, a row that is there twice once; texts beyond LONGEST bytes train
    nothing. The ids, then the rows, are chosen by (id, hash, size) alone, ``rows`` of each
    at most, so both lists are broadcast and only the sample's texts move.
    """
    known = (
        labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold_of(F.col(id_col), folds) != held_fold))
        .groupBy(F.col(id_col).cast("long").alias("__id")).agg(F.max(F.col(label_col)).cast("int").alias("y"))
        .orderBy(F.xxhash64("__id"), "__id").limit(rows)
    )
    texts = docs.select(F.col(id_col).cast("long").alias("__id"), binary(F.col(text_col)).alias("t")).join(F.broadcast(known), "__id")
    texts = texts.filter(F.length("t") <= LONGEST).withColumn("h", F.xxhash64("t"))
    # an id may be that of many rows
    found = texts.groupBy("__id", "h").agg(F.max(F.length("t")).alias("size")).orderBy(F.xxhash64("__id"), "__id", "h").limit(rows)
    upto = F.sum("size").over(Window.orderBy(F.xxhash64("__id"), "__id", "h").rowsBetween(Window.unboundedPreceding, 0))  # of ``rows`` rows
    chosen = stage(found.withColumn("upto", upto).filter(F.col("upto") <= most_bytes).select("__id", "h"), "labelled-rows")
    return stage(texts.join(F.broadcast(chosen), ["__id", "h"]).dropDuplicates(["__id", "h"]).select("t", "y"), "labelled-sample")


def best_cut(scores, y) -> float:
    """The score that separates the labels with the best mean of the two recalls (midpoint between neighbours)."""
    import numpy as np

    order = np.argsort(scores, kind="stable")
    s, pos = np.asarray(scores, float)[order], np.asarray(y)[order] == 1
    n1, n0 = max(1, pos.sum()), max(1, (~pos).sum())
    gain = np.concatenate(([0.0], np.cumsum(np.where(pos, -1 / n1, 1 / n0))))  # cut before the i-th
    same = np.concatenate(([False], s[1:] == s[:-1], [False]))
    gain[same] = -np.inf
    top = np.flatnonzero(gain >= gain.max() - 1e-12)
    i = int(top[len(top) // 2])
    if 0 < i < len(s):
        return float((s[i - 1] + s[i]) / 2)
    return float(s[0] - 1 if i == 0 else s[-1] + 1) if len(s) else 0.0
