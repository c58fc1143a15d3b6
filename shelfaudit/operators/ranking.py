"""Rank by running count, and the top-k selection on it.

The original ranks a file inside its document by a correlated count of
rows with ``FileID <=`` its own: ties take the highest position, and a NULL
file (or NULL document) gets 0 because the comparison is never true.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfaudit.session import stage


def running_count_rank(df: DataFrame, part: str, order: str, name: str = "rnk",
                       slices: int | None = None) -> DataFrame:
    """Every row with its running-count rank, without sorting a group whole.

    Two-level prefix sum: counts per (group, value) are pre-combined
    map-side; a range repartition on (group, value) cuts even a hot group
    into bounded slices (staged, so every reader sees the same slices); a running sum runs inside each slice; each slice's
    offset is the sum of the earlier slices of its group (a table of at most
    ``slices`` rows per group); the ranks are joined back on (group, value).
    Rows with a NULL group or value rank 0.
    """
    is_zero = F.col(part).isNull() | F.col(order).isNull()
    zeros = df.where(is_zero).withColumn(name, F.lit(0).cast("long"))
    keyed = df.where(~is_zero)
    n = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = keyed.groupBy(part, order).agg(F.count(F.lit(1)).alias("_n"))
    # staged once: the slice of a (group, value) must be the same for the
    # running sums and for the offsets, which two separate range exchanges
    # would not guarantee
    ranged = stage(counts.repartitionByRange(n, part, order).withColumn("_slice", F.spark_partition_id()),
                   "rank_slices")
    inside = Window.partitionBy(part, "_slice").orderBy(order).rowsBetween(Window.unboundedPreceding,
                                                                             Window.currentRow)
    local = ranged.withColumn("_local", F.sum("_n").over(inside))
    totals = ranged.groupBy(part, "_slice").agg(F.sum("_n").alias("_t"))
    earlier = Window.partitionBy(part).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_off", F.coalesce(F.sum("_t").over(earlier), F.lit(0).cast("long")))
    ranks = local.join(offsets.select(part, "_slice", "_off"), [part, "_slice"]).select(
        F.col(part).alias("_kp"), F.col(order).alias("_ko"), (F.col("_local") + F.col("_off")).alias("_rank"))
    hits = keyed.join(ranks, on=[F.col(part) == F.col("_kp"), F.col(order) == F.col("_ko")], how="inner")
    hits = hits.withColumn(name, F.col("_rank").cast("long")).drop("_kp", "_ko", "_rank")
    return hits.unionByName(zeros)


def top_by_running_count(
    df: DataFrame, part: str, order: str, below: int = 4, name: str = "rnk"
) -> DataFrame:
    """Rows whose running-count rank is ``< below`` (rank 0 rows included).

    A value repeated ``below`` times or more already ranks too high, so at
    most ``below - 1`` rows per group qualify. That keeps the work bounded
    on skewed groups: counts per (group, value) are pre-combined map-side,
    the ``below - 1`` smallest values per group are kept by a group limit
    before the shuffle, and only those keys are joined back to the rows.
    No group is ever sorted whole. Rank-0 rows (NULL group or value) need
    no join and never enter the shuffle, so a mass of NULL files cannot
    make a hot join key.
    """
    k = below - 1
    is_zero = F.col(part).isNull() | F.col(order).isNull()
    zeros = df.where(is_zero).withColumn(name, F.lit(0).cast("long"))
    keyed = df.where(~is_zero)
    counts = keyed.groupBy(part, order).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(part).orderBy(F.col(order))
    smallest = counts.withColumn("_dr", F.dense_rank().over(w)).where(F.col("_dr") <= k)
    ranked = smallest.withColumn(
        name,
        F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    ).where(F.col(name) < below)
    keep = ranked.select(
        F.col(part).alias("_kp"), F.col(order).alias("_ko"), F.col(name).cast("long").alias("_rank")
    )
    hits = keyed.join(keep, on=[F.col(part) == F.col("_kp"), F.col(order) == F.col("_ko")], how="inner")
    hits = hits.withColumn(name, F.col("_rank")).drop("_kp", "_ko", "_rank")
    return hits.unionByName(zeros)
