"""The whole order of a report: rows in ordered files, and each row's position.

Spark sorts by ranges of the keys, so a sorted DataFrame's partitions are slices
of the order: all rows of equal keys are in one, and slices follow each other.
A row's position is its place within its slice plus the places of the slices
before; nothing is ever sorted or counted in one task but a slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfaudit.session import stage

SLICE = "_slice"


def in_order(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` sorted by the keys, NULL first, with the number of its slice (``_slice``)."""
    return df.orderBy(*[F.asc_nulls_first(k) for k in keys]).withColumn(SLICE, F.spark_partition_id())


def whole_position(df: DataFrame, keys: Sequence[str], name: str = "order_no") -> DataFrame:
    """``df`` with its dense position by the keys, NULL first: rows of equal keys share one, and none is left out.

    The sorted rows are staged once, with the slices they were sorted into.
    """
    ordered = stage(in_order(df, keys), "ordered")
    tuples = ordered.groupBy(SLICE, *keys).agg(F.count(F.lit(1)).alias("_rows"))
    sizes = tuples.groupBy(SLICE).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)  # one row a slice
    before = sizes.select(F.col(SLICE).alias("_s"), F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy(SLICE).orderBy(*[F.asc_nulls_first(k) for k in keys])
    out = ordered.withColumn(name, F.dense_rank().over(within)).join(before, F.col(SLICE) == F.col("_s"))
    return out.withColumn(name, (F.col(name) + F.col("_before")).cast("long")).drop(SLICE, "_s", "_before")


def write_ordered(df: DataFrame, keys: Sequence[str], path: str) -> None:
    """Parquet files whose names follow the order: reading them by name gives the rows in order."""
    df.orderBy(*[F.asc_nulls_first(k) for k in keys]).write.mode("errorifexists").parquet(path)
