"""Uniqueness promises: lookups that should hold a key once, checked during the run.

The original's scalar lookups fail on a repeated key and its updates take any
of the rows. Here a name lookup takes the smallest value and a left join
keeps every row, on purpose; ``KeyChecks`` tells how often that happened. The
figures come with the run (``Observation``), without a second pass; a strict
check ends the run at the first repeated key instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

HELD = "_held"


class KeyChecks:
    """What a run finds out about its lookups' keys.

    ``report()`` waits for the first action on a result and gives, by lookup, the keys that
    have several rows and the most rows that one has. NULL keys match nothing and don't count.
    """

    def __init__(self, strict: bool = False) -> None:
        self.strict = strict
        self._seen: dict[str, Observation] = {}

    def _watch(self, df: DataFrame, name: str, keys: Sequence[str], first: Column) -> DataFrame:
        """``df`` with ``_held`` (rows of the row's key) under watch; ``first`` marks one row of each key."""
        known = F.lit(True)
        for k in keys:
            known = known & F.col(k).isNotNull()
        several = known & (F.col(HELD) > 1)
        if self.strict:
            what = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
            message = F.concat(F.lit(f"{name}: key ("), what, F.lit(") has "), F.col(HELD).cast("string"), F.lit(" rows"))
            return df.where(F.when(several, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
        at = name
        while at in self._seen:
            at += "'"
        self._seen[at] = Observation(at)
        return df.observe(
            self._seen[at], F.count_if(several & first).alias("repeated"), F.coalesce(F.max(F.when(several, F.col(HELD))), F.lit(1)).alias("most"))

    def grouped(self, df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
        """``df`` of one row a key, with ``_held`` as the rows it came from; dropped here."""
        return self._watch(df, name, keys, F.lit(True)).drop(HELD)

    def joined(self, df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
        """``df`` of any rows a key, all kept; counted by the key that a join then uses, so by the same shuffle."""
        own = Window.partitionBy(*keys)
        numbered = df.withColumn(HELD, F.count(F.lit(1)).over(own)).withColumn("_nth", F.row_number().over(own.orderBy(*keys)))
        return self._watch(numbered, name, keys, F.col("_nth") == 1).drop(HELD, "_nth")

    def report(self) -> dict[str, dict[str, int]]:
        return {name: dict(o.get) for name, o in self._seen.items()}


def one_value(df: DataFrame, key: str, value: str, name: str, checks: KeyChecks | None = None) -> DataFrame:
    """(key, value): the smallest value of each key."""
    aggs = [F.min(value).alias(value)] + ([F.count(F.lit(1)).alias(HELD)] if checks else [])
    out = df.groupBy(key).agg(*aggs)
    return checks.grouped(out, name, [key]) if checks else out
