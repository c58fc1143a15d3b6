"""Distance joins on a whole-number position within equal keys.

``right.pos - left.pos`` equal to a constant, in a list, or inside a band.
Both forms expand the right side and stay one equi-join, so work per row is
bounded by the offsets and a hot key never turns into all pairs of its group;
a left join is the same join, with unmatched left rows kept once.

Positions must be of an integral type: a fractional position has no exact
bucket, so it is refused rather than approximated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _check(left: DataFrame, right: DataFrame, left_pos: str, right_pos: str, how: str) -> None:
    for df, col in ((left, left_pos), (right, right_pos)):
        if not isinstance(df.schema[col].dataType, T.IntegralType):
            raise TypeError(f"position {col} must be a whole number, not {df.schema[col].dataType.simpleString()}")
    if how not in ("inner", "left"):
        raise ValueError(f"inner and left are supported, not {how!r}")


def offset_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    left_pos: str,
    right_pos: str,
    offsets: Sequence[int],
    how: str = "inner",
) -> DataFrame:
    """Rows with ``right_pos - left_pos`` in ``offsets`` and equal keys.

    Each right row is repeated at the left positions it can partner with; a
    pair meets at exactly one of them. Columns must not share names.
    """
    _check(left, right, left_pos, right_pos, how)
    offs = F.array(*[F.lit(o) for o in sorted(set(int(o) for o in offsets))])
    back = right.withColumn("_at", F.explode(F.transform(offs, lambda o: F.col(right_pos).cast("long") - o)))
    cond = [F.col(lk) == F.col(rk) for lk, rk in keys]
    cond.append(F.col(left_pos).cast("long") == F.col("_at"))
    return left.join(back, on=cond, how=how).drop("_at")


def band_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    left_pos: str,
    right_pos: str,
    lo: int,
    hi: int,
    how: str = "inner",
) -> DataFrame:
    """Rows with ``right_pos - left_pos BETWEEN lo AND hi`` and equal keys.

    Buckets of the band's width, in whole-number arithmetic: a left row lies
    in one bucket, a right row is repeated in the one or two buckets that
    hold its partners, and the exact test is part of the join condition.
    """
    _check(left, right, left_pos, right_pos, how)
    if hi < lo:
        raise ValueError("empty band")
    width = F.lit(hi - lo + 1).cast("long")

    def bucket(pos):
        return F.call_function("div", pos - F.pmod(pos, width), width)

    at = F.col(right_pos).cast("long")
    buckets = F.array_distinct(F.array(bucket(at - hi), bucket(at - lo)))
    lb = left.withColumn("_lb", bucket(F.col(left_pos).cast("long")))
    rb = right.withColumn("_rb", F.explode(buckets))
    cond = [F.col(lk) == F.col(rk) for lk, rk in keys]
    cond.append(F.col("_lb") == F.col("_rb"))
    cond.append((at - F.col(left_pos).cast("long")).between(lo, hi))
    return lb.join(rb, on=cond, how=how).drop("_lb", "_rb")


def distance_lookup(
    keys_df: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    left_pos: str,
    right_pos: str,
    offsets: Sequence[int] | None = None,
    band: tuple[int, int] | None = None,
) -> DataFrame:
    """Partners of every distinct ``(keys, left_pos)`` of ``keys_df`` with a
    position; positions without a partner are absent (``attach`` keeps their rows).

    Build it from the small inputs that determine the keys (e.g. visit keys
    times the day's documents), then ``attach`` it to a wide row set.
    """
    distinct = keys_df.where(F.col(left_pos).isNotNull()).select(*[lk for lk, _ in keys], left_pos).distinct()
    if band is not None:
        return band_join(distinct, right, keys, left_pos, right_pos, band[0], band[1])
    return offset_join(distinct, right, keys, left_pos, right_pos, list(offsets or []))


def attach(df: DataFrame, lookup: DataFrame, keys: Sequence[str], pos: str, prefix: str = "_lk") -> DataFrame:
    """Left-join a ``distance_lookup`` on its keys and position."""
    renamed = lookup.select(
        *[F.col(k).alias(f"{prefix}_{k}") for k in [*keys, pos]],
        *[c for c in lookup.columns if c not in (*keys, pos)],
    )
    cond = [df[k] == renamed[f"{prefix}_{k}"] for k in [*keys, pos]]
    return df.join(renamed, cond, "left").drop(*[f"{prefix}_{k}" for k in [*keys, pos]])
