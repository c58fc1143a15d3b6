"""Entity-attribute-value helpers: filtered lookups and conditional-max pivots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_max(
    df: DataFrame,
    group_cols: Sequence[str],
    key_col: str,
    mapping: Mapping[str, int],
    value_col: str = "attrtext",
    missing: str = "",
) -> DataFrame:
    """``MAX(CASE WHEN key = code THEN value ELSE '' END)`` per output column.

    Unlike ``groupBy().pivot()`` a code with no row gives ``''``, not NULL.
    Pivoting by an id that is also a grouping column (the main-places form)
    leaves one filled column per row; that is the original's result.
    One hash aggregate with a partial (map-side) step, so hot groups are
    pre-combined before the shuffle.
    """
    aggs = [
        F.max(F.when(F.col(key_col) == code, F.col(value_col)).otherwise(F.lit(missing))).alias(name)
        for name, code in mapping.items()
    ]
    return df.groupBy(*group_cols).agg(*aggs)


def master_attribute(
    objattrs: DataFrame,
    attr_id: int,
    dict_id: int | None = None,
    active: bool = False,
) -> DataFrame:
    """Rows of the master-data EAV for one attribute (the right side of a lookup)."""
    cond: Column = F.col("attrid") == attr_id
    if dict_id is not None:
        cond = cond & (F.col("dictid") == dict_id)
    if active:
        cond = cond & (F.col("activeflag") == 1)
    return objattrs.where(cond)
