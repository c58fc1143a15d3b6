"""Order facts: document headers times their active attribute lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfaudit.functions.period import period_filter

FACT_COLS = ("masterfid", "mfid", "orid", "ortype", "attrid", "ordate", "attrtext", "id", "dictid")


def order_heads(
    orders: DataFrame,
    visits: DataFrame,
    bounds: tuple[Column, Column],
    doc_types: Sequence[int],
    day_col: str | None = None,
) -> DataFrame:
    """Headers in the period with a fact type, of a visited agent and of a
    visited outlet.

    Agent and outlet are two separate semi-joins, so an agent-outlet pair
    that never met still passes (the original's two INs). Period and type
    reach the scan as pushed filters; static sizes and AQE choose the joins.
    """
    return (
        period_filter(orders, "ordate", bounds, day_col=day_col).where(F.col("ortype").isin(list(doc_types)))
        .where(F.col("masterfid").isin(visits.select("masterfid")))
        .where(F.col("mfid").isin(visits.select("fid")))
        .select("masterfid", "mfid", "orid", "ortype", "ordate")
    )


def id_filter(attrs: DataFrame, lo, hi, block: tuple[str, int] | None = None) -> DataFrame:
    """``orid BETWEEN lo AND hi``.

    ``block`` = (column, size) adds the same range on a partition column that
    whoever writes the lines guarantees to hold ``floor(orid / size)``; whole
    partitions are then pruned. It is the layout's promise, never inferred.
    """
    out = attrs.where(F.col("orid").between(F.lit(lo), F.lit(hi)))
    if block is not None and lo is not None:
        column, size = block
        out = out.where(F.col(column).between(F.lit(lo // size), F.lit(hi // size)))
    return out


def facts_from_heads(heads: DataFrame, attrs: DataFrame, ids: tuple | None = None,
                     block: tuple[str, int] | None = None, own: DataFrame | None = None) -> DataFrame:
    """Join headers to their active lines.

    The original's outer join is cancelled by its WHERE on the line side,
    so it is an inner join. ``ids`` = (smallest, largest id) of the headers
    becomes a superset filter on the lines that reaches the scan (row groups
    skip where lines are clustered by document id) and that drops all other
    days' lines before any shuffle. Static sizes and AQE choose the join. Where
    the lines are themselves a join with documents, ``own_lines`` goes below it;
    ``own`` are the headers' staged ids, if there are any.
    """
    lines = attrs.where(F.col("activeflag") == 1)
    if ids is not None:
        lines = id_filter(lines, *ids, block)
    lines = own_lines(lines.select("masterfid", "orid", "attrid", "attrtext", "id", "dictid"), heads if own is None else own)
    return heads.join(lines, on=["masterfid", "orid"], how="inner").select(*FACT_COLS)


def id_range(heads: DataFrame) -> tuple:
    """(smallest id, largest id) of the headers: one aggregate, two scalars."""
    row = heads.agg(F.min("orid").alias("lo"), F.max("orid").alias("hi")).first()
    return (row.lo, row.hi)


def order_facts(
    orders: DataFrame,
    attrs: DataFrame,
    visits: DataFrame,
    bounds: tuple[Column, Column],
    doc_types: Sequence[int],
    day_col: str | None = None,
) -> DataFrame:
    """Headers of visited agents and outlets joined to their active lines."""
    return facts_from_heads(order_heads(orders, visits, bounds, doc_types, day_col), attrs)


def lines_of_documents(attrs: DataFrame, docs: DataFrame, ids: tuple | None = None,
                       block: tuple[str, int] | None = None) -> DataFrame:
    """The EAV lines restricted to the documents' id range (a pushed superset
    filter; the exact match is the caller's join)."""
    return id_filter(attrs, *(ids if ids is not None else id_range(docs)), block)


def own_lines(lines: DataFrame, docs: DataFrame) -> DataFrame:
    """The lines of exactly these documents: an IN, keyed as the join that follows, so it adds no shuffle of
    the lines; where the lines are a join with documents, Spark moves it to the documents' side as a predicate."""
    return lines.where(F.struct("masterfid", "orid").isin(docs.select("masterfid", "orid")))
