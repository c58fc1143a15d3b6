"""Text and number formatting helpers of the report."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def contains_any(col: str | Column, parts: Iterable[str], ci: bool = False) -> Column:
    """``col LIKE '%a%' OR col LIKE '%b%' ...`` (binary compare unless ``ci``)."""
    c = _c(col)
    if ci:
        c = F.lower(c)
    cond = F.lit(False)
    for p in parts:
        cond = cond | c.contains(p.lower() if ci else p)
    return cond


def prefix_in(col: str | Column, prefixes: Iterable[str], width: int = 3, ci: bool = False) -> Column:
    """``LEFT(col, width)`` equals one of ``prefixes`` (a 3-char LIKE '%abc%')."""
    c = F.left(_c(col), F.lit(width))
    vals = list(prefixes)
    if ci:
        c = F.lower(c)
        vals = [v.lower() for v in vals]
    return c.isin(vals)


def text_or_zero(col: str | Column) -> Column:
    """``ISNULL(text, 0)``: the result is text, so the default is ``'0'``."""
    return F.coalesce(_c(col), F.lit("0"))


# a plain decimal number, with an exponent or not; type suffixes, hexadecimal,
# NaN and Infinity, which a cast would take, are bad text
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def to_number(col: str | Column) -> Column:
    """``ISNULL(CAST(text AS FLOAT), 0)``; empty or bad text counts as 0."""
    c = _c(col).cast("string")
    return F.coalesce(F.when(c.rlike(NUMBER), c.try_cast("double")), F.lit(0.0))


def row_total(*cols: str | Column) -> Column:
    """Sum of text counters converted to numbers, NULL and bad text as 0."""
    total = None
    for col in cols:
        term = to_number(col)
        total = term if total is None else total + term
    return total


def count_total(*cols: str | Column) -> Column:
    """``ISNULL(a,0) + ISNULL(b,0) + ...`` over integer counters."""
    total = None
    for col in cols:
        term = F.coalesce(_c(col), F.lit(0))
        total = term if total is None else total + term
    return total


def dot_to_comma(col: str | Column) -> Column:
    """``REPLACE(text, '.', ',')``."""
    return F.replace(_c(col), F.lit("."), F.lit(","))


def blank_zero(col: str | Column) -> Column:
    """Zero shown as empty text, any other number as its text; NULL stays NULL."""
    c = _c(col)
    return F.when(c == 0, F.lit("")).otherwise(c.cast("string"))


def presence_percent(facing: str | Column, listed: str | Column) -> Column:
    """Facing / listed x 100 cut to an integer, as text.

    Empty when either side is 0, NULL when either is NULL. Integer division
    gives the original's value for 1..9 and does not overflow above it.
    """
    f, n = _c(facing), _c(listed)
    return (
        F.when((n != 0) & (f != 0), F.floor((f * 100) / n).cast("long").cast("string"))
        .when((n == 0) | (f == 0), F.lit(""))
    )


def concat_strict(*parts: str | Column) -> Column:
    """``a + b + ...`` on text: NULL when any part is NULL."""
    return F.concat(*[_c(p).cast("string") for p in parts])


def split_address(col: str | Column, fields: Mapping[str, str]) -> dict[str, Column]:
    """One ``regexp_extract`` (group 1) per output field; no match gives ''."""
    c = _c(col)
    return {name: F.regexp_extract(c, pattern, 1) for name, pattern in fields.items()}
