"""Column codes: a text such as ``1;2;3`` names the columns of an extract, in order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType


def parse_codes(text: str) -> list[int]:
    """The codes of a text; spaces and an empty last place are allowed, anything else is an error."""
    parts = [p.strip() for p in text.split(";")]
    if parts and not parts[-1]:
        parts.pop()
    wrong = [p for p in parts if not (p.isascii() and p.isdigit())]
    if wrong:
        raise ValueError(f"not a column code: {wrong[0]!r} in {text!r}")
    return [int(p) for p in parts]


def coded_columns(text: str | None, known: Mapping[int, str | None], every: Sequence[str]) -> list[str]:
    """Columns of the codes in their order; ``every`` column without a text.

    ``known`` maps codes to columns; a code without a column (None) is accepted
    and adds none. Unknown codes, repeated columns and no column at all are errors.
    """
    if text is None:
        return list(every)
    codes = parse_codes(text)
    unknown = [c for c in codes if c not in known]
    if unknown:
        raise ValueError(f"unknown column codes {unknown}; known are {sorted(known)}")
    found = [known[c] for c in codes if known[c] is not None]
    twice = sorted({c for c in found if found.count(c) > 1})
    if twice or not found:
        raise ValueError(f"columns named twice: {twice}" if twice else f"no column in {text!r}")
    return found


def coded_schema(source: DataFrame, text: str, known: Mapping[int, str | None]) -> StructType:
    """The schema of an extract of ``source`` by the codes, known without reading it."""
    return StructType([StructField(c, source.schema[c].dataType, True) for c in coded_columns(text, known, ())])
