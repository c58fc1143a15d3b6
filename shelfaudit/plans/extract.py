"""Extracts of visits, outlets/persons and documents through filter sets.

The helper procedures of the original take column codes and a filter table
by name; here each is a DataFrame function with a text of column codes (all
columns by default) and a ``FilterSet``. Their bodies are not in the original;
the contracts below are inferred from the call sites (see README).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfaudit.config import AuditCodes
from shelfaudit.operators.filters import Binding, FilterSet, apply_filters
from shelfaudit.sources.columns import coded_columns
from shelfaudit.sources.tables import FACE_COLS, ORDER_COLS, VISIT_COLS


def caller_filter(spark: SparkSession, bounds, codes: AuditCodes, base: FilterSet | None = None) -> FilterSet:
    """The caller's filter with the report period added, copied to a working set."""
    fs = base if base is not None else FilterSet.empty(spark)
    return fs.add_period(bounds, codes.flt_period)


def caller_rows(rows: DataFrame, codes: AuditCodes) -> FilterSet:
    """A caller's filter table, in which the report's period is a row."""
    return FilterSet.from_rows(rows, period_type=codes.flt_period)


def _owner(codes: AuditCodes) -> Binding:
    """Owner rows are (dictionary, owner): those of another dictionary name no owner of these extracts."""
    return Binding("ownerdistid", "id2", fixed=(("id", codes.flt_owner_dict),))


def extract_visits(visit_source: DataFrame, fs: FilterSet, codes: AuditCodes, day_col: str | None = None,
                   columns: str | None = None) -> DataFrame:
    """Visits inside the period and the caller's agent/outlet/owner filters."""
    bindings = {
        codes.flt_agent: Binding("masterfid"),
        codes.flt_outlet: Binding("fid"),
        codes.flt_owner: _owner(codes),
    }
    found = apply_filters(visit_source, fs, bindings, period_column="vdate", day_col=day_col)
    return found.select(*coded_columns(columns, codes.visit_columns, VISIT_COLS))


def visit_filter(visits: DataFrame, codes: AuditCodes) -> FilterSet:
    """Rebuilt set: the visits' agents and outlets (one UNION), and their owners."""
    spark = visits.sparkSession
    return (
        FilterSet.empty(spark)
        .add_ids(codes.flt_agent, visits, "masterfid")
        .add_ids(codes.flt_outlet, visits, "fid")
        .add_ids(codes.flt_owner, visits, "ownerdistid", id=codes.flt_owner_dict, target="id2")
    )


def extract_faces(faces: DataFrame, fs: FilterSet, codes: AuditCodes, columns: str | None = None) -> DataFrame:
    """Outlets and persons of the set: agents OR outlets, AND the owners."""
    bindings = {
        codes.flt_agent: Binding("fid", group="person"),
        codes.flt_outlet: Binding("fid", group="person"),
        codes.flt_owner: _owner(codes),
    }
    return apply_filters(faces, fs, bindings).select(*coded_columns(columns, codes.face_columns, FACE_COLS))


def document_filter(spark: SparkSession, bounds, codes: AuditCodes) -> FilterSet:
    """Rebuilt set: the period, the document-type allowlist and the flag row."""
    return (
        FilterSet.empty(spark)
        .add_period(bounds, codes.flt_period)
        .add_constants(codes.flt_doc_type, codes.doc_allowlist)
        .add_constants(codes.flt_flag, [1])
    )


def extract_documents(orders: DataFrame, fs: FilterSet, codes: AuditCodes, day_col: str | None = None,
                      columns: str | None = None) -> DataFrame:
    """Document headers inside the period with an allowed type.

    The flag row's meaning is not known; it restricts nothing here.
    """
    bindings = {
        codes.flt_doc_type: Binding("ortype"),
        codes.flt_agent: Binding("masterfid"),
        codes.flt_outlet: Binding("mfid"),
    }
    found = apply_filters(orders, fs, bindings, period_column="ordate", day_col=day_col)
    return found.select(*coded_columns(columns, codes.document_columns, ORDER_COLS))


def with_address_parts(faces: DataFrame, codes: AuditCodes, source_col: str = "faddress") -> DataFrame:
    """Append the address columns (city, street, building, outlet no.) split
    from the address text; a part that is not found is ''."""
    from shelfaudit.functions.text import split_address

    return faces.withColumns(split_address(source_col, codes.address_fields))
