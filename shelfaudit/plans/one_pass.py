"""All sections of the live report from one aggregate of the order facts.

The facts, the large input, are read and shuffled once. ``section_rows`` groups
them by document and product; each row holds the state of every section: the
pivots' columns, and how many lines it stands for. Lines whose text the report
shows as it is (stock figures, order information) keep attribute and text in
the key, so equal ones are one row with a count; no list of a group's lines is
ever built. The rows, a small part of the lines, are staged, and the sections
are split from them.

Defined results: as in ``plans.sections``, row for row. A pivot has a row where
a line passes the section's filter, a repeated stock line or order information
multiplies the report's row, a NULL product has an assortment row and matches
no lookup, and texts that only their collation calls equal stay apart.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfaudit.config import AuditCodes
from shelfaudit.functions.text import dot_to_comma, row_total, text_or_zero
from shelfaudit.plans.sections import DOC_KEYS, PIVOT_KEYS, order_info
from shelfaudit.session import stage

TIMES = "times"


@dataclass(frozen=True)
class Pivot:
    """One pivoted section: the document type, which lines are its, and the code of each column."""

    name: str
    doc_type: int
    mapping: dict[str, int]
    lines: Column
    pivot_on: str

    def column(self, name: str) -> str:
        return f"{self.name}_{name}"


def pivots(codes: AuditCodes) -> dict[str, Pivot]:
    """The main places, extra places and promo actions as the codes define them."""

    def lines(mapping, filter_on: str, dict_id: int | None) -> Column:
        own = F.col(filter_on).isin(list(mapping.values()))
        return own if dict_id is None else own & (F.col("dictid") == dict_id)

    made = (
        Pivot("main", codes.doc_main_places, codes.main_places, lines(codes.main_places, "id", codes.main_places_dict), "id"),
        Pivot("extra", codes.doc_extra_places, codes.extra_places,
              lines(codes.extra_places, codes.extra_places_filter_on, codes.extra_places_dict), "attrid"),
        Pivot("promo", codes.doc_promo, codes.promo_actions, lines(codes.promo_actions, codes.promo_filter_on, codes.promo_dict), "attrid"),
    )
    return {p.name: p for p in made}


def latest_flags(tdocs: DataFrame, wanted: dict[str, Pivot]) -> DataFrame:
    """(masterfid, mfid, orid, latest_<name>): the documents that are the latest of a section's type, by one rank."""
    by = Window.partitionBy("masterfid", "mfid", "ortype").orderBy(F.col("ordate").desc())
    docs = tdocs.where(F.col("ortype").isin([p.doc_type for p in wanted.values()]) & F.col("ordate").isNotNull())
    newest = docs.select(*DOC_KEYS, "ortype", F.rank().over(by).alias("_rank")).where(F.col("_rank") == 1)
    return newest.groupBy(*DOC_KEYS).agg(*[F.max(F.col("ortype") == p.doc_type).alias(f"latest_{p.name}") for p in wanted.values()])


def section_rows(facts: DataFrame, tdocs: DataFrame, codes: AuditCodes) -> DataFrame:
    """One row a (document, type, product) of the facts, and one more for each text that is shown as it is.

    Columns: masterfid, mfid, orid, ortype, id; attrid and attrtext of a text that is shown, else
    NULL; times; has_<section> and its pivot columns; latest_<section>.
    """
    wanted = pivots(codes)
    stock = (F.col("ortype") == codes.doc_stock) & F.col("attrid").isin([codes.attr_facing, codes.attr_shelf, codes.attr_store])
    shown = F.coalesce(stock | (F.col("attrid") == codes.attr_order_info), F.lit(False))
    used = shown | F.col("ortype").isin([codes.doc_stock, codes.doc_extra_places, codes.doc_promo])
    aggs = [F.count(F.lit(1)).alias(TIMES)]
    for p in wanted.values():
        used = used | p.lines
        aggs.append(F.coalesce(F.max(p.lines), F.lit(False)).alias(f"has_{p.name}"))
        for name, code in p.mapping.items():
            value = F.when(F.col(p.pivot_on) == code, F.col("attrtext")).otherwise(F.lit(""))
            aggs.append(F.max(F.when(p.lines, value)).alias(p.column(name)))
    # texts are grouped by their bytes, whatever their collation
    keys = [F.when(shown, F.col("attrid")).alias("_attr"), F.when(shown, F.collate("attrtext", "UTF8_BINARY")).alias("_text")]
    rows = facts.where(used).groupBy(*DOC_KEYS, "ortype", "id", *keys).agg(*aggs)
    rows = rows.withColumnsRenamed({"_attr": "attrid"}).withColumn("attrtext", F.col("_text").cast(facts.schema["attrtext"].dataType)).drop("_text")
    return rows.join(latest_flags(tdocs, wanted), DOC_KEYS, "left")


def staged_sections(facts: DataFrame, tdocs: DataFrame, codes: AuditCodes) -> DataFrame:
    """``section_rows`` written once: every section and the part count read them."""
    return stage(section_rows(facts, tdocs, codes), "sections")


def section_pivot(rows: DataFrame, name: str, codes: AuditCodes) -> DataFrame:
    """(orid, masterfid, mfid, id, pivot columns) of ``main``, ``extra`` or ``promo``, as ``plans.sections`` makes them."""
    p = pivots(codes)[name]
    own = rows.where(F.col(f"has_{name}") & F.col(f"latest_{name}"))
    out = own.groupBy(*PIVOT_KEYS).agg(*[F.max(p.column(c)).alias(c) for c in p.mapping])
    if name == "promo":
        first = next(iter(p.mapping))
        out = out.withColumn(first, dot_to_comma(first))
    return out


def section_info(rows: DataFrame, tdocs: DataFrame, codes: AuditCodes) -> DataFrame:
    """(masterfid, mfid, order_info): ``sections.order_info`` with each equal text repeated."""
    counted = order_info(rows, tdocs, codes, TIMES)
    return _repeated(counted, F.col(TIMES)).drop(TIMES)


def section_stock(base: DataFrame, rows: DataFrame, codes: AuditCodes, id_col: str, keys=("masterfid", "mfid")) -> DataFrame:
    """``base`` with the stock figures and their total, ``'0'`` when missing; repeated lines multiply the row."""
    out, times = base, F.lit(1).cast("long")
    for attr, name in ((codes.attr_facing, "facing"), (codes.attr_shelf, "shelf_qty"), (codes.attr_store, "store_qty")):
        look = rows.where((F.col("ortype") == codes.doc_stock) & (F.col("attrid") == attr))
        look = look.groupBy(*keys, F.col("id").alias(id_col), F.col("attrtext").alias(f"_{name}")).agg(F.sum(TIMES).alias(f"_n_{name}"))
        out = out.join(look, [*keys, id_col], "left")
        times = times * F.coalesce(F.col(f"_n_{name}"), F.lit(1))
    return _repeated(out, times).select(
        *base.columns, text_or_zero("_facing").alias("facing"), text_or_zero("_shelf_qty").alias("shelf_qty"),
        text_or_zero("_store_qty").alias("store_qty"), row_total("_facing", "_shelf_qty", "_store_qty").alias("total_qty"))


def _repeated(df: DataFrame, times: Column) -> DataFrame:
    return df.select("*", F.explode(F.sequence(F.lit(1).cast("long"), times)).alias("_time")).drop("_time")
