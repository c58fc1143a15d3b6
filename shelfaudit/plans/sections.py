"""Report sections built on the order facts (C5-C8) and their lookups.

Every section joins the facts to the latest document of its type
(``operators.latest``): by rank where the document's type is tested, by a
MAX aggregate joined back for order information, where it is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfaudit.config import AuditCodes
from shelfaudit.functions.text import dot_to_comma, row_total, text_or_zero
from shelfaudit.operators.eav import pivot_max
from shelfaudit.operators.latest import latest_documents
from shelfaudit.operators.promises import KeyChecks, one_value

DOC_KEYS = ["masterfid", "mfid", "orid"]
PIVOT_KEYS = ["orid", "masterfid", "mfid", "id"]


def assortment(facts: DataFrame, doc_type: int) -> DataFrame:
    """Distinct (agent, outlet, product) of one document type."""
    return facts.where(F.col("ortype") == doc_type).select("masterfid", "mfid", "id").distinct()


def _on_latest(facts: DataFrame, tdocs: DataFrame, doc_type: int, require_type: bool = True) -> DataFrame:
    docs = latest_documents(tdocs, doc_type, require_type=require_type).select(*DOC_KEYS)
    return facts.join(docs, on=DOC_KEYS, how="inner")


def order_info(facts: DataFrame, tdocs: DataFrame, codes: AuditCodes, *more: str) -> DataFrame:
    """Order-information text of the latest order-info document.

    The document's own type is not tested, only the attribute: any document
    dated at the latest order-info date of its key passes (quirk kept).
    ``more`` columns of the facts are kept.
    """
    rows = _on_latest(facts, tdocs, codes.doc_order_info, require_type=False)
    return rows.where(F.col("attrid") == codes.attr_order_info).select(
        "masterfid", "mfid", F.col("attrtext").alias("order_info"), *more
    )


def _places(facts, tdocs, doc_type, mapping, filter_on, dict_id, pivot_on):
    rows = _on_latest(facts, tdocs, doc_type)
    rows = rows.where(F.col(filter_on).isin(list(mapping.values())))
    if dict_id is not None:
        rows = rows.where(F.col("dictid") == dict_id)
    return pivot_max(rows, PIVOT_KEYS, pivot_on, mapping)


def main_places(facts: DataFrame, tdocs: DataFrame, codes: AuditCodes) -> DataFrame:
    """Main sales places (C6): pivot by object id, the id kept in the key."""
    return _places(facts, tdocs, codes.doc_main_places, codes.main_places, "id",
                   codes.main_places_dict, "id")


def extra_places(facts: DataFrame, tdocs: DataFrame, codes: AuditCodes) -> DataFrame:
    """Extra display places (C7): rows chosen by ``extra_places_filter_on``
    (object id in the live report), pivoted by attribute id."""
    return _places(facts, tdocs, codes.doc_extra_places, codes.extra_places,
                   codes.extra_places_filter_on, codes.extra_places_dict, "attrid")


def promo_actions(facts: DataFrame, tdocs: DataFrame, codes: AuditCodes,
                  comma_column: str | None = None) -> DataFrame:
    """Trade-marketing actions (C8), pivoted by attribute id.

    ``comma_column`` (the price cut) gets ``.`` replaced by ``,``.
    """
    out = _places(facts, tdocs, codes.doc_promo, codes.promo_actions,
                  codes.promo_filter_on, codes.promo_dict, "attrid")
    if comma_column is None:
        comma_column = next(iter(codes.promo_actions))
    return out.withColumn(comma_column, dot_to_comma(comma_column))


def with_item_name(df: DataFrame, items: DataFrame, id_col: str = "id", name: str = "iname",
                   checks: KeyChecks | None = None) -> DataFrame:
    """Product name by id: the scalar lookup as a left join.

    The original's lookup fails on a repeated id; here the dimension is
    reduced to one name an id (the smallest), so rows are never doubled. The
    aggregate is keyed as the join is, so it adds no shuffle to it.
    ``checks`` counts repeated ids, or fails on them.
    """
    names = one_value(items.select(F.col("iid").alias(id_col), F.col("iname").alias(name)), id_col, name, name, checks)
    return df.join(names, on=id_col, how="left")


def stock_lookups(base: DataFrame, facts: DataFrame, codes: AuditCodes, id_col: str = "id",
                  keys=("masterfid", "mfid")) -> DataFrame:
    """Facing, shelf and store text of the stock document per product (J9),
    ``'0'`` when missing, plus their numeric total.

    Three filtered left joins rather than a pivot: repeated lines multiply
    the row as the original's joins do.
    """
    out = base
    for attr, name in ((codes.attr_facing, "facing"), (codes.attr_shelf, "shelf_qty"),
                       (codes.attr_store, "store_qty")):
        look = facts.where((F.col("ortype") == codes.doc_stock) & (F.col("attrid") == attr)).selectExpr(
            *keys, f"id AS `{id_col}`", f"attrtext AS `_{name}`")
        out = out.join(look, on=[*keys, id_col], how="left")
    return out.select(
        *[c for c in base.columns],
        text_or_zero("_facing").alias("facing"),
        text_or_zero("_shelf_qty").alias("shelf_qty"),
        text_or_zero("_store_qty").alias("store_qty"),
        row_total("_facing", "_shelf_qty", "_store_qty").alias("total_qty"),
    )
