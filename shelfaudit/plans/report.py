"""The live audit report (C9): one row per visit x 613, 612 and 611 product.

Plan shape. The original joins everything onto the visit in a long chain,
so the growing row set would be re-shuffled at each join key change. Here
each document section is first assembled as a block keyed by
(agent, outlet): the 613 block carries its three stock lookups, the main
places and the product name; the 612 and 611 blocks their pivots and names.
The blocks and the order-information lookup then join the visit on the
same two keys and a part number: the product of the three assortments (the
report's defined output) is built partition-locally, and the product of a
large visit in several parts (``visit_parts``).

The order facts are aggregated once, into the state of all sections by
document and product (``plans.one_pass``); these rows and the document
extract are staged (written under the checkpoint folder), as every branch
reads them. The large EAV line table is scanned and shuffled once, cut to the
day's documents; the day's headers are read twice (once for their staged ids,
once joined).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfaudit.config import AuditCodes
from shelfaudit.operators.filters import FilterSet
from shelfaudit.operators.promises import KeyChecks
from shelfaudit.plans.extract import caller_filter, document_filter, extract_documents, extract_visits
from shelfaudit.plans.facts import facts_from_heads, id_range, order_heads
from shelfaudit.plans.one_pass import TIMES, section_info, section_pivot, section_stock, staged_sections
from shelfaudit.plans.sections import assortment, with_item_name
from shelfaudit.session import stage
from shelfaudit.sources.tables import AuditTables

VISIT_KEYS = ["masterfid", "mfid"]
#: Rows of one visit that one task builds at most, about.
PART_ROWS = 1_000_000


def report_inputs(
    spark: SparkSession,
    tables: AuditTables,
    codes: AuditCodes,
    visit_bounds,
    doc_bounds=None,
    base_filter: FilterSet | None = None,
    stage_docs: bool = True,
    stage_facts: bool = True,
    facts: bool = True,
):
    """Visits, document extract and order facts of one report run.

    Stage what several branches read: the document extract (latest dates
    and section joins) and, for separate sections, the order facts. A consumer
    that reads them once, as the live report does, should not stage them. The visit extract is a pushed
    filter over one table and is re-read rather than staged.
    """
    doc_bounds = visit_bounds if doc_bounds is None else doc_bounds
    visits = extract_visits(tables.visit_source, caller_filter(spark, visit_bounds, codes, base_filter), codes,
                            tables.visit_day)
    tdocs = extract_documents(tables.orders, document_filter(spark, doc_bounds, codes), codes, tables.order_day)
    if stage_docs:
        tdocs = stage(tdocs, "documents")
    if not facts:
        return visits, tdocs, None
    # the headers are one filtered scan plus two semi-joins: computed twice, for their staged ids (range and lines) and for the join
    heads = order_heads(tables.orders, visits, doc_bounds, codes.fact_doc_types, tables.order_day)
    ids = stage(heads.select("masterfid", "orid"), "fact_documents")
    fx = facts_from_heads(heads, tables.attrs, id_range(ids), tables.line_block, ids)
    return visits, tdocs, stage(fx, "order_facts") if stage_facts else fx


def stock_block(rows: DataFrame, items: DataFrame, codes: AuditCodes, checks: KeyChecks | None = None) -> DataFrame:
    """613 assortment with stock lookups, main places (by product) and name."""
    base = assortment(rows, codes.doc_stock).withColumnRenamed("id", "id613")
    looked = section_stock(base, rows, codes, "id613")
    mp = section_pivot(rows, "main", codes).selectExpr(
        "masterfid", "mfid", "id AS id613", *[f"`{c}`" for c in codes.main_places])
    joined = looked.join(mp, on=["masterfid", "mfid", "id613"], how="left")
    return with_item_name(joined, items, "id613", "item613_name", checks)


def places_block(assort: DataFrame, pivot: DataFrame, items: DataFrame, cols, suffix: str,
                 checks: KeyChecks | None = None) -> DataFrame:
    """An assortment with its pivot joined on the product, and the name."""
    key = f"id{suffix}"
    base = assort.withColumnRenamed("id", key)
    pv = pivot.selectExpr("masterfid", "mfid", f"id AS {key}", *[f"`{c}` AS `{c}_{suffix}`" for c in cols])
    joined = base.join(pv, on=["masterfid", "mfid", key], how="left")
    return with_item_name(joined, items, key, f"item{suffix}_name", checks)


def report_columns(codes: AuditCodes) -> list[str]:
    main = list(codes.main_places)
    extra = [f"{c}_612" for c in codes.extra_places]
    promo = [f"{c}_611" for c in codes.promo_actions]
    return (
        ["sec613_open", "item613_name", "facing", "shelf_qty", "store_qty", "total_qty",
         "out_of_stock", "listed", "presence_pct", "sec613_close",
         "sec610_open", "order_info", "sec610_close",
         "sec608_open", *main, "sec608_close",
         "sec612_open", "item612_name", *extra, "sec612_close",
         "sec611_open", "item611_name", *promo, "sec611_close",
         "masterfid", "fid"]
    )


def visit_parts(visits: DataFrame, facts: DataFrame, codes: AuditCodes, part_rows: int) -> DataFrame:
    """(agent, outlet, _parts): how many parts its three assortments' product is cut into.

    A product with repeated stock lines, repeated order information and
    repeated visits count as often as the report's joins repeat them.
    ``facts`` may be the staged section rows, which stand for ``times`` lines.
    """
    lines = F.col(TIMES) if TIMES in facts.columns else F.lit(1)
    kinds = (codes.doc_stock, codes.doc_extra_places, codes.doc_promo)
    looked = (codes.attr_facing, codes.attr_shelf, codes.attr_store)
    info = F.col("attrid") == codes.attr_order_info
    held = facts.where(F.col("ortype").isin(list(kinds)) | info).groupBy(*VISIT_KEYS, "ortype", "id").agg(
        *[F.sum(F.when(F.col("attrid") == a, lines).otherwise(0)).cast("double").alias(f"_a{k}") for k, a in enumerate(looked)],
        F.sum(F.when(info, lines).otherwise(0)).alias("_info"))
    rows = F.lit(1.0)
    for k in range(len(looked)):
        rows = rows * F.greatest(F.col(f"_a{k}"), F.lit(1.0))
    counts = held.groupBy(*VISIT_KEYS).agg(
        F.sum(F.when(F.col("ortype") == codes.doc_stock, rows)).alias("_stock"),
        *[F.count_if(F.col("ortype") == k).alias(f"_n{k}") for k in kinds], F.sum("_info").alias("_info"))
    repeats = visits.groupBy(*VISIT_KEYS).agg(F.count(F.lit(1)).alias("_visits"))
    product = F.coalesce("_stock", F.lit(1.0)) * F.greatest(F.col("_info"), F.lit(1)) * F.col("_visits")
    for k in kinds[1:]:
        product = product * F.greatest(F.col(f"_n{k}"), F.lit(1))
    # no more parts than stock products: a part without one is empty
    parts = F.least(F.ceil(product / part_rows), F.greatest(F.col(f"_n{codes.doc_stock}"), F.lit(1)))
    return counts.join(repeats, VISIT_KEYS).select(*VISIT_KEYS, parts.cast("long").alias("_parts"))


def report_blocks(visits: DataFrame, tdocs: DataFrame, rows: DataFrame, items: DataFrame, codes: AuditCodes,
                  checks: KeyChecks | None = None) -> tuple[DataFrame, ...]:
    """The visits' keys, the 613, 612 and 611 blocks and the order information, each by (agent, outlet).

    ``rows`` are the staged section rows of the facts."""
    b613 = stock_block(rows, items, codes, checks)
    b612 = places_block(assortment(rows, codes.doc_extra_places), section_pivot(rows, "extra", codes), items,
                        codes.extra_places, "612", checks)
    b611 = places_block(assortment(rows, codes.doc_promo), section_pivot(rows, "promo", codes), items,
                        codes.promo_actions, "611", checks)
    vis = visits.select("masterfid", F.col("fid").alias("mfid"))
    return vis, b613, b612, b611, section_info(rows, tdocs, codes)


def report_values(codes: AuditCodes) -> list[Column]:
    """The 38 columns from the joined blocks."""
    lab = codes.labels
    given = {
        "sec613_open": lab.open_613, "sec613_close": lab.close_613,
        "sec610_open": lab.open_610, "sec610_close": lab.close_610,
        "sec608_open": lab.open_608, "sec608_close": lab.close_608,
        "sec612_open": lab.open_612, "sec612_close": lab.close_612,
        "sec611_open": lab.open_611, "sec611_close": lab.close_611,
        "out_of_stock": lab.empty, "listed": lab.empty, "presence_pct": lab.empty,
    }
    return [F.lit(given[n]).alias(n) if n in given else F.col("mfid" if n == "fid" else n).alias(n) for n in report_columns(codes)]


def audit_report(
    visits: DataFrame,
    tdocs: DataFrame,
    facts: DataFrame,
    items: DataFrame,
    codes: AuditCodes,
    part_rows: int = PART_ROWS,
    checks: KeyChecks | None = None,
) -> DataFrame:
    """The 38-column live report from visits, staged documents and facts, which are read once.

    A visit's rows are the product of its three assortments. Where that
    exceeds ``part_rows``, the stock block is cut into parts by a hash of the
    product and the two other blocks are repeated for each part, so that no
    task builds more than about ``part_rows`` rows of one visit.
    ``plans.factors`` keeps the blocks unexpanded instead.
    """
    rows = staged_sections(facts, tdocs, codes)
    vis, b613, b612, b611, info = report_blocks(visits, tdocs, rows, items, codes, checks)
    parts = visit_parts(vis, rows, codes, part_rows)
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)).alias("_part")

    def repeated(block: DataFrame) -> DataFrame:
        return block.join(parts, VISIT_KEYS).select(*block.columns, each)

    stock = vis.join(b613, VISIT_KEYS).join(info, VISIT_KEYS, "left").join(parts, VISIT_KEYS)
    stock = stock.withColumn("_part", F.pmod(F.xxhash64("id613"), F.col("_parts"))).drop("_parts")
    out = stock.join(repeated(b612), [*VISIT_KEYS, "_part"]).join(repeated(b611), [*VISIT_KEYS, "_part"])
    return out.select(*report_values(codes))


def run_audit_report(
    spark: SparkSession,
    tables: AuditTables,
    codes: AuditCodes,
    visit_bounds,
    doc_bounds=None,
    base_filter: FilterSet | None = None,
    checks: KeyChecks | None = None,
) -> DataFrame:
    """Whole live report for one period (the procedure's entry point)."""
    visits, tdocs, facts = report_inputs(spark, tables, codes, visit_bounds, doc_bounds, base_filter, stage_facts=False)
    return audit_report(visits, tdocs, facts, tables.items, codes, checks=checks)
