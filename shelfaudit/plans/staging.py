"""Listing and facing staging (C2-C4): outlet banners, listed and faced counts.

In the original these fill temp tables with zero counters and then
overwrite the counters with ``UPDATE ... FROM`` aggregates. Here initial
rows and counters come from one aggregate that is unique on the product
key, so the row count is that of the initial rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfaudit.config import AuditCodes
from shelfaudit.functions.text import contains_any, prefix_in
from shelfaudit.operators.eav import master_attribute
from shelfaudit.operators.promises import KeyChecks
from shelfaudit.plans.facts import lines_of_documents, own_lines
from shelfaudit.session import stage

TEMP_COLS = ("fid", "attrtext", "datebegin", "dateend", "vdate", "vdateonly", "iid")
FACING_COLS = ("mfid", "facing", "shelf", "store", "orcomment", "datebegin", "orid", "itid")


def banner_visits(faces: DataFrame, objattrs: DataFrame, visits: DataFrame, items: DataFrame,
                  codes: AuditCodes, checks: KeyChecks | None = None) -> DataFrame:
    """Outlets of the outlet type with their banner, visits and a product
    whose id equals the outlet id and whose name matches (C2).

    The product is joined on the banner row's object id, which is the
    outlet's id: a product is found only where the two ids coincide
    (kept as in the original). Constant ON predicates filter the right
    sides before the left joins. An outlet with several banners has a row for
    each; ``checks`` counts such outlets, or fails on them.
    """
    f = faces.where(F.col("ftype") == codes.outlet_face_type).select("fid")
    banner = master_attribute(objattrs, codes.obj_banner_attr, codes.outlet_dict).select(
        F.col("id").alias("_oid"), "attrtext"
    )
    if checks:
        banner = checks.joined(banner, "banner", ["_oid"])
    vis = visits.select(F.col("fid").alias("_vfid"), "datebegin", "dateend", "vdate", "vdateonly")
    named = items.where(contains_any("iname", codes.listing_name_parts, ci=codes.names_ci)).select("iid")
    out = (
        f.join(banner, f.fid == banner._oid, "left")
        .join(vis, f.fid == vis._vfid, "left")
        .join(named, named.iid == F.col("_oid"), "left")
    )
    return out.select(*TEMP_COLS)


def listed_counts(temp: DataFrame, objattrs: DataFrame, items: DataFrame, codes: AuditCodes,
                  rows: Column | None = None) -> DataFrame:
    """Listed count per (banner, named product): the source of C3's update.

    The original counts listing rows joined to every banner-visit row of the
    same banner, i.e. ``listing rows x banner-visit rows``. That product is
    computed from two pre-counts instead of materialising the join, which
    would be quadratic in the rows of a popular banner. Banners absent from
    the banner-visit rows drop out (the original's IN test). ``rows`` is how
    many banner-visit rows a row of ``temp`` stands for, one by default.
    """
    rows = F.lit(1) if rows is None else rows
    named = items.where(contains_any("iname", codes.listing_name_parts, ci=codes.names_ci)).select("iid")
    listed = master_attribute(objattrs, codes.obj_banner_attr, codes.product_dict, active=True)
    # first as a predicate, which goes below whatever the listings are made of
    listed = listed.where(F.col("id").isin(named))
    n_list = (
        listed.join(named, named.iid == listed.id)
        .groupBy("attrtext", F.col("id").alias("iid"))
        .agg(F.count(F.lit(1)).alias("_n_list"))
    )
    n_temp = temp.where(F.col("attrtext").isNotNull()).groupBy("attrtext").agg(F.sum(rows).alias("_n_temp"))
    return n_list.join(n_temp, "attrtext").select(
        "attrtext", "iid", (F.col("_n_list") * F.col("_n_temp")).alias("listed")
    )


def listing_counts(temp: DataFrame, objattrs: DataFrame, items: DataFrame, codes: AuditCodes) -> DataFrame:
    """Distinct (banner, product, visit start) with the listed count, 0 where
    the update finds no row (C3).

    One aggregate of ``temp`` gives the distinct rows and how many rows each
    stands for; it is written once, and a banner's rows are summed from it.
    """
    initial = stage(temp.groupBy("attrtext", "iid", "datebegin").agg(F.count(F.lit(1)).alias("_rows")), "listing-rows")
    counts = listed_counts(initial, objattrs, items, codes, F.col("_rows")).withColumnRenamed("listed", "_listed")
    out = initial.join(counts, ["attrtext", "iid"], "left")
    return out.select("attrtext", "iid", F.coalesce("_listed", F.lit(0).cast("long")).alias("listed"), "datebegin")


def _stock_lines(tdocs: DataFrame, attrs: DataFrame, items: DataFrame, codes: AuditCodes, attr_ids) -> DataFrame:
    """Stock-check documents joined to their lines of ``attr_ids`` and to named products."""
    docs = tdocs.where(F.col("ortype") == codes.doc_stock_check).select("masterfid", "orid", "mfid", "ordate")
    lines = attrs.where(F.col("attrid").isin(list(attr_ids))).select("masterfid", "orid", "id", "attrid", "objdate")
    named = items.where(prefix_in("iname", codes.facing_name_prefixes, ci=codes.names_ci)).select("iid").distinct()
    return docs.join(lines, ["masterfid", "orid"]).join(named, named.iid == lines.id)


def _per_visit(faces: DataFrame, visits: DataFrame, products: DataFrame, codes: AuditCodes) -> DataFrame:
    """Outlet x visit start x (document, product); both sides hold distinct values
    only, so a busy outlet multiplies no repetitions."""
    f = faces.where(F.col("ftype") == codes.outlet_face_type).select("fid").distinct()
    vis = visits.select(F.col("fid").alias("_vfid"), "datebegin").distinct()
    out = f.join(vis, f.fid == vis._vfid, "left").join(products, products._mfid == f.fid, "left")

    def counter(name):
        return F.coalesce(f"_{name}", F.lit(0).cast("long")).alias(name)

    return out.select(
        F.col("fid").alias("mfid"), counter("facing"), counter("shelf"), counter("store"),
        F.lit("0").alias("orcomment"), "datebegin", F.col("_orid").alias("orid"), F.col("_itid").alias("itid"),
    )


def _product_key():
    return [F.col("mfid").alias("_mfid"), F.col("orid").alias("_orid"), F.col("id").alias("_itid")]


def facing_initial(faces: DataFrame, visits: DataFrame, tdocs: DataFrame, attrs: DataFrame,
                   items: DataFrame, codes: AuditCodes) -> DataFrame:
    """Initial facing rows: outlet x visit x stock-check document x named
    product, counters 0 and the comment ``'0'`` (C4).

    Lines match their document on the exact timestamp. The original's outer
    join to the lines is cancelled by the inner join to products after it.
    """
    lines = _stock_lines(tdocs, own_lines(lines_of_documents(attrs, tdocs), tdocs), items, codes, codes.facing_init_attrs)
    zero = F.lit(0).cast("long")
    products = lines.where(F.col("objdate") == F.col("ordate")).select(*_product_key()).distinct()
    products = products.select("*", zero.alias("_facing"), zero.alias("_shelf"), zero.alias("_store"))
    return _per_visit(faces, visits, products, codes)


def facing_counts(faces: DataFrame, visits: DataFrame, tdocs: DataFrame, attrs: DataFrame, items: DataFrame,
                  codes: AuditCodes, cut: bool = True) -> DataFrame:
    """Facing rows with their three counters (C4): one pass over the lines.

    One aggregate by (outlet, document, product) tells whether the product is
    an initial row (some line at the document's exact time) and counts its
    lines: facing and shelf lines match their document on the calendar day,
    store lines on no date at all. ``cut`` restricts the lines to the
    documents' id range first; pass False when they already are.
    """
    every = {*codes.facing_init_attrs, *codes.facing_attrs, *codes.shelf_attrs, *codes.store_attrs}
    lines = _stock_lines(tdocs, own_lines(lines_of_documents(attrs, tdocs), tdocs) if cut else attrs, items, codes, sorted(every))
    attr, day = F.col("attrid"), F.to_date("objdate") == F.to_date("ordate")
    first = attr.isin(list(codes.facing_init_attrs)) & (F.col("objdate") == F.col("ordate"))
    products = lines.groupBy(*_product_key()).agg(
        F.max(F.coalesce(first, F.lit(False))).alias("_first"),
        F.count_if(attr.isin(list(codes.facing_attrs)) & day).alias("_facing"),
        F.count_if(attr.isin(list(codes.shelf_attrs)) & day).alias("_shelf"),
        F.count_if(attr.isin(list(codes.store_attrs))).alias("_store"),
    )
    return _per_visit(faces, visits, products.where("_first").drop("_first"), codes)
