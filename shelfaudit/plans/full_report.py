"""The full 42-column audit report (C10), ordered.

A section is the documents of its type that follow the stock-check document
by id distance (``= 1``, band 1-4, band 1-7), narrowed to the latest document
of the type, with its pivoted lines and product names. Each section is
resolved on its own keys (visit x the period's headers, all of them present)
and then attached to the visit rows once. The lines are read once: those of
the extracted documents are staged, and the facing counters and all sections
read that copy. The wide rows' lookup keys are often NULL (no stock check, no
product); such rows are spread by a salt instead of meeting in one partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfaudit.config import AuditCodes
from shelfaudit.functions.period import date_in_period, period_filter
from shelfaudit.functions.text import blank_zero, concat_strict, count_total, dot_to_comma, presence_percent
from shelfaudit.operators.adjacent import distance_lookup
from shelfaudit.operators.eav import master_attribute, pivot_max
from shelfaudit.operators.latest import latest_documents
from shelfaudit.operators.promises import KeyChecks, one_value
from shelfaudit.plans.facts import lines_of_documents, own_lines
from shelfaudit.plans.sections import with_item_name
from shelfaudit.session import stage

#: Partitions' worth of values that rows without a lookup key are spread over.
SPREAD = 4096
VISIT = ["masterfid", "fid"]
#: The report's order: supervisor, visit start, facing document, NULL first.
REPORT_ORDER = ("supervisor_name", "audit_date", "facing_doc")


def spread_left(df: DataFrame, lookup: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Left join on ``keys`` (columns of both) that scatters rows with a NULL key.

    Such rows match nothing, but one hash would send all of them to one task:
    they get a salt from ``by``, every lookup row has salt 0.
    """
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    salt = F.when(missing, 1 + F.pmod(F.xxhash64(*by), F.lit(SPREAD))).otherwise(0).cast("long")
    right = lookup.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    # computed from a key so that it stays a join key and isn't folded into a filter
    right = right.withColumn("_r_salt", F.pmod(F.xxhash64(f"_r_{keys[0]}"), F.lit(1)).cast("long"))
    left = df.withColumn("_salt", salt)
    cond = [F.col(k) == F.col(f"_r_{k}") for k in keys] + [F.col("_salt") == F.col("_r_salt")]
    return left.join(right, cond, "left").drop("_salt", "_r_salt", *[f"_r_{k}" for k in keys])


def _headers(heads: DataFrame, doc_type: int, name: str) -> DataFrame:
    return heads.where(F.col("ortype") == doc_type).select(
        F.col("masterfid").alias("_hm"), F.col("mfid").alias("_hf"), F.col("orid").alias(name))


def _after(docs: DataFrame, heads: DataFrame, doc_type: int, pos: str, name: str, **distance) -> DataFrame:
    """(masterfid, fid, pos, name): documents of a type at a distance from ``pos``."""
    found = distance_lookup(docs, _headers(heads, doc_type, name), [("masterfid", "_hm"), ("fid", "_hf")], pos, name, **distance)
    return found.drop("_hm", "_hf")


def _latest(tdocs: DataFrame, doc_type: int, name: str) -> DataFrame:
    return latest_documents(tdocs, doc_type).select("masterfid", F.col("mfid").alias("fid"), F.col("orid").alias(name))


def _pivoted(lines: DataFrame, latest: DataFrame, name: str, cond: Column, key: str, mapping) -> DataFrame:
    """(masterfid, fid, name, id, pivot columns) of the latest documents' lines that pass ``cond``."""
    own = lines.where(cond & (F.col("activeflag") == 1)).withColumnRenamed("orid", name)
    return pivot_max(own.join(latest, ["masterfid", name]), ["masterfid", "fid", name, "id"], key, mapping)


def sections(visits: DataFrame, heads: DataFrame, tdocs: DataFrame, lines: DataFrame, items: DataFrame,
             codes: AuditCodes, promises: KeyChecks | None = None) -> dict[str, DataFrame]:
    """The four chained sections, keyed by the visit and its stock-check document ``orid607``
    (the main places also by product ``itid``); a document at the distance that isn't the
    latest keeps its row, with empty columns."""
    checks = visits.select(*VISIT).distinct().join(
        _headers(heads, codes.doc_stock_check, "orid607").withColumnsRenamed({"_hm": "masterfid", "_hf": "fid"}), VISIT)
    key = [*VISIT, "orid607"]
    product = F.col("dictid") == codes.product_dict

    extra = _after(checks, heads, codes.doc_extra_places, "orid607", "orid612", offsets=[1])
    cols = list(codes.extra_places)
    p612 = _pivoted(lines, _latest(tdocs, codes.doc_extra_places, "orid612"), "orid612",
                    F.col("attrid").isin(list(codes.extra_places.values())) & product, "attrid", codes.extra_places)
    p612 = with_item_name(p612, items, "id", "item612_name", promises).select(
        *VISIT, "orid612", "item612_name", *[F.col(c).alias(f"{c}_612") for c in cols])
    s612 = extra.join(p612, [*VISIT, "orid612"], "left").drop("orid612")

    main = _after(extra, heads, codes.doc_main_places, "orid612", "orid608", offsets=[1])
    p608 = _pivoted(lines, _latest(tdocs, codes.doc_main_places, "orid608"), "orid608",
                    F.col("id").isin(list(codes.main_places.values())) & product, "id", codes.main_places)
    s608 = extra.join(main, [*VISIT, "orid612"]).join(p608, [*VISIT, "orid608"]).select(
        *key, F.col("id").alias("itid"), *codes.main_places)

    # the original joins promo lines to documents on the agent only, an existence
    # test; only lines of latest promo documents survive, and those pass it
    promo = _after(checks, heads, codes.doc_promo, "orid607", "orid611", band=(1, 4))
    p611 = _pivoted(lines, _latest(tdocs, codes.doc_promo, "orid611"), "orid611",
                    F.col("attrid").isin(list(codes.promo_actions.values())), "attrid", codes.promo_actions)
    first = next(iter(codes.promo_actions))
    p611 = with_item_name(p611.withColumn(first, dot_to_comma(first)), items, "id", "item611_name", promises).drop("id")
    s611 = promo.join(p611, [*VISIT, "orid611"], "left").drop("orid611")

    order = _after(checks, heads, codes.doc_order_info, "orid607", "orid610", band=(1, 7))
    info = lines.where(F.col("attrid") == codes.attr_order_info).select(
        "masterfid", F.col("orid").alias("orid610"), F.col("attrtext").alias("order_info"))
    info = info.join(_latest(tdocs, codes.doc_order_info, "orid610"), ["masterfid", "orid610"])
    s610 = order.join(info, [*VISIT, "orid610"], "left").drop("orid610")
    return {"checks": checks, "612": s612, "608": s608, "611": s611, "610": s610}


def photo_neighbours(rows: DataFrame, tdocs: DataFrame, codes: AuditCodes, bounds) -> DataFrame:
    """(masterfid, fid, fc_orid, photo): photo documents of the period next to the facing document."""
    docs = tdocs.where((F.col("ortype") == codes.doc_photo) & date_in_period("ordate", bounds))
    newest = docs.groupBy("masterfid", "mfid", "orid").agg(F.max("ordate").alias("ordate"))
    shown = newest.join(docs.select("masterfid", "mfid", "orid", "ordate"), ["masterfid", "mfid", "orid", "ordate"]).select(
        F.col("masterfid").alias("_hm"), F.col("mfid").alias("_hf"), F.col("orid").alias("_photo"))
    near = distance_lookup(rows, shown, [("masterfid", "_hm"), ("fid", "_hf")], "fc_orid", "_photo", offsets=[-1, 1])
    return near.select(*VISIT, "fc_orid", concat_strict("masterfid", "_photo").alias("photo"))


def full_report(
    visits: DataFrame,
    heads: DataFrame,
    tdocs: DataFrame,
    lines: DataFrame,
    objattrs: DataFrame,
    items: DataFrame,
    faces: DataFrame,
    facing: DataFrame,
    listing: DataFrame,
    visit_comments: DataFrame,
    codes: AuditCodes,
    doc_bounds,
    keep_order: bool = False,
    checks: KeyChecks | None = None,
) -> DataFrame:
    """42 columns, ordered by supervisor name, visit start, facing document.

    ``heads`` are the period's headers of the chained types, ``lines`` the
    extracted documents' lines; both are read several times, so stage them.
    ``faces`` holds outlets and persons (the table is joined in both roles)
    and must carry the address parts (``with_address_parts``). ``keep_order``
    adds the facing document of the order as ``facing_doc``; ``checks`` counts
    repeated keys of the name, banner and e-mail lookups, or fails on them.
    """
    found = sections(visits, heads, tdocs, lines, items, codes, checks)
    r = visits.select("masterfid", "fid", "vdate", "datebegin", "otkazstr").join(found["checks"], VISIT, "left")
    banner = master_attribute(objattrs, codes.obj_banner_attr, codes.outlet_dict).selectExpr("id AS fid", "attrtext AS banner")
    fc = facing.selectExpr("mfid AS fid", "datebegin", "orid AS fc_orid", "itid", "facing AS _facing",
                           "shelf AS _shelf", "store AS _store", "orcomment AS facing_comment")
    if checks:
        banner = checks.joined(banner, "banner", ["fid"])
    names = one_value(items.select(F.col("iid").alias("itid"), F.col("iname").alias("item_name")), "itid", "item_name", "item_name", checks)
    fc = spread_left(fc, names, ["itid"], ["fid", "datebegin"])
    r = r.join(banner, "fid", "left").join(fc, ["fid", "datebegin"], "left")
    by = ["masterfid", "fid", "datebegin", "fc_orid"]
    ls = listing.selectExpr("attrtext AS banner", "datebegin", "iid AS itid", "listed AS _listed")
    r = spread_left(r, ls, ["banner", "datebegin", "itid"], by)
    check = [*VISIT, "orid607"]
    r = spread_left(r, found["612"], check, by)
    r = spread_left(r, found["608"], [*check, "itid"], by)
    r = spread_left(r, found["611"], check, by)
    r = spread_left(r, found["610"], check, by)
    r = spread_left(r, photo_neighbours(r.select(*VISIT, "fc_orid"), tdocs, codes, doc_bounds), [*VISIT, "fc_orid"], by)

    # one table in two roles: the outlet and the supervising person
    outlet = faces.selectExpr("fid", "fname AS employee_name", "nomertt AS outlet_no", "gorod AS city", "street", "dom AS building")
    person = faces.selectExpr("fid AS masterfid", "fname AS supervisor_name")
    comment = visit_comments.selectExpr("fid", "vdate", "comment AS visit_comment")
    email = master_attribute(objattrs, codes.obj_email_attr, active=True).selectExpr("id AS fid", "attrtext AS email")
    if checks:
        email = checks.joined(email, "email", ["fid"])
    r = r.join(outlet, "fid", "left").join(person, "masterfid", "left").join(comment, ["fid", "vdate"], "left").join(email, "fid", "left")

    given = {
        "audit_date": F.col("datebegin"), "store_category": F.lit(""), "district": F.lit(""), "store_closed": F.col("otkazstr"),
        "facing": blank_zero("_facing"), "shelf_qty": blank_zero("_shelf"), "store_qty": blank_zero("_store"),
        "listed": blank_zero("_listed"), "total_qty": count_total("_facing", "_shelf", "_store", "_listed"),
        "presence_pct": presence_percent("_facing", "_listed"), "photo_2": F.lit(""), "photo_3": F.lit(""),
    }
    out = r.select(*[given.get(c, F.col(c)).alias(c) for c in report_columns(codes)], F.col("fc_orid").alias("facing_doc"))
    out = out.orderBy(*[F.asc_nulls_first(c) for c in REPORT_ORDER])
    return out if keep_order else out.drop("facing_doc")


def report_columns(codes: AuditCodes) -> list[str]:
    """The 42 columns in the report's order; the pivots' names come from the codes."""
    return [
        "employee_name", "audit_date", "outlet_no", "store_category", "banner", "city", "district", "street", "building",
        "store_closed", "item_name", "facing", "shelf_qty", "store_qty", "listed", "total_qty", "order_info",
        *codes.main_places, "item612_name", *[f"{c}_612" for c in codes.extra_places], "item611_name", *codes.promo_actions,
        "presence_pct", "supervisor_name", "facing_comment", "visit_comment", "photo", "photo_2", "photo_3", "email",
    ]


def used_lines(codes: AuditCodes) -> Column:
    """Which lines some part of the report can use: those of its attributes, and the main places, told by their object."""
    attributes = {*codes.facing_init_attrs, *codes.facing_attrs, *codes.shelf_attrs, *codes.store_attrs,
                  *codes.extra_places.values(), *codes.promo_actions.values(), codes.attr_order_info}
    places = F.col("id").isin(list(codes.main_places.values())) & (F.col("dictid") == codes.product_dict)
    return F.col("attrid").isin(sorted(attributes)) | places


def run_full_report(
    spark,
    tables,
    codes: AuditCodes,
    visit_bounds,
    base_filter=None,
    doc_bounds=None,
    keep_order: bool = False,
    checks: KeyChecks | None = None,
) -> DataFrame:
    """The whole full report from base tables (the procedure's dormant result): visits, outlets
    and persons of the visits, the listing and facing staging, then the 42-column ordered report.

    ``doc_bounds`` is the documents' period, the visits' by default.
    """
    from shelfaudit.plans.extract import extract_faces, visit_filter, with_address_parts
    from shelfaudit.plans.report import report_inputs
    from shelfaudit.plans.staging import banner_visits, facing_counts, listing_counts

    doc_bounds = visit_bounds if doc_bounds is None else doc_bounds
    visits, tdocs, _ = report_inputs(spark, tables, codes, visit_bounds, doc_bounds, base_filter, facts=False)
    people = extract_faces(tables.faces, visit_filter(visits, codes), codes)
    chained = [codes.doc_stock_check, codes.doc_extra_places, codes.doc_main_places, codes.doc_promo, codes.doc_order_info]
    heads = stage(
        period_filter(tables.orders, "ordate", doc_bounds, by_day=True, day_col=tables.order_day)
        .where(F.col("ortype").isin(chained)).select("masterfid", "mfid", "orid", "ortype", "ordate"), "day_headers")
    # every use of a line ends in a join to an extracted document
    lines = lines_of_documents(tables.attrs, tdocs, block=tables.line_block).where(used_lines(codes))
    lines = stage(own_lines(lines, tdocs), "document_lines")
    temp = stage(banner_visits(people, tables.objattrs, visits, tables.items, codes), "banner_visits")
    listing = listing_counts(temp, tables.objattrs, tables.items, codes)
    facing = stage(facing_counts(people, visits, tdocs, lines, tables.items, codes, cut=False), "facing")
    return full_report(visits, heads, tdocs, lines, tables.objattrs, tables.items, with_address_parts(people, codes),
                       facing, listing, tables.visit_comments, codes, doc_bounds, keep_order, checks)
