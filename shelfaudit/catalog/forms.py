"""Spark forms of the catalogue queries over the analog views."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfaudit.catalog.codes import (
    DOC_FIRST_DAY, DOC_LAST_DAY, EVENT_DAY, TEST_CODES, VISIT_FIRST_DAY, VISIT_LAST_DAY,
)
from shelfaudit.functions.period import date_in_period, day_parts_equal, in_period, period_bounds
from shelfaudit.functions.text import blank_zero, concat_strict, count_total, presence_percent
from shelfaudit.operators.adjacent import band_join, offset_join
from shelfaudit.operators.eav import master_attribute
from shelfaudit.operators.filters import FilterSet
from shelfaudit.operators.latest import latest_documents
from shelfaudit.operators.ordering import whole_position
from shelfaudit.operators.ranking import running_count_rank
from shelfaudit.plans import extract as ext
from shelfaudit.plans import factors as fct
from shelfaudit.plans import full_report as fr
from shelfaudit.plans import photos as ph
from shelfaudit.plans import report as rpt
from shelfaudit.plans import sections as sec
from shelfaudit.plans import staging as stg
from shelfaudit.session import stage, staged_root
from shelfaudit.sources import analog
from shelfaudit.sources.named_files import stored_at, write_files
from shelfaudit.sources.tables import with_collation

C = TEST_CODES


def _bounds():
    return period_bounds(VISIT_FIRST_DAY, VISIT_LAST_DAY), period_bounds(DOC_FIRST_DAY, DOC_LAST_DAY)


def _inputs(spark: SparkSession, d: str, stage_docs: bool = False, stage_facts: bool = False, facts: bool = True):
    tables = analog.tables(spark, d, C)
    vb, db = _bounds()
    visits, tdocs, fx = rpt.report_inputs(spark, tables, C, vb, db, stage_docs=stage_docs,
                                          stage_facts=stage_facts, facts=facts)
    return tables, visits, tdocs, fx


def q01_period(spark: SparkSession, d: str) -> DataFrame:
    """Events of one day by the closed 00:00:00-23:59:59 range, with the day-parts test as a flag."""
    ev = analog.table(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    b = period_bounds(EVENT_DAY)
    return ev.where(in_period("ts", b)).select(
        "event_id", "ts", "user_id", "event_type",
        F.when(day_parts_equal("ts", EVENT_DAY), 1).otherwise(0).alias("day_match"),
    )


def q02_filter_set(spark: SparkSession, d: str) -> DataFrame:
    """Filter rows built from the visits: agents, outlets (one UNION) and owners."""
    _, visits, _, _ = _inputs(spark, d, facts=False)
    return ext.visit_filter(visits, C).rows


def q02_caller_set(spark: SparkSession, d: str) -> DataFrame:
    """Visits through a caller's set read from a table: the owners named in `region`, the outlets of
    `customer` with a positive balance; the rows' types are taken from the rows (S2)."""
    owners = analog.table(spark, d, "region").where(F.col("r_name").isin("ASIA", "EUROPE")).select(
        F.lit(C.flt_owner).alias("type"), F.lit(C.flt_owner_dict).alias("id"), F.col("r_regionkey").alias("id2"))
    outlets = analog.table(spark, d, "customer").where(F.col("c_acctbal") > 0).select(
        F.lit(C.flt_outlet).alias("type"), F.col("c_custkey").alias("id"), F.lit(None).alias("id2"))
    rows = owners.unionByName(outlets).withColumns({k: F.lit(None).cast("bigint") for k in ("id3", "id4", "id5")})
    base = FilterSet.from_rows(rows.withColumn("idstr", F.lit(None).cast("string")))
    tables = analog.tables(spark, d, C)
    vb, _ = _bounds()
    return ext.extract_visits(tables.visit_source, ext.caller_filter(spark, vb, C, base), C)


def q02_constant_set(spark: SparkSession, d: str) -> DataFrame:
    """Documents through the constant set applied as rows: the allowlist as an IN-subquery, the period
    read from its row (U2, P3)."""
    tables = analog.tables(spark, d, C)
    _, db = _bounds()
    rows = ext.document_filter(spark, db, C).rows
    return ext.extract_documents(tables.orders, ext.caller_rows(rows, C), C)


def q02_composite_set(spark: SparkSession, d: str) -> DataFrame:
    """Visits through a caller's set with the period as a row and owner rows (dictionary, owner): those of
    `region` by name, AFRICA's in another dictionary, AMERICA's in any (P3, P8)."""
    name = F.col("r_name")
    dictionary = F.when(name == "AFRICA", C.flt_owner_dict + 97).when(name != "AMERICA", C.flt_owner_dict)
    owners = analog.table(spark, d, "region").where(name != "MIDDLE EAST").select(
        F.lit(C.flt_owner).alias("type"), dictionary.cast("bigint").alias("id"), F.col("r_regionkey").cast("bigint").alias("id2"))
    vb, _ = _bounds()
    empty = {k: F.lit(None).cast("bigint") for k in ("id3", "id4", "id5")}
    rows = owners.withColumns(empty).withColumn("idstr", F.lit(None).cast("string")).unionByName(
        FilterSet.empty(spark).add_period(vb, C.flt_period).raw)
    return ext.extract_visits(analog.tables(spark, d, C).visit_source, ext.caller_rows(rows, C), C)


def q03_coded_columns(spark: SparkSession, d: str) -> DataFrame:
    """Documents of the period with the columns of the codes 1, 12, 7 and 5."""
    _, db = _bounds()
    return ext.extract_documents(analog.tables(spark, d, C).orders, ext.document_filter(spark, db, C), C, columns="1;12;7;5")


def q03_filtered_faces(spark: SparkSession, d: str) -> DataFrame:
    """Outlets through the visit filter: agents OR outlets, AND owners."""
    tables, visits, _, _ = _inputs(spark, d, facts=False)
    return ext.extract_faces(tables.faces, ext.visit_filter(visits, C), C)


def q03_filtered_docs(spark: SparkSession, d: str) -> DataFrame:
    """The document extract: period and type allowlist."""
    _, _, tdocs, _ = _inputs(spark, d, facts=False)
    return tdocs


def q03_filtered_extract(spark: SparkSession, d: str) -> DataFrame:
    """Documents through one set holding the period, the type allowlist and
    the visits' agents and outlets: each type restricts (AND between types)."""
    tables, visits, _, _ = _inputs(spark, d, facts=False)
    _, db = _bounds()
    fs = (ext.document_filter(spark, db, C)
          .add_ids(C.flt_agent, visits, "masterfid")
          .add_ids(C.flt_outlet, visits, "fid"))
    return ext.extract_documents(tables.orders, fs, C)


def _temp(spark, d, stage_docs=False):
    tables, visits, tdocs, _ = _inputs(spark, d, stage_docs=stage_docs, facts=False)
    temp = stg.banner_visits(tables.faces, tables.objattrs, visits, tables.items, C)
    return tables, visits, tdocs, temp


def q04_banner_visits(spark: SparkSession, d: str) -> DataFrame:
    """Outlets with banner, visits and the product found by outlet id."""
    return _temp(spark, d)[3]


def q05_listing_counts(spark: SparkSession, d: str) -> DataFrame:
    """Listed counts per (banner, product, visit start), default 0."""
    tables, _, _, temp = _temp(spark, d)
    return stg.listing_counts(temp, tables.objattrs, tables.items, C)


def _mixed_case(spark: SparkSession, d: str):
    """The tables with every other banner, product name and line text in capitals, under a collation that ignores case."""
    def mixed(df, column, by):
        return df.withColumn(column, F.when(F.col(by) % 2 == 0, F.upper(column)).otherwise(F.lower(column)))

    t = analog.tables(spark, d, C)
    lines = mixed(t.attrs.withColumn("attrtext", F.concat(F.lit("x"), "attrtext")), "attrtext", "orid")
    return with_collation(replace(t, objattrs=mixed(t.objattrs, "attrtext", "id"), items=mixed(t.items, "iname", "iid"), attrs=lines))


def _lower(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.lower(F.col(c).cast("string")) for c in columns})


def q04_collated(spark: SparkSession, d: str) -> DataFrame:
    """Banner visits over texts of mixed case: product names are found whatever their case (Q10)."""
    tables = _mixed_case(spark, d)
    _, visits, _, _ = _inputs(spark, d, facts=False)
    return _lower(stg.banner_visits(tables.faces, tables.objattrs, visits, tables.items, C), "attrtext")


def q05_collated(spark: SparkSession, d: str) -> DataFrame:
    """Listed counts where spellings of a banner are one banner: DISTINCT, GROUP BY and joins by the collation (Q10)."""
    tables = _mixed_case(spark, d)
    _, visits, _, _ = _inputs(spark, d, facts=False)
    temp = stg.banner_visits(tables.faces, tables.objattrs, visits, tables.items, C)
    return _lower(stg.listing_counts(temp, tables.objattrs, tables.items, C), "attrtext")


def q12_collated(spark: SparkSession, d: str) -> DataFrame:
    """The extra places pivot over texts of mixed case: MAX by the collation (Q10)."""
    tables = _mixed_case(spark, d)
    vb, db = _bounds()
    _, tdocs, facts = rpt.report_inputs(spark, tables, C, vb, db)
    return _lower(sec.extra_places(facts, tdocs, C), *C.extra_places)


def q06_facing_init(spark: SparkSession, d: str) -> DataFrame:
    """Initial facing rows: outlet x visit x stock-check document x named product."""
    tables, visits, tdocs, _ = _inputs(spark, d, facts=False)
    return stg.facing_initial(tables.faces, visits, tdocs, tables.attrs, tables.items, C)


def q07_facing_counts(spark: SparkSession, d: str) -> DataFrame:
    """Facing rows with the three counters under their date rules (C4)."""
    tables, visits, tdocs, _ = _inputs(spark, d, facts=False)
    return stg.facing_counts(tables.faces, visits, tdocs, tables.attrs, tables.items, C)


def q08_order_facts(spark: SparkSession, d: str) -> DataFrame:
    """Headers x active lines of visited agents and outlets."""
    _, _, _, facts = _inputs(spark, d)
    return facts


def q09_assortment(spark: SparkSession, d: str) -> DataFrame:
    """Distinct stock-document products per visit."""
    _, visits, _, facts = _inputs(spark, d)
    a = sec.assortment(facts, C.doc_stock)
    v = visits.select("masterfid", F.col("fid").alias("mfid"), "vdate")
    return v.join(a, ["masterfid", "mfid"]).select("masterfid", F.col("mfid").alias("fid"), "vdate", "id")


def q10_stock_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Stock products per visit with facing, shelf and store text and their total."""
    _, visits, _, facts = _inputs(spark, d, stage_facts=True)  # four reads of the facts
    a = sec.assortment(facts, C.doc_stock)
    v = visits.select("masterfid", F.col("fid").alias("mfid"), "vdate")
    base = v.join(a, ["masterfid", "mfid"])
    out = sec.stock_lookups(base, facts, C)
    return out.select(
        "masterfid", F.col("mfid").alias("fid"), "vdate", "id",
        "facing", "shelf_qty", "store_qty", "total_qty",
    )


def q11_latest_info(spark: SparkSession, d: str) -> DataFrame:
    """Order information of the latest order-info document, type not tested."""
    _, _, tdocs, facts = _inputs(spark, d)
    return sec.order_info(facts, tdocs, C)


def q12_extra_places(spark: SparkSession, d: str) -> DataFrame:
    """Extra places pivot of the latest 612-type document."""
    _, _, tdocs, facts = _inputs(spark, d)
    return sec.extra_places(facts, tdocs, C)


def q13_main_places(spark: SparkSession, d: str) -> DataFrame:
    """Main places pivot by object id of the latest 608-type document."""
    _, _, tdocs, facts = _inputs(spark, d)
    return sec.main_places(facts, tdocs, C)


def q14_promo_actions(spark: SparkSession, d: str) -> DataFrame:
    """Promo pivot of the latest 611-type document with product name."""
    tables, _, tdocs, facts = _inputs(spark, d)
    return sec.with_item_name(sec.promo_actions(facts, tdocs, C), tables.items, "id", "iname")


def q15_audit_report(spark: SparkSession, d: str) -> DataFrame:
    """The live 38-column report."""
    tables, visits, tdocs, facts = _inputs(spark, d, stage_docs=True)
    return rpt.audit_report(visits, tdocs, facts, tables.items, C)


def _factors(spark: SparkSession, d: str) -> fct.ReportFactors:
    """The live report's factors, written and read again."""
    tables, visits, tdocs, facts = _inputs(spark, d, stage_docs=True)
    path = f"{staged_root(spark)}/factors-{uuid.uuid4().hex}"
    fct.report_factors(visits, tdocs, facts, tables.items, C).write(path)
    return fct.ReportFactors.read(spark, path)


def q15_factors(spark: SparkSession, d: str) -> DataFrame:
    """The live report expanded from its written factors (K1)."""
    return fct.expand(_factors(spark, d), C)


def q15_row_counts(spark: SparkSession, d: str) -> DataFrame:
    """The live report's rows of each (agent, outlet), from the factors alone."""
    return fct.visit_rows(_factors(spark, d)).select("masterfid", F.col("mfid").alias("fid"), F.col("rows").alias("report_rows"))


def _turns(spark: SparkSession, d: str):
    conv = analog.table(spark, d, "conversations").select("conv_id", "turn", "role")
    a = conv.where(F.col("role") == "user").select(F.col("conv_id").alias("conv_a"), F.col("turn").alias("turn_a"))
    b = conv.where(F.col("role") == "assistant").select(F.col("conv_id").alias("conv_b"), F.col("turn").alias("turn_b"))
    return a, b


def q16_adjacent(spark: SparkSession, d: str) -> DataFrame:
    """User turn followed by an assistant turn at distance 1."""
    a, b = _turns(spark, d)
    out = offset_join(a, b, [("conv_a", "conv_b")], "turn_a", "turn_b", [1])
    return out.select(F.col("conv_a").alias("conv_id"), "turn_a", "turn_b")


def q17_band(spark: SparkSession, d: str) -> DataFrame:
    """User turn to assistant turns 1-7 later, flagged when within 4."""
    a, b = _turns(spark, d)
    out = band_join(a, b, [("conv_a", "conv_b")], "turn_a", "turn_b", 1, 7)
    return out.select(
        F.col("conv_a").alias("conv_id"), "turn_a", "turn_b",
        F.when((F.col("turn_b") - F.col("turn_a")).between(1, 4), 1).otherwise(0).alias("within_4"),
    )


def q18_neighbour(spark: SparkSession, d: str) -> DataFrame:
    """User turns left-joined to assistant turns at distance -1 or 1."""
    a, b = _turns(spark, d)
    out = offset_join(a, b, [("conv_a", "conv_b")], "turn_a", "turn_b", [-1, 1], how="left")
    return out.select(F.col("conv_a").alias("conv_id"), "turn_a", "turn_b")


def q19_format(spark: SparkSession, d: str) -> DataFrame:
    """Counters as text, their total and the presence percent, for facing
    rows against the listed count of the outlet's banner and product."""
    tables, visits, tdocs, temp = _temp(spark, d)
    counts = stg.listed_counts(temp, tables.objattrs, tables.items, C)
    fc = stg.facing_counts(tables.faces, visits, tdocs, tables.attrs, tables.items, C)
    banner = master_attribute(tables.objattrs, C.obj_banner_attr, C.outlet_dict).select(
        F.col("id").alias("_bid"), F.col("attrtext").alias("banner"))
    lst = counts.select(F.col("attrtext").alias("_lb"), F.col("iid").alias("_li"), "listed")
    out = fc.join(banner, fc.mfid == banner._bid, "left").join(
        lst, (lst._lb == F.col("banner")) & (lst._li == fc.itid), "left")
    return out.select(
        "mfid", "orid", "itid", "datebegin",
        blank_zero("facing").alias("facing_txt"), blank_zero("shelf").alias("shelf_txt"),
        blank_zero("store").alias("store_txt"), blank_zero("listed").alias("listed_txt"),
        count_total("facing", "shelf", "store", "listed").alias("total_qty"),
        presence_percent("facing", "listed").alias("presence_pct"),
    )


URL_FIELDS = {
    "gorod": r"^[a-z]+://([^/?#]+)",
    "street": r"^[a-z]+://[^/]+/([a-z][a-z])/",
    "dom": r"^[a-z]+://[^/]+/[a-z][a-z]/([0-9]+)",
    "nomertt": r"[?&]page=([0-9]+)",
}


def q19_address(spark: SparkSession, d: str) -> DataFrame:
    """Page URLs split into address parts."""
    pages = analog.table(spark, d, "pages").select(
        F.col("page_id").alias("fid"), F.col("url").alias("faddress"))
    return ext.with_address_parts(pages, replace(C, address_fields=URL_FIELDS))


def q20_role_lookups(spark: SparkSession, d: str) -> DataFrame:
    """Visits with outlet and agent names, banner, e-mail, comment and latest photo."""
    tables, visits, tdocs, _ = _inputs(spark, d, facts=False)
    _, db = _bounds()
    vis = visits.select("masterfid", "fid", "vdate", "datebegin")
    outlet = tables.faces.select(F.col("fid").alias("_of"), F.col("fname").alias("outlet_name"))
    agent = tables.agents.select(F.col("fid").alias("_af"), F.col("fname").alias("agent_name"))
    banner = master_attribute(tables.objattrs, C.obj_banner_attr, C.outlet_dict).select(
        F.col("id").alias("_bid"), F.col("attrtext").alias("banner"))
    email = master_attribute(tables.objattrs, C.obj_email_attr, active=True).select(
        F.col("id").alias("_eid"), F.col("attrtext").alias("email"))
    comments = tables.visit_comments.select(F.col("fid").alias("_cf"), F.col("vdate").alias("_cd"),
                                            F.col("comment").alias("visit_comment"))
    photo_docs = tdocs.where((F.col("ortype") == C.doc_photo) & date_in_period("ordate", db))
    photo = latest_documents(photo_docs, C.doc_photo).select(
        F.col("masterfid").alias("_pm"), F.col("mfid").alias("_pf"), F.col("orid").alias("photo_orid"))
    out = (
        vis.join(outlet, vis.fid == outlet._of, "left")
        .join(agent, vis.masterfid == agent._af, "left")
        .join(banner, vis.fid == banner._bid, "left")
        .join(email, vis.fid == email._eid, "left")
        .join(comments, (vis.fid == comments._cf) & (vis.vdate == comments._cd), "left")
        .join(photo, (vis.masterfid == photo._pm) & (vis.fid == photo._pf), "left")
    )
    return out.select(
        "masterfid", "fid", "vdate", "datebegin", "outlet_name", "agent_name", "banner", "email",
        "visit_comment", "photo_orid",
        concat_strict(F.col("_pm"), F.col("photo_orid")).alias("photo"),
    )


def _photo_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Documents with the attachments of `labels`, joined once and staged: the selection reads them twice."""
    docs = analog.table(spark, d, "documents").select("doc_id", "source", "lang")
    att = analog.table(spark, d, "labels").select(
        F.col("doc_id").alias("_att_doc"), F.col("doc_id").alias("fileid"))
    return stage(ph.photo_candidates(docs, att, [("doc_id", "_att_doc")]), "photo_candidates")


def q21_top_files(spark: SparkSession, d: str) -> DataFrame:
    """Documents left-joined to labels, ranked by running count inside source; rank < 4."""
    sel = ph.photo_selection(_photo_candidates(spark, d), "source", "fileid")
    return sel.select("doc_id", "source", "fileid", "rnk")


def q21_every_rank(spark: SparkSession, d: str) -> DataFrame:
    """The running-count rank of every row."""
    return running_count_rank(_photo_candidates(spark, d), "source", "fileid").select("doc_id", "source", "fileid", "rnk")


def q22_file_names(spark: SparkSession, d: str) -> DataFrame:
    """Export names of the selected files."""
    sel = ph.photo_selection(_photo_candidates(spark, d), "source", "fileid")
    named = ph.photo_names(sel, "fileid", "lang", "source", C.labels.photo_extension)
    return named.select("doc_id", "source", "fileid", "rnk", "file_name")


def q24_photo_export(spark: SparkSession, d: str) -> DataFrame:
    """The photo export (K3, P19, O3): the selected files are written to the shared folder and read
    back from it. A labelled document's file is the document's text."""
    docs = analog.table(spark, d, "documents").select("doc_id", "source", "lang")
    files = analog.table(spark, d, "documents").select(F.col("doc_id").alias("docid"), F.col("doc_id").alias("fileid"),
                                                       F.col("text").cast("binary").alias("filedata"))
    files = files.join(analog.table(spark, d, "labels").select(F.col("doc_id").alias("docid")).distinct(), "docid", "left_semi")
    target = f"{staged_root(spark)}/photos-{uuid.uuid4().hex}"
    target = target if "://" in target else "file://" + target.removeprefix("file:")
    written = ph.export_photos(docs, files, [("doc_id", "docid")], "source", "fileid", "lang", "source", "filedata", target)
    if written is None or not written.count():
        return spark.createDataFrame([], "file_name string, n_bytes long, sha256 string")
    found = spark.read.format("binaryFile").load(target)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("n_bytes"),
                        F.sha2("content", 256).alias("sha256"))


def q24_committed_export(spark: SparkSession, d: str) -> DataFrame:
    """The export from an attachment store by key (S6, K3): the labelled documents' texts are the store's files; the
    selection is made on ids alone, and only its files are opened, copied in pieces and committed as a whole."""
    docs = analog.table(spark, d, "documents").select("doc_id", "source", "lang", F.col("text").cast("binary").alias("data"))
    labels = analog.table(spark, d, "labels").select(F.col("doc_id").alias("fileid")).distinct()
    root = f"{staged_root(spark)}/attachments-{uuid.uuid4().hex}"
    root = root if "://" in root else "file://" + root.removeprefix("file:")
    stored = docs.join(labels, F.col("doc_id") == F.col("fileid")).withColumn("name", F.col("doc_id").cast("string"))
    write_files(stored, "name", "data", f"{root}/store")
    selected = ph.photo_selection(_photo_candidates(spark, d), "source", "fileid").where("fileid IS NOT NULL")
    named = ph.photo_names(selected, "fileid", "lang", "source", C.labels.photo_extension)
    write_files(named.withColumn("path", stored_at(f"{root}/store", F.col("fileid").cast("string"))), "file_name", "path", f"{root}/photos")
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*{C.labels.photo_extension}").load(f"{root}/photos")
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("n_bytes"),
                        F.sha2("content", 256).alias("sha256"))


def q23_full_report(spark: SparkSession, d: str) -> DataFrame:
    """The 42-column full report through its entry point (C10), with the row's place in the order of
    the whole report (O1)."""
    vb, db = _bounds()
    out = fr.run_full_report(spark, analog.tables(spark, d, C), C, vb, doc_bounds=db, keep_order=True)
    return whole_position(out, fr.REPORT_ORDER)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q01_period": q01_period,
    "q02_filter_set": q02_filter_set,
    "q02_caller_set": q02_caller_set,
    "q02_constant_set": q02_constant_set,
    "q02_composite_set": q02_composite_set,
    "q03_filtered_faces": q03_filtered_faces,
    "q03_filtered_docs": q03_filtered_docs,
    "q03_filtered_extract": q03_filtered_extract,
    "q03_coded_columns": q03_coded_columns,
    "q04_banner_visits": q04_banner_visits,
    "q04_collated": q04_collated,
    "q05_listing_counts": q05_listing_counts,
    "q05_collated": q05_collated,
    "q06_facing_init": q06_facing_init,
    "q07_facing_counts": q07_facing_counts,
    "q08_order_facts": q08_order_facts,
    "q09_assortment": q09_assortment,
    "q10_stock_lookup": q10_stock_lookup,
    "q11_latest_info": q11_latest_info,
    "q12_extra_places": q12_extra_places,
    "q12_collated": q12_collated,
    "q13_main_places": q13_main_places,
    "q14_promo_actions": q14_promo_actions,
    "q15_audit_report": q15_audit_report,
    "q15_factors": q15_factors,
    "q15_row_counts": q15_row_counts,
    "q16_adjacent": q16_adjacent,
    "q17_band": q17_band,
    "q18_neighbour": q18_neighbour,
    "q19_format": q19_format,
    "q19_address": q19_address,
    "q20_role_lookups": q20_role_lookups,
    "q21_top_files": q21_top_files,
    "q21_every_rank": q21_every_rank,
    "q22_file_names": q22_file_names,
    "q23_full_report": q23_full_report,
    "q24_photo_export": q24_photo_export,
    "q24_committed_export": q24_committed_export,
}
