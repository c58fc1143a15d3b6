"""Small hand-made inputs with the report's schemas."""

import datetime as dt

ORDERS = ("masterfid int, orid long, ordate timestamp_ntz, ownerdistid int, mfid long, ufid long, ortype int, "
          "masterdocid long, orcomment string")
ATTRS = ("masterfid int, orid long, id long, dictid int, attrid int, attrtext string, activeflag int, "
         "objdate timestamp_ntz")
VISITS = ("ownerdistid int, masterfid int, fid long, vdate timestamp_ntz, datebegin timestamp_ntz, "
          "dateend timestamp_ntz, otkazstr string, pda int, vdateonly timestamp_ntz")
FACTS = ("masterfid int, mfid long, orid long, ortype int, attrid int, ordate timestamp_ntz, attrtext string, "
         "id long, dictid int")


def t(text):
    return dt.datetime.fromisoformat(text)


def orders(spark, rows):
    """rows: (masterfid, orid, ordate, mfid, ortype)"""
    return spark.createDataFrame(
        [(m, o, t(d) if isinstance(d, str) else d, 1, f, f, ty, None, None) for m, o, d, f, ty in rows], ORDERS)


def attrs(spark, rows):
    """rows: (masterfid, orid, id, dictid, attrid, attrtext, activeflag, objdate)"""
    return spark.createDataFrame(
        [(m, o, i, dc, a, tx, af, t(od) if isinstance(od, str) else od) for m, o, i, dc, a, tx, af, od in rows], ATTRS)


def visits(spark, rows):
    """rows: (masterfid, fid, vdate)"""
    out = []
    for m, f, d in rows:
        d = t(d)
        out.append((1, m, f, d, d, d, "", 0, d.replace(hour=0, minute=0, second=0, microsecond=0)))
    return spark.createDataFrame(out, VISITS)


def facts(spark, rows):
    """rows: (masterfid, mfid, orid, ortype, attrid, ordate, attrtext, id, dictid)"""
    return spark.createDataFrame(
        [(m, f, o, ty, a, t(d), tx, i, dc) for m, f, o, ty, a, d, tx, i, dc in rows], FACTS)
