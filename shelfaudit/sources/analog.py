"""Analog views of the report's inputs over the TPC-H-like test tables.

The DuckDB oracle derives the same views with its own SQL in
``shelfaudit.catalog.oracle``; the two must agree.

* orders: agent = AGENT_BASE + nation key, outlet = customer key; the
  document id is the customer key x 1000 plus the order's number within the
  customer (by date, then key), so that an outlet's documents are neighbours,
  and its documents take the types in turn (TYPE_TURNS).
* attrs: one EAV line per lineitem of that order: the object is one of six
  places, the part or the outlet's own product (the customer key), by the
  quantity mod 4; attribute = round(tax * 100), text = "<int quantity>.<line
  number>", active if the line is open, dictionary 2 if the return flag is N
  else 1, line time = order date, 14 hours later for each third line.
* visits: distinct (agent, outlet, order date) of the orders in a period.
* items = part; objattrs = outlet banners (market segment), product
  listings per banner (open lines), outlet e-mails.
* faces: outlets, with an address text, and agents in one table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfaudit.session import application_id, stage
from shelfaudit.sources.tables import AuditTables

# Fixed values of the analog: the types an outlet's documents take in turn.
TYPE_TURNS = (608, 612, 608, 610, 611, 613)
LOW_PRIORITY = "5-LOW"
EMAIL_DOMAIN = "@example.com"
AGENT_BASE = 1_000_000_000
DOCS_PER_OUTLET = 1000


_TABLES: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, resolved once per application (the definition, not data)."""
    key = (application_id(spark), sf_dir, name)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _TABLES[key]


def _read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return table(spark, sf_dir, name).select(*cols)


def numbered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their document number and their customer's nation and segment."""
    o = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    nth = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    o = o.withColumn("_orid", F.col("o_custkey") * DOCS_PER_OUTLET + nth)
    c = _read(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey).drop("c_custkey")


def orders(spark: SparkSession, sf_dir: str, numbered: DataFrame | None = None) -> DataFrame:
    o = numbered_orders(spark, sf_dir) if numbered is None else numbered
    n = _read(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    turn = F.pmod(F.col("_orid") - F.col("o_custkey") * (DOCS_PER_OUTLET - 1), F.lit(len(TYPE_TURNS))).cast("int")
    ortype = F.get(F.array(*[F.lit(t) for t in TYPE_TURNS]), turn)
    return (
        o.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            (F.col("c_nationkey").cast("long") + AGENT_BASE).alias("masterfid"),
            F.col("_orid").alias("orid"),
            F.col("o_orderdate").alias("ordate"),
            F.col("n_regionkey").alias("ownerdistid"),
            F.col("o_custkey").alias("mfid"),
            F.col("o_custkey").alias("ufid"),
            ortype.alias("ortype"),
            F.lit(None).cast("bigint").alias("masterdocid"),
            F.col("o_orderstatus").alias("orcomment"),
            "o_orderkey",
        )
    )


def attrs(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """EAV lines of ``docs`` (``orders`` with its order key)."""
    li = _read(
        spark, sf_dir, "lineitem",
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_tax", "l_returnflag", "l_linestatus",
    )
    ln, quantity = F.col("l_linenumber"), F.col("l_quantity").cast("bigint")
    # the join moves every line: the part only where it is the object, the two flags as bits of one number
    bits = F.when(F.col("l_returnflag") == "N", 2).otherwise(0) + F.when(F.col("l_linestatus") == "O", 1).otherwise(0)
    li = li.select("l_orderkey", F.when(quantity % 4 == 2, F.col("l_partkey")).alias("part"), "l_linenumber", "l_quantity", "l_tax", bits.alias("bits"))
    small = 1 + (ln + F.col("mfid")) % 6
    obj_id = F.when(quantity % 4 < 2, small).when(quantity % 4 == 2, F.col("part")).otherwise(F.col("mfid"))
    return li.join(docs.select("o_orderkey", "masterfid", "orid", "mfid", "ordate"), li.l_orderkey == F.col("o_orderkey")).select(
        "masterfid",
        "orid",
        obj_id.alias("id"),
        F.when(F.col("bits").bitwiseAND(2) == 2, F.lit(2)).otherwise(F.lit(1)).alias("dictid"),
        F.round(F.col("l_tax") * 100).cast("int").alias("attrid"),
        F.concat(quantity.cast("string"), F.lit("."), ln.cast("string")).alias("attrtext"),
        F.col("bits").bitwiseAND(1).alias("activeflag"),
        (F.col("ordate") + F.make_dt_interval(F.lit(0), F.floor((ln - 1) / 3).cast("int") * 14)).alias("objdate"),
    )


def visit_source(docs: DataFrame) -> DataFrame:
    """Visit candidates: one per (agent, outlet, document time)."""
    return docs.select(
        "ownerdistid",
        "masterfid",
        F.col("mfid").alias("fid"),
        F.col("ordate").alias("vdate"),
        F.col("ordate").alias("datebegin"),
        F.col("ordate").alias("dateend"),
        F.when(F.col("orcomment") == "F", F.lit("closed")).otherwise(F.lit("")).alias("otkazstr"),
        F.lit(0).alias("pda"),
        F.to_date("ordate").cast("timestamp_ntz").alias("vdateonly"),
    ).distinct()


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "part", "p_partkey", "p_name").select(
        F.col("p_partkey").alias("iid"), F.col("p_name").alias("iname")
    )


def objattrs(spark: SparkSession, sf_dir: str, banner_attr: int, email_attr: int,
             outlet_dict: int = 2, product_dict: int = 1, numbered: DataFrame | None = None) -> DataFrame:
    c = _read(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    banners = c.select(
        F.col("c_custkey").alias("id"), F.lit(outlet_dict).alias("dictid"), F.lit(banner_attr).alias("attrid"),
        F.col("c_mktsegment").alias("attrtext"), F.lit(1).alias("activeflag"),
    )
    emails = c.select(
        F.col("c_custkey").alias("id"), F.lit(outlet_dict).alias("dictid"), F.lit(email_attr).alias("attrid"),
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit(EMAIL_DOMAIN)).alias("attrtext"),
        F.lit(1).alias("activeflag"),
    )
    li = _read(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linestatus").where(F.col("l_linestatus") == "O")
    o = (numbered_orders(spark, sf_dir) if numbered is None else numbered).select("o_orderkey", "c_mktsegment")
    listings = (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .select(F.col("c_mktsegment").alias("attrtext"), F.col("l_partkey").alias("id"))
        .distinct()
        .select(
            "id", F.lit(product_dict).alias("dictid"), F.lit(banner_attr).alias("attrid"), "attrtext",
            F.lit(1).alias("activeflag"),
        )
    )
    return banners.unionByName(listings).unionByName(emails)


def faces(spark: SparkSession, sf_dir: str, outlet_type: int = 7) -> DataFrame:
    """Outlets (customers) with an address text, and agents (nations), in one table."""
    c = _read(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey")
    n = _read(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    key = F.col("c_custkey")
    address = F.format_string(
        "г. Город %d, ул. Улица %d, д. %d, № %d", F.col("c_nationkey"), key % 50, key % 90 + 1, key)
    outlets = c.join(n, c.c_nationkey == n.n_nationkey).select(
        key.alias("fid"), F.col("c_name").alias("fname"), key.cast("string").alias("exid"),
        F.lit(outlet_type).alias("ftype"), F.col("n_regionkey").alias("ownerdistid"), address.alias("faddress"),
    )
    agent = F.col("n_nationkey").cast("bigint") + AGENT_BASE
    agents = n.select(
        agent.alias("fid"), F.col("n_name").alias("fname"), agent.cast("string").alias("exid"),
        F.lit(1).alias("ftype"), F.col("n_regionkey").alias("ownerdistid"), F.lit(None).cast("string").alias("faddress"),
    )
    return outlets.unionByName(agents)


def visit_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    return o.where(F.col("o_orderpriority") == LOW_PRIORITY).select(
        F.col("o_custkey").alias("fid"),
        F.col("o_orderdate").alias("vdate"),
        F.concat(F.lit("status "), F.col("o_orderstatus")).alias("comment"),
    )


_STAGED: dict[tuple, DataFrame] = {}


def _staged(spark: SparkSession, key: tuple, build) -> DataFrame:
    """Derive an analog view once per application and data folder and keep it
    as Parquet, so that it behaves like the base table it stands for."""
    full = (application_id(spark),) + key
    if full not in _STAGED:
        _STAGED[full] = stage(build(), "analog_" + "_".join(str(k) for k in key[1:]))
    return _STAGED[full]


def _defined(spark: SparkSession, key: tuple, build) -> DataFrame:
    """A view of the test tables, defined once per application."""
    full = (application_id(spark), "def") + key
    if full not in _TABLES:
        _TABLES[full] = build()
    return _TABLES[full]


def tables(spark: SparkSession, sf_dir: str, codes, staged: bool = True) -> AuditTables:
    """The report's inputs over the test tables.

    The numbered orders are staged once (unless ``staged=False``): a window and a join that most
    others read. The others are definitions: a query's filters and semi-joins reach the test tables
    before their joins, and what it doesn't read isn't built.
    """
    numbered = _staged(spark, (sf_dir, "orders"), lambda: numbered_orders(spark, sf_dir)) if staged else numbered_orders(spark, sf_dir)

    def defined(name, build):
        return _defined(spark, (sf_dir, name, staged), build)

    docs = defined("documents_of_orders", lambda: orders(spark, sf_dir, numbered))

    people = defined(f"faces_{codes.outlet_face_type}", lambda: faces(spark, sf_dir, codes.outlet_face_type))
    return AuditTables(
        orders=docs,
        attrs=defined("attrs", lambda: attrs(spark, sf_dir, docs)),
        objattrs=defined(f"objattrs_{codes.obj_banner_attr}_{codes.obj_email_attr}_{codes.outlet_dict}_{codes.product_dict}",
                         lambda: objattrs(spark, sf_dir, codes.obj_banner_attr, codes.obj_email_attr,
                                          codes.outlet_dict, codes.product_dict, numbered)),
        items=defined("items", lambda: items(spark, sf_dir)),
        visit_source=defined("visit_source", lambda: visit_source(docs)),
        faces=people,
        agents=people,
        visit_comments=defined("visit_comments", lambda: visit_comments(spark, sf_dir)),
    )
