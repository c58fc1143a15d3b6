"""The report's inputs as DataFrames.

``AuditTables`` names the relations the pipelines read. A deployment fills
it from its own Parquet tables with ``AuditTables.from_parquet``; the test
catalogue fills it from analog views over the test data
(``shelfaudit.sources.analog``). Readers select only the columns the report
uses, so the scan's ``ReadSchema`` stays narrow.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The input columns' names, as the pipelines read them.
ORDER_COLS = ("masterfid", "orid", "ordate", "ownerdistid", "mfid", "ufid", "ortype", "masterdocid", "orcomment")
ATTR_COLS = ("masterfid", "orid", "id", "dictid", "attrid", "attrtext", "activeflag", "objdate")
OBJATTR_COLS = ("id", "dictid", "attrid", "attrtext", "activeflag")
ITEM_COLS = ("iid", "iname")
VISIT_COLS = ("ownerdistid", "masterfid", "fid", "vdate", "datebegin", "dateend", "otkazstr", "pda", "vdateonly")
FACE_COLS = ("fid", "fname", "exid", "ftype", "ownerdistid", "faddress")
COMMENT_COLS = ("fid", "vdate", "comment")
ATTACHMENT_COLS = ("masterfid", "docid", "fileid", "filedata")


@dataclass(frozen=True)
class AuditTables:
    orders: DataFrame          # document headers
    attrs: DataFrame           # document EAV lines
    objattrs: DataFrame        # master-data EAV
    items: DataFrame           # product names
    visit_source: DataFrame    # visit rows before the period / filter extract
    faces: DataFrame           # outlets and persons
    agents: DataFrame          # persons in the agent role (may be ``faces``)
    visit_comments: DataFrame | None = None
    attachments: DataFrame | None = None
    # layouts that the writer of the tables guarantees; off unless stated
    order_day: str | None = None                 # column of ``orders`` = CAST(ordate AS DATE)
    visit_day: str | None = None                 # column of ``visit_source`` = CAST(vdate AS DATE)
    line_block: tuple[str, int] | None = None    # (column of ``attrs``, size): column = floor(orid / size)

    @staticmethod
    def from_parquet(spark: SparkSession, root: str, order_day: str | None = None, visit_day: str | None = None,
                     line_block: tuple[str, int] | None = None) -> AuditTables:
        """Tables stored as ``<root>/<name>`` Parquet folders with the columns above.

        The three layout arguments are promises of whoever writes the tables
        (see the fields); filters use them to prune partitions.
        """

        def read(name: str, cols, *layout: str | None) -> DataFrame:
            return spark.read.parquet(os.path.join(root, name)).select(*cols, *[c for c in layout if c])

        faces = read("faces", FACE_COLS)
        return AuditTables(
            orders=read("orders", ORDER_COLS, order_day),
            attrs=read("order_attributes", ATTR_COLS, line_block[0] if line_block else None),
            objattrs=read("object_attributes", OBJATTR_COLS),
            items=read("items", ITEM_COLS),
            visit_source=read("visits", VISIT_COLS, visit_day),
            faces=faces,
            agents=faces,
            visit_comments=read("visit_comments", COMMENT_COLS),
            attachments=read("attachments", ATTACHMENT_COLS),
            order_day=order_day,
            visit_day=visit_day,
            line_block=line_block,
        )


def with_collation(tables: AuditTables, collation: str = "UTF8_LCASE") -> AuditTables:
    """The tables with their compared texts under a Spark string collation.

    Attribute texts and product names then compare by it wherever a pipeline
    compares them: join keys, IN lists, substring and prefix tests, DISTINCT,
    GROUP BY and MAX. Which spelling a DISTINCT or MAX shows among equal ones is
    not defined.
    """
    def collated(df: DataFrame, column: str) -> DataFrame:
        return df.withColumn(column, F.collate(column, collation))

    return replace(tables, attrs=collated(tables.attrs, "attrtext"), objattrs=collated(tables.objattrs, "attrtext"),
                   items=collated(tables.items, "iname"))
