"""The live report as its factors (K1, J12): class rows with counts, expanded on reading.

A visit's rows are the product of its three assortments, its order information
and its own repetitions. The factors hold each of these once: equal rows are
one class row with ``times``. They grow with the sum of the assortments, the
report with their product, so a report is kept and moved as factors, its size
is known before any of it is built, and rows are built where they are read.

Expansion is balanced by exact counts: a visit of more than ``part_rows`` rows is cut
along as many of its three blocks as it takes, each block row going to its part
by a hash and repeated for the parts of the others. A class row of many equal
rows counts as several pieces of PIECE rows, so that no task builds one alone.

Defined results: visits without rows in a block have none in the report; NULL
keys match nothing; empty inputs give empty factors and an empty report.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfaudit.config import AuditCodes
from shelfaudit.plans.one_pass import staged_sections
from shelfaudit.plans.report import PART_ROWS, VISIT_KEYS, report_blocks, report_values
from shelfaudit.session import stage

TIMES = "times"
#: Equal rows that one piece of a class row stands for, at most.
PIECE = 10_000


@dataclass(frozen=True)
class ReportFactors:
    """Class rows by (masterfid, mfid): the visits with their order information, and the three blocks."""

    visits: DataFrame
    stock: DataFrame
    places: DataFrame
    promo: DataFrame

    def write(self, path: str) -> None:
        """One Parquet folder a factor below ``path``."""
        for f in fields(self):
            getattr(self, f.name).write.mode("errorifexists").parquet(f"{path}/{f.name}")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> ReportFactors:
        return cls(*[spark.read.parquet(f"{path}/{f.name}") for f in fields(cls)])

    def staged(self) -> ReportFactors:
        """The factors written once under the checkpoint folder: counting and expanding read them twice."""
        return ReportFactors(*[stage(getattr(self, f.name), f"factor-{f.name}") for f in fields(self)])


def _classes(df: DataFrame) -> DataFrame:
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(TIMES))


def report_factors(visits: DataFrame, tdocs: DataFrame, facts: DataFrame, items: DataFrame, codes: AuditCodes) -> ReportFactors:
    """The factors of the live report; no product is formed."""
    vis, stock, places, promo, info = report_blocks(visits, tdocs, staged_sections(facts, tdocs, codes), items, codes)
    return ReportFactors(*[_classes(df) for df in (vis.join(info, VISIT_KEYS, "left"), stock, places, promo)])


def visit_rows(factors: ReportFactors) -> DataFrame:
    """(masterfid, mfid, rows): the report's rows of each visit, from the factors alone."""
    out, rows = None, F.lit(1).cast("long")
    for f in fields(factors):
        held = getattr(factors, f.name).groupBy(*VISIT_KEYS).agg(F.sum(TIMES).alias(f"_{f.name}"))
        out = held if out is None else out.join(held, VISIT_KEYS)
        rows = rows * F.col(f"_{f.name}")
    return out.select(*VISIT_KEYS, rows.alias("rows"))


def _pieces(block: DataFrame, name: str) -> DataFrame:
    """``block`` with class rows of more than PIECE equal rows in several pieces; ``_t_<name>`` is a piece's rows."""
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(TIMES) - 1) / PIECE).cast("long")))
    cut = block.select("*", each.alias(f"_at_{name}"))
    return cut.withColumn(f"_t_{name}", F.least(F.lit(PIECE).cast("long"), F.col(TIMES) - F.col(f"_at_{name}") * PIECE)).drop(TIMES)


def _cuts(pieces: dict[str, DataFrame], factors: ReportFactors, part_rows: int) -> DataFrame:
    """(masterfid, mfid, _c_stock, _c_places, _c_promo): into how many parts each block of a visit goes."""
    out, left = visit_rows(factors).withColumn("_parts", F.ceil(F.col("rows") / part_rows)), F.col("_parts")
    for name, block in pieces.items():
        out = out.join(block.groupBy(*VISIT_KEYS).agg(F.count(F.lit(1)).alias(f"_n_{name}")), VISIT_KEYS)
    for name in pieces:
        out = out.withColumn(f"_c_{name}", F.least(left, F.col(f"_n_{name}")).cast("long"))
        out = out.withColumn("_parts", F.ceil(F.col("_parts") / F.col(f"_c_{name}")))
    return out.select(*VISIT_KEYS, *[f"_c_{name}" for name in pieces])


def expand(factors: ReportFactors, codes: AuditCodes, part_rows: int = PART_ROWS) -> DataFrame:
    """The 38-column report of the factors, which are read twice (counted and joined): give written or staged ones."""
    names = ("stock", "places", "promo")
    pieces = {n: _pieces(getattr(factors, n), n) for n in names}
    cuts = stage(_cuts(pieces, factors, part_rows), "factor-cuts")

    def part(own: str, held: list[str]) -> Column:
        """The number of a part: a block's own place by a hash, the others' all in turn."""
        number = F.lit(0).cast("long")
        for n in names:
            at = F.pmod(F.xxhash64(*held), F.col(f"_c_{n}")) if n == own else F.col(f"_p_{n}")
            number = number * F.col(f"_c_{n}") + at
        return number

    out = None
    for n, block in pieces.items():
        spread = block.join(cuts, VISIT_KEYS)
        for other in names:
            if other != n:
                spread = spread.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"_c_{other}") - 1)).alias(f"_p_{other}"))
        spread = spread.withColumn("_part", part(n, block.columns)).select(*block.columns, "_part")
        out = spread if out is None else out.join(spread, [*VISIT_KEYS, "_part"])
    out = out.join(_pieces(factors.visits, "visits"), VISIT_KEYS)
    for n in ("visits", *names):
        out = out.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"_t_{n}"))).alias(f"_e_{n}")).drop(f"_e_{n}")
    return out.select(*report_values(codes))
