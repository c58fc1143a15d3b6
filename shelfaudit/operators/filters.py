"""Typed filter sets: rows of ``(type, id, id2..id5, idstr)``.

A filter set restricts an extract: for every bound type, the extract's
column must be one of that type's ids. Types bound to the same group are
alternatives (OR); groups are conjuncts (AND). The restriction is an
``IN (subquery)`` so Catalyst plans it as a semi-join (or an existence join
under OR) and AQE turns it into a broadcast once the id set is measured
small; a large id set stays a shuffle join.

A row with several ids is matched as a whole: each id that a binding names must
equal its column (or fixed value) of the extract. A NULL id in a caller's row
stands for any value; in rows derived from data it matches nothing.

A period given when the plan is built is kept beside the rows as constant
bounds, so it reaches the Parquet scan as a pushed filter instead of a range
join. A period that is a row of a caller's set is read from the row: its bounds
become scalar subqueries, which the scan applies at run time. (Spark 4.1 skips
no Parquet row groups by timestamp_ntz, so it is a day column that saves reading.)
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfaudit.functions.period import period_filter

FILTER_SCHEMA = "type int, id bigint, id2 bigint, id3 bigint, id4 bigint, id5 bigint, idstr string"
_ID_FIELDS = ("id", "id2", "id3", "id4", "id5")


def _typed_rows(type_code: int, **cols: Column) -> list[Column]:
    out = [F.lit(type_code).cast("int").alias("type")]
    for f in _ID_FIELDS:
        out.append((cols[f] if f in cols else F.lit(None)).cast("bigint").alias(f))
    out.append((cols["idstr"] if "idstr" in cols else F.lit(None)).cast("string").alias("idstr"))
    return out


@dataclass(frozen=True)
class FilterSet:
    """Filter rows plus what is known about them when the plan is built.

    Rows are kept as recipes and become a DataFrame only when read (``rows``
    for display, ``ids`` for a data-derived type): applying a set of
    constant types and a period needs no DataFrame at all.
    """

    spark: SparkSession
    parts: tuple[tuple[int, Callable[[], DataFrame]], ...] = ()
    types: frozenset[int] = frozenset()
    period: tuple[Column, Column] | None = None
    period_type: int | None = None
    # the caller's rows may hold periods too (of ``period_type``)
    period_in_rows: bool = False
    # which ids the rows of a type have: (type, ids that aren't NULL), for a caller's rows
    shapes: frozenset[tuple[int, tuple[str, ...]]] = frozenset()
    # types whose rows are all literal constants, with their ids: applied as
    # a literal IN list, which the scan can use for row-group skipping
    constants: tuple[tuple[int, tuple[int, ...]], ...] = ()

    @cached_property
    def raw(self) -> DataFrame:
        """Union of all added rows; duplicates allowed (semi-joins ignore them)."""
        frames = [make() for _, make in self.parts]
        if not frames:
            return self.spark.createDataFrame([], FILTER_SCHEMA)
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    @property
    def rows(self) -> DataFrame:
        """The set's rows, duplicates collapsed (the original's UNION / DISTINCT)."""
        return self.raw.distinct()

    @staticmethod
    def empty(spark: SparkSession) -> FilterSet:
        return FilterSet(spark)

    @staticmethod
    def from_rows(rows: DataFrame, types: Iterable[int] = (), period_type: int | None = None) -> FilterSet:
        """A caller-supplied set: copy it, dropping columns outside the schema.

        Every type found in the rows restricts (one small aggregate reads the
        distinct types and which of their ids are filled); a type declared in
        ``types`` restricts even without rows, and then keeps nothing. Rows of
        ``period_type`` hold the period, ``begin;end`` in ``idstr``; several
        are alternatives, and one that can't be read keeps nothing.
        """
        filled = [F.col(f).isNotNull().alias(f) for f in _ID_FIELDS]
        found = rows.select("type", *filled).where(F.col("type").isNotNull()).distinct().collect()  # a handful
        shapes = frozenset((r.type, tuple(f for f in _ID_FIELDS if r[f])) for r in found)
        types = frozenset(types) | {r.type for r in found}
        part = (-1, lambda: rows.select("type", *_ID_FIELDS, "idstr"))
        return FilterSet(rows.sparkSession, (part,), types, period_type=period_type,
                         period_in_rows=period_type is not None and period_type in types, shapes=shapes)

    def _with(self, make: Callable[[], DataFrame], type_code: int,
              const_ids: tuple[int, ...] | None = None) -> FilterSet:
        consts = dict(self.constants)
        if const_ids is not None and (type_code not in self.types or type_code in consts):
            consts[type_code] = tuple(dict.fromkeys(consts.get(type_code, ()) + const_ids))
        else:
            consts.pop(type_code, None)
        return replace(self, parts=self.parts + ((type_code, make),), types=self.types | {type_code},
                       constants=tuple(consts.items()))

    def add_period(self, bounds: tuple[Column, Column], period_type: int) -> FilterSet:
        """Add the report period as one row and as pushed-down bounds."""
        spark = self.spark

        def make() -> DataFrame:
            text = F.concat_ws(";", bounds[0].cast("string"), bounds[1].cast("string"))
            return spark.range(1).select(*_typed_rows(period_type, idstr=text))

        return replace(self._with(make, period_type), period=bounds, period_type=period_type)

    def add_ids(self, type_code: int, source: DataFrame, id_col: str, **fixed: int | str) -> FilterSet:
        """Add one typed row per distinct value of ``source[id_col]``.

        ``fixed`` puts constants in other id columns, e.g. ``id=2`` with the
        value in ``id2``: pass ``target="id2"``.
        """
        target = str(fixed.pop("target", "id"))

        def make() -> DataFrame:
            cols = {k: F.lit(v) for k, v in fixed.items()}
            cols[target] = F.col(id_col)
            return source.select(*_typed_rows(type_code, **cols))

        return self._with(make, type_code)

    def add_constants(self, type_code: int, ids: Sequence[int]) -> FilterSet:
        """Add constant typed rows (a literal allowlist); duplicates collapse."""
        spark = self.spark
        uniq = tuple(int(i) for i in dict.fromkeys(ids))

        def make() -> DataFrame:
            data = [(type_code, i, None, None, None, None, None) for i in uniq]
            return spark.createDataFrame(data, FILTER_SCHEMA)

        return self._with(make, type_code, const_ids=uniq)

    def cleared(self) -> FilterSet:
        """An empty set on the same session (the set is rebuilt, not edited)."""
        return FilterSet.empty(self.spark)

    def rows_of(self, type_code: int) -> DataFrame:
        """Rows of one type; built from that type's own recipes when it has them."""
        own = [make for t, make in self.parts if t == type_code]
        if own and all(t != -1 for t, _ in self.parts):
            frames = [m() for m in own]
            out = frames[0]
            for f in frames[1:]:
                out = out.unionByName(f)
        else:
            out = self.raw
        return out.where(F.col("type") == type_code)

    def ids(self, type_code: int, field: str = "id") -> DataFrame:
        """Ids of one type."""
        return self.rows_of(type_code).select(F.col(field).alias("_fid"))

    def within_periods(self, df: DataFrame, column: str) -> DataFrame:
        """``df`` within the periods of the rows, or the one given when the plan was built."""
        begin, end, every = self.read_period()
        c, periods = F.col(column), F.col("_periods")
        found = c.between(begin, end) & F.exists(periods, lambda p: c.between(p["b"], p["e"]))
        if self.period is not None:
            found = found | c.between(*self.period)
        return df.withColumn("_periods", every).where(found).drop("_periods")

    def read_period(self) -> tuple[Column, Column, Column]:
        """First begin, last end and all (b, e) of the periods in the rows, as scalar subqueries."""
        part = F.split("idstr", ";")
        b, e = (F.get(part, F.lit(k)).try_cast("timestamp_ntz") for k in (0, 1))
        read = self.rows_of(self.period_type).select(b.alias("b"), e.alias("e")).where("b IS NOT NULL AND e IS NOT NULL")
        # sorted and limited, not aggregated: subqueries of one shape are merged into a struct, which the scan can't apply
        begin, end = read.select("b").orderBy("b").limit(1), read.select("e").orderBy(F.desc("e")).limit(1)
        return begin.scalar(), end.scalar(), read.select(F.collect_set(F.struct("b", "e"))).scalar()


@dataclass(frozen=True)
class Binding:
    """Which column of an extract a filter type restricts, from which id field.

    ``more`` binds further fields to columns, ``fixed`` to values that all rows
    of the extract have (such as the dictionary of its ids): a filter row is
    matched on all of them together.
    """

    column: str
    field: str = "id"
    group: str | None = None  # same group = alternatives
    more: tuple[tuple[str, str], ...] = ()     # (field, column)
    fixed: tuple[tuple[str, int], ...] = ()    # (field, value)


def _matches(fs: FilterSet, type_code: int, b: Binding) -> Column:
    """The extract's row equals some filter row of the type in all bound fields that the row fills."""
    rows = fs.rows_of(type_code)
    columns = {b.field: b.column, **dict(b.more)}
    filled = {s for t, s in fs.shapes if t == type_code}
    if not filled:
        # rows derived from data: all their bound ids are meant, a NULL matches nothing
        for field, value in b.fixed:
            rows = rows.where(F.col(field) == value)
        return _one_of(columns, tuple(columns), rows)
    for field, value in b.fixed:
        rows = rows.where(F.col(field).isNull() | (F.col(field) == value))
    cond = F.lit(False)
    for own in sorted({tuple(f for f in columns if f in s) for s in filled}):
        like_this = rows
        for f in columns:
            like_this = like_this.where(F.col(f).isNotNull() if f in own else F.col(f).isNull())
        cond = cond | (_one_of(columns, own, like_this) if own else like_this.exists())
    return cond


def _one_of(columns: Mapping[str, str], fields: Sequence[str], rows: DataFrame) -> Column:
    wanted = rows.select(*[F.col(f).alias(f"_{f}") for f in fields])
    if len(fields) == 1:
        return F.col(columns[fields[0]]).isin(wanted)
    return F.struct(*[F.col(columns[f]) for f in fields]).isin(wanted)


def apply_filters(
    df: DataFrame,
    fs: FilterSet,
    bindings: Mapping[int, Binding],
    period_column: str | None = None,
    day_col: str | None = None,
) -> DataFrame:
    """Restrict ``df`` by the set: bound types present in ``fs`` only.

    Types of ``fs`` not bound for this extract are ignored (an extract only
    understands its own types); a bound type present with no rows keeps
    nothing.
    """
    if period_column is not None and fs.period_in_rows:
        df = fs.within_periods(df, period_column)
        if day_col is not None and fs.period is None:
            begin, end, _ = fs.read_period()
            df = df.where(F.col(day_col).between(F.to_date(begin), F.to_date(end)))
    elif period_column is not None and fs.period is not None:
        df = period_filter(df, period_column, fs.period, day_col=day_col)
    groups: dict[str, list[Column]] = {}
    consts = dict(fs.constants)
    for type_code, b in bindings.items():
        if type_code not in fs.types:
            continue
        if type_code in consts and b.field == "id" and not b.more and not b.fixed:
            cond = F.col(b.column).isin(list(consts[type_code]))
        else:
            cond = _matches(fs, type_code, b)
        groups.setdefault(b.group or f"_t{type_code}", []).append(cond)
    for conds in groups.values():
        cond = conds[0]
        for c in conds[1:]:
            cond = cond | c
        df = df.where(cond)
    return df
