"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Method: the sources' targets share the total size by weight, a target stops at
``max_epochs`` times its source's size, and the excess is shared again by
weight until none is above. Each source's documents are shuffled by a hash;
passing over a source up to ``max_epochs`` times, a document's virtual finish
time is its source's words so far divided by the source's target. All
documents of all sources are put in ranges of virtual finish time, and taken
in that order as long as the running total stays within the budget, the total
size.

Scale: a source, or an id, may hold a third of all rows, so running sums are
two-level: totals of slices of the order, then sums within a slice. Targets take
a fixed number of jobs, whatever the number of sources. The global order
is never sorted in one task: a histogram over 2^RANGE_BITS ranges of finish time
finds the range where the budget ends, that range is divided again until it
holds at most ``LAST_RANGE`` rows, and only its rows are summed in order.
Texts are read once, for their sizes, and never move.

Defined results: a null or empty text has size 0 and is taken 0 words; the
null source is a source, last in order; repeated rows are documents of their
own; equal hashes go by id; an empty table gives an empty result; other
columns are ignored. The same rows give the same mix on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfaudit.llm.common import SPACE_WORD
from shelfaudit.session import stage

#: Virtual time as a whole number of so many bits; a histogram divides it by RANGE_BITS at a time.
TIME_BITS, RANGE_BITS = 48, 12
#: Rows that are summed in one order at most, unless they all finish at the same time.
LAST_RANGE = 100_000
MAX_EPOCHS = 3
WEIGHTS = (5, 2, 1)


def text_size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size long, target double) of every source of ``sized`` (source, size).

    Sources take ``weights`` in turn, by code point, null last.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = _with_before(totals.withColumn("one", F.lit(1)), [F.asc_nulls_last("source")], ["one"], "mix-sources")
    turn = F.pmod(F.col("before_one"), F.lit(len(weights))).cast("int")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), turn)
    cap = F.col("source_size") * max_epochs
    weighed = ranked.select("source", "source_size", weight.alias("weight"), cap.alias("cap"))
    # sources reach their caps in the order of cap to weight: one does if the share that is left,
    # with all before it at their caps, is above its cap
    order = [F.asc_nulls_last(F.when(F.col("weight") > 0, F.col("cap") / F.col("weight"))), F.asc_nulls_last("source")]
    ordered = _with_before(weighed, order, ["cap", "weight"], "mix-weights")
    whole = ordered.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    total, weight_sum = whole.size or 0, whole.weight or 0.0
    above = F.col("weight") * (F.lit(total) - F.col("before_cap")) > F.col("cap") * (F.lit(weight_sum) - F.col("before_weight"))
    at_cap = ordered.agg(F.sum(F.when(above, F.col("cap"))).alias("cap"), F.sum(F.when(above, F.col("weight"))).alias("weight")).first()
    left = weight_sum - (at_cap.weight or 0.0)
    share = (total - (at_cap.cap or 0)) / left if left > 0 else 0.0
    target = F.when(above, F.col("cap").cast("double")).otherwise(F.col("weight") * F.lit(share))
    return ordered.select("source", "source_size", target.alias("target"))


def _with_before(table: DataFrame, order: list[Column], sums: list[str], name: str) -> DataFrame:
    """``table`` with ``before_<c>`` for each column of ``sums``: its sum over the rows before, in ``order``.

    The sorted rows are staged with the number of their range; a range's own sums are added to those of the ranges before.
    """
    ranged = stage(table.orderBy(*order).withColumn("part", F.spark_partition_id()), name)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    parts = ranged.groupBy("part").agg(*[F.sum(c).alias(c) for c in sums])
    parts = parts.select(F.col("part").alias("p"), *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"p_{c}") for c in sums])
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.select("*", *[F.coalesce(F.sum(c).over(within), F.lit(0)).alias(f"w_{c}") for c in sums]).join(parts, F.col("part") == F.col("p"))
    return out.select(*table.columns, *[(F.col(f"p_{c}") + F.col(f"w_{c}")).alias(f"before_{c}") for c in sums])


def _in_order(sized: DataFrame, seed: int) -> DataFrame:
    """``sized`` with ``key`` and ``upto``: the source's words up to and with the row, in hash order.

    Slices are ranges of (source, key, id, size, row), so rows of one id, or without one, are cut as any others.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"))
    ranged = sized.withColumn("key", key).repartitionByRange("source", "key", "id", "size", "row")
    keyed = stage(ranged.withColumn("slice", F.spark_partition_id()), "mix-slices")
    slices = keyed.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    slices = slices.select(F.col("source").alias("s"), F.col("slice").alias("l"), F.coalesce(before, F.lit(0)).alias("before"))
    within = F.sum("size").over(Window.partitionBy("source", "slice").orderBy("key", "id", "size", "row").rowsBetween(Window.unboundedPreceding, 0))
    return (
        keyed.withColumn("within", within)
        .join(slices, F.col("source").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("l")))
        .withColumn("upto", F.col("before") + F.col("within")).drop("s", "l", "before", "within", "slice")
    )


def schedule(sized: DataFrame, targets: DataFrame, max_epochs: int = MAX_EPOCHS, seed: int = 42) -> DataFrame:
    """The mix: (row, id, source, size, epoch, key, finish) of every pass of a document that is taken.

    ``repartitionByRange("finish").sortWithinPartitions("finish", "source", "epoch", "key", "id")``
    writes it in its order.
    """
    named = targets.select(F.col("source").alias("t_source"), "source_size", "target")
    finish = (F.col("epoch") * F.col("source_size") + F.col("upto")).cast("double") / F.col("target")
    queue = (
        _in_order(sized, seed).join(named, F.col("source").eqNullSafe(F.col("t_source")))
        .filter((F.col("size") > 0) & (F.col("target") > 0))
        .withColumn("epoch", F.explode(F.array(*[F.lit(e) for e in range(max_epochs)])))
        .withColumn("finish", finish)
        # the same order as whole numbers of TIME_BITS bits; finish 1, about where the budget ends, is in the middle
        .withColumn("time", F.floor((F.lit(1.0) - F.lit(1.0) / (F.lit(1.0) + F.col("finish"))) * F.lit(float(1 << TIME_BITS))).cast("long"))
        .select("row", "id", "source", "size", "epoch", "key", "finish", "time")
    )
    queue = stage(queue, "mix-queue")
    budget = sized.agg(F.sum("size")).first()[0] or 0
    rest, inside, end = budget, F.lit(True), None
    for shift in range(TIME_BITS - RANGE_BITS, -1, -RANGE_BITS):
        place = F.shiftright("time", shift)
        ranges = queue.filter(inside).groupBy(place.alias("place")).agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
        end = None
        for r in ranges.orderBy("place").collect():  # 2^RANGE_BITS rows at most
            if r.words > rest:
                end = r
                break
            rest -= r.words
        if end is None:  # nothing is left over: all passes fit
            return queue.drop("time")
        inside, below = place == end.place, F.col("time") < F.lit(end.place << shift)
        if end.n <= LAST_RANGE:
            break
    order = Window.orderBy("finish", F.asc_nulls_last("source"), "epoch", "key", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    edge = queue.filter(inside).withColumn("so_far", F.sum("size").over(order)).filter(F.col("so_far") <= rest).drop("so_far")
    return queue.filter(below).unionByName(edge).drop("time")


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None) -> DataFrame:
    """Staged (row, id, source, size); row tells repeated ids apart: the caller's ``row_col``, or a number given here."""
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    return stage(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), text_size(F.col(text_col)).alias("size"), row.alias("row")), "mix-sizes")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None) -> DataFrame:
    """One row (id, source, size, source_size, target, taken) per row of ``docs``; taken counts repeats.

    With ``row_col``, a column of ``docs`` that no two rows share, each row has it as ``row`` too.
    """
    sized = sizes(docs, id_col, text_col, source_col, row_col)
    targets = stage(source_targets(sized, weights, max_epochs), "mix-targets")
    taken = schedule(sized, targets, max_epochs, seed).groupBy(F.col("row").alias("t_row")).agg(F.sum("size").alias("taken"))
    named = targets.select(F.col("source").alias("t_source"), "source_size", "target")
    return (
        sized.join(taken, F.col("row") == F.col("t_row"), "left")
        .join(named, F.col("source").eqNullSafe(F.col("t_source")), "left")
        .select(*(["row"] if row_col else []), "id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )
