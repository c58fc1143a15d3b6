"""Hard-negative mining with Kronecker-packed products.

Method: a block of candidates is written as one wide integer for each vector
component: every candidate's whole-number component, biased so that it isn't
negative, stands in a field of its own, wide enough that no sum of products
runs over into the next. For an anchor each wide integer is multiplied once by
the anchor's (biased) component; the sum of the products holds the biased inner
products of all candidates of the block, and what the biases added is taken off
when the fields are unpacked, so scores are exact. A block's field width
follows from its own components.

An anchor's positives are its best rows of the same label; for each positive
the negatives are the best rows of other labels whose score lies between
``low`` and ``high`` percent of the positive's.

Scale: the anchors are a stated query set. Candidates are dealt into slices and
anchors into groups by hash, at most about SLICE rows and GROUP anchors each;
every slice meets every group in one task of a cogroup, and only the best few
of a cell go on. A hot label, or one vector on a third of all rows, is spread
over all slices like any other. Rows carry a number of their own, given once
and staged; positives are staged between the two passes.

Defined results: rows with a null label or vector, or with a null or
non-finite component, take no part; a shorter vector counts as padded with
zeros; a null id makes no anchor, and comes last on ties; rows that share an id
stay apart; without other rows of its label an anchor has no positives, and
gives no rows; scores beyond 64 bits are cut to the largest; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfaudit.session import stage

#: Candidates of a slice and anchors of a group, about; and candidates in one wide integer.
SLICE, GROUP, PACK = 65_536, 8_192, 2_048
_LARGEST = (1 << 63) - 1


def whole_rows(vectors: DataFrame, scale: int = 256, relabel_every: int | None = 7, labels: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Staged (row, id, label, v array<double>): the rows that take part, with whole-number components."""
    label = F.col(label_col).cast("long")
    if relabel_every:
        label = F.when(F.col(id_col) % relabel_every == 0, (label + 1) % labels).otherwise(label)
    found = vectors.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), F.col(vector_col).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    found = found.filter(F.col("label").isNotNull() & F.col("x").isNotNull()).filter(finite)
    # a whole number beyond 2^53 is still one as a double; floor() would make it a long
    whole = F.transform("x", lambda x: F.when(F.abs(x) < 2.0**40, F.floor(x * scale).cast("double")).otherwise(x * scale))
    return stage(found.select(F.monotonically_increasing_id().alias("row"), "id", "label", whole.alias("v")), "negatives-rows")


class Packed:
    """Candidates' components (n, d) as d wide integers with one field a candidate."""

    def __init__(self, rows: np.ndarray, largest: int):
        """``largest``: the largest size of an anchor's component."""
        self.n, self.d = rows.shape
        self.bias, self.other_bias = int(np.abs(rows).max(initial=0)), largest
        bits = (self.d * 2 * self.bias * 2 * self.other_bias).bit_length()
        self.width = 4 if bits <= 32 else 8 * max(1, -(-bits // 64))  # bytes of a field
        self.sums = [int(x) for x in rows.sum(1)] if rows.dtype == object else rows.sum(1)
        self.wide = [int.from_bytes(self._fields(rows[:, k] + self.bias), "little") for k in range(self.d)]

    def _fields(self, column: np.ndarray) -> bytes:
        if self.width <= 8:
            return column.astype(f"<u{self.width}").tobytes()
        return b"".join(int(c).to_bytes(self.width, "little") for c in column)

    def scores(self, anchor: list[int]) -> np.ndarray:
        """Exact inner products of all candidates with an anchor's whole-number components."""
        total = 0
        for a, wide in zip(anchor, self.wide):
            total += (a + self.other_bias) * wide  # once an anchor component
        raw = total.to_bytes(self.n * self.width, "little")
        added = self.bias * sum(anchor) + self.d * self.bias * self.other_bias
        if self.width <= 8 and isinstance(self.sums, np.ndarray):
            fields = np.frombuffer(raw, f"<u{self.width}")
            # the true score fits in 64 bits, so wrapping around on the way does no harm
            off = np.uint64(added % (1 << 64)) + self.sums.astype(np.uint64) * np.uint64(self.other_bias)
            return (fields.astype(np.uint64) - off).view(np.int64)
        found = (int.from_bytes(raw[k * self.width:(k + 1) * self.width], "little") for k in range(self.n))
        whole = [x - added - self.other_bias * int(s) for x, s in zip(found, self.sums)]
        return np.array([max(-_LARGEST, min(_LARGEST, x)) for x in whole], np.int64)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors padded with zeros to ``width``: int64, or Python numbers where that is too small."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    values = pc.list_flatten(lists).to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = values
    if np.abs(out).max(initial=0) < 2**24:
        return out.astype(np.int64)
    return np.array([[int(x) for x in r] for r in out], object).reshape(out.shape)


def _width(*columns: pa.ChunkedArray) -> int:
    return max((pc.max(pc.list_value_length(c)).as_py() or 0 for c in columns), default=0)


class Cell:
    """One slice of candidates and one group of anchors."""

    def __init__(self, anchors: pa.Table, rows: pa.Table):
        width = _width(anchors["v"], rows["v"])
        self.anchors, self.candidates = _matrix(anchors["v"], width), _matrix(rows["v"], width)
        self.largest = int(np.abs(self.anchors).max(initial=0))
        self.a_row, self.a_label = anchors["row"].to_numpy(), anchors["label"].to_numpy()
        self.row, self.label = rows["row"].to_numpy(), rows["label"].to_numpy()
        self.id = rows["id"].fill_null(0).to_numpy()
        self.no_id = pc.is_null(rows["id"]).to_numpy()

    def met(self, anchors: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor's place, places of candidates, their scores) for each of ``anchors`` and each pack of ``rows``."""
        for k in range(0, len(rows) if len(anchors) else 0, PACK):
            own = rows[k:k + PACK]
            pack = Packed(self.candidates[own], self.largest)
            for a in anchors.tolist():
                yield a, own, pack.scores([int(x) for x in self.anchors[a]])

    def best(self, rows: np.ndarray, scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The first n by falling score, then id (null last), then row."""
        if len(scores) > 4 * n:
            on = scores >= np.partition(scores, len(scores) - n)[len(scores) - n]
            rows, scores = rows[on], scores[on]
        order = np.lexsort((self.row[rows], self.id[rows], self.no_id[rows], -scores))[:n]
        return rows[order], scores[order]

    def ids(self, rows: np.ndarray) -> pa.Array:
        return pa.array(self.id[rows], pa.int64(), mask=self.no_id[rows])


def _cells(anchors: DataFrame, rows: DataFrame, function, schema: str) -> DataFrame:
    """``function(group of anchors, slice of rows)`` for every group and slice."""
    spark = rows.sparkSession
    # a slice and a group are bounded; there are enough slices to keep all tasks at work
    slices = max(-(-rows.count() // SLICE), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    groups = max(1, -(-anchors.count() // GROUP))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    at = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    left = anchors.withColumn("group", at(groups)).withColumn("slice", every(slices))
    right = rows.withColumn("slice", at(slices)).withColumn("group", every(groups))
    return left.groupBy("slice", "group").cogroup(right.groupBy("slice", "group")).applyInArrow(function, schema)


def _table(found: list[tuple], types: str) -> pa.Table:
    names = [x.split()[0] for x in types.split(", ")]
    if not found:
        return pa.table({n: pa.array([], pa.int64()) for n in names})
    return pa.table({n: pa.concat_arrays([pa.array(f[k], pa.int64()) for f in found]) for k, n in enumerate(names)})


_POSITIVES = "a_row long, p_row long, p_id long, p_score long"
_NEGATIVES = "a_row long, p_row long, n_row long, n_id long, n_score long"


def positives(anchors: DataFrame, rows: DataFrame, n: int) -> DataFrame:
    """(a_row, p_row, p_id, p_score): the n best other rows of each anchor's label."""

    def of_cell(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            cell = Cell(left, right)
            for label in np.unique(cell.label):
                for a, own, scores in cell.met(np.flatnonzero(cell.a_label == label), np.flatnonzero(cell.label == label)):
                    other = cell.row[own] != cell.a_row[a]
                    at, s = cell.best(own[other], scores[other], n)
                    found.append((np.full(len(at), cell.a_row[a]), cell.row[at], cell.ids(at), s))
        return _table(found, _POSITIVES)

    first = Window.partitionBy("a_row").orderBy(F.desc("p_score"), F.asc_nulls_last("p_id"), "p_row")
    found = _cells(anchors, rows, of_cell, _POSITIVES)
    return found.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= n).drop("k")


def negatives(anchors: DataFrame, rows: DataFrame, n: int, low: int, high: int) -> DataFrame:
    """(a_row, p_row, n_row, n_id, n_score, rank) for anchors with ``positives`` array<struct<p_row, p_score>>."""

    def of_cell(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            cell, wanted = Cell(left, right), left["positives"].to_pylist()
            for a, own, scores in cell.met(np.arange(left.num_rows), np.arange(right.num_rows)):
                other = cell.label[own] != cell.a_label[a]
                own, scores = own[other], scores[other]
                for p in wanted[a]:
                    least, most = -(-low * p["p_score"] // 100), high * p["p_score"] // 100  # whole scores within the percentages
                    on = (scores >= least) & (scores <= most)
                    at, s = cell.best(own[on], scores[on], n)
                    if len(at):
                        found.append((np.full(len(at), cell.a_row[a]), np.full(len(at), p["p_row"]), cell.row[at], cell.ids(at), s))
        return _table(found, _NEGATIVES)

    first = Window.partitionBy("a_row", "p_row").orderBy(F.desc("n_score"), F.asc_nulls_last("n_id"), "n_row")
    found = _cells(anchors, rows, of_cell, _NEGATIVES)
    return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= n)


def hard_negatives(
    vectors: DataFrame, anchor_every: int = 100, n_positives: int = 5, n_negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256,
    relabel_every: int | None = 7, labels: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor and positive.

    Anchors are the rows whose id ``anchor_every`` divides; ``low`` and ``high`` are percent of the positive's score.
    """
    rows = whole_rows(vectors, scale, relabel_every, labels, id_col, vector_col, label_col)
    anchors = rows.filter(F.col("id") % anchor_every == 0)
    near = stage(positives(anchors, rows, n_positives), "negatives-positives")
    wanted = near.groupBy(F.col("a_row").alias("row")).agg(F.collect_list(F.struct("p_row", "p_score")).alias("positives"))  # n_positives at most
    found = negatives(stage(anchors.join(wanted, "row"), "negatives-anchors"), rows, n_negatives, low, high)
    named = anchors.select(F.col("row").alias("a_row"), F.col("id").alias("anchor_id")).join(near, "a_row")
    return named.join(found, ["a_row", "p_row"]).select(
        "anchor_id", F.col("p_id").alias("positive_id"), F.col("rank").cast("int"), F.col("n_id").alias("negative_id"),
        F.col("p_score").alias("positive_score"), F.col("n_score").alias("negative_score"),
    )
