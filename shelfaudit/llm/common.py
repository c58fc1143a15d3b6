"""Helpers shared by the training-data operators.

Texts are always taken whole. ``binary()`` hands a text to Python as UTF-8
bytes (null counts as empty): ``bytes.lower()`` folds A-Z only and
``bytes.split()`` splits at exactly ``[\\x20\\x09-\\x0D]+``, which is how the
word contracts of these operators are stated.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word of the license and benchmark contracts: digits, letters (lower case) and everything beyond ASCII.
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What lies between such words.
ALNUM_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word of the contracts that split at ASCII white space.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
#: Id lists of up to this many rows (8 bytes each) are broadcast; longer ones are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_az(text: Column) -> Column:
    """Lower-case A-Z and nothing else; null becomes the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def binary(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32(doc_id as text) mod ``folds``; a null id falls in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


#: Rows of an Arrow batch that are Python objects at a time.
SLICE = 512


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of SLICE rows, so that a worker holds few texts as Python objects at once."""
    for batch in batches:
        for k in range(0, batch.num_rows, SLICE):
            yield batch.slice(k, SLICE)


#: Bytes of text that a slice by size holds, about: one text at least.
SLICE_BYTES = 4 << 20


def sized_slices(batches: Iterator[pa.RecordBatch], column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of up to SLICE rows whose binary ``column`` holds ``most`` bytes or little more, for work that takes many times a text's size."""
    for batch in slices(batches):
        at, held = 0, 0
        for k, n in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
            if held and held + n > most:
                yield batch.slice(at, k - at)
                at, held = k, 0
            held += n
        if at < batch.num_rows:
            yield batch.slice(at)


def map_batches(df: DataFrame, schema: str, setup: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> DataFrame:
    """``mapInArrow`` where ``setup()`` runs once a task and returns the function of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in slices(batches):
            work = work or setup()
            yield work(batch)

    return df.mapInArrow(run, schema)


def keep_ids(docs: DataFrame, id_col: str, ids: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose id is (``left_semi``) or isn't (``left_anti``) in the one-column ``ids``.

    Ids compare null-safe. A list within BROADCAST_IDS rows, which is counted
    first, is broadcast, so the texts don't move; a longer one is joined by a
    shuffle on the id.
    """
    ids = ids.select(F.col(ids.columns[0]).alias("__id")).distinct()
    small = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if small else ids, docs[id_col].eqNullSafe(F.col("__id")), how)
