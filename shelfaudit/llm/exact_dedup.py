"""Exact duplicates by an extendible-hash index on shared files.

Method: a text's 64-bit hash addresses a directory of 2^depth slots. A bucket
of more than ``capacity`` different texts is split by one more bit of the
hash; if its local depth is the directory's, the directory doubles. Owner tasks
each take the buckets of a key range, sort them by hash, chain texts of equal
hash and compare their bytes, and write the finished bucket pages to the
shared checkpoint folder. Totals of each chain link are then read from those
pages, which hold no text.

Scale: equal texts of a slice of 512 rows become one entry (bytes
compared) before anything moves; entries move once. A hash that holds more rows
than an owner's fair share is spread over as many owners as it holds shares.
Each of them chains it and writes one copy of each of its texts; those
copies, a few a hash, meet in a second round, where bytes are compared again and
the owners' chains become one. The owner streams: it holds one
chain (distinct texts of one 64-bit hash). Members ride along as id lists of
one slice at most. Buckets that no bit can split (one hash) stay over
capacity and are chained. The driver holds the directory only: bucket counts,
at most 2^MAX_DEPTH slots. Fewer than 1 / HOT_PART hashes can be spread; their list is broadcast.

Defined results: null text equals the empty text; of equal texts the row with
the largest id stays, null ids last; of fully repeated rows exactly one
stays; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
import xxhash

from shelfaudit.llm.common import binary, map_batches, slices
from shelfaudit.session import stage

#: Different texts that a bucket may hold before it splits.
CAPACITY = 16_384
#: Buckets of an owner task, at least, where there are texts enough.
BUCKETS = 4
#: The histogram is read at these depths; the second only under prefixes that are over capacity at the first.
LEVELS = (12, 20)
MAX_DEPTH = LEVELS[-1]
#: A hash is spread over owners if it holds more than HOT_ROWS rows and more than this part of all.
HOT_ROWS, HOT_PART = 2048, 1 / 65_536


def directory(hashes: DataFrame, capacity: int = CAPACITY, owners: int = 1) -> list[tuple[int, int]]:
    """Buckets (local depth, prefix) in key order for the distinct values of the column ``h``.

    A bucket over capacity splits in two by the next bit; the deepest bucket sets the
    directory's depth. At most 2^12 counts and those under overfull prefixes are read. The capacity is
    lowered until each of ``owners`` can have BUCKETS of them.
    """
    counts: dict[tuple[int, int], int] = {}
    full: list[int] | None = None
    for level in LEVELS:
        at = hashes.distinct().select(F.shiftrightunsigned("h", 64 - level).alias("slot"))
        if full is not None:
            at = at.filter(F.shiftright("slot", LEVELS[1] - LEVELS[0]).isin(full))
        for r in at.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).collect():
            for depth in range(0 if full is None else LEVELS[0] + 1, level + 1):
                key = (depth, r.slot >> (level - depth))
                counts[key] = counts.get(key, 0) + r.n
        capacity = max(1, min(capacity, counts.get((0, 0), 0) // (BUCKETS * owners)))
        full = [p for (d, p), n in counts.items() if d == LEVELS[0] and n > capacity]
        if not full:
            break
    buckets, todo = [], [(0, 0)]
    while todo:
        depth, prefix = todo.pop()
        if counts.get((depth, prefix), 0) > capacity and depth < MAX_DEPTH:
            todo += [(depth + 1, 2 * prefix + 1), (depth + 1, 2 * prefix)]
        else:
            buckets.append((depth, prefix))
    return buckets


def _entries(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Equal texts of a slice of a batch as one entry: h, its text, its ids (largest first, nulls last) and its number in the task."""

    def setup():
        seen = itertools.count()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found: dict[bytes, list] = {}
            for i, t in zip(ids, texts):
                found.setdefault(t, []).append(i)
            rows = [(xxhash.xxh64_intdigest(t, 42), t, sorted(m, key=lambda x: (x is None, -(x or 0)))) for t, m in found.items()]
            return pa.RecordBatch.from_arrays([
                pa.array(np.array([r[0] for r in rows], np.uint64).view(np.int64)),
                pa.array([r[1] for r in rows], pa.binary()),
                pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                pa.array([next(seen) for _ in rows], pa.int64()),
            ], ["h", "text", "ids", "nth"])

        return work

    return map_batches(docs.select(F.col(id_col).cast("long").alias("id"), binary(F.col(text_col)).alias("t")), "h long, text binary, ids array<long>, nth long", setup)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries (h, text, ids, share, shares) sorted by h: number the distinct texts of each hash by comparing bytes.

    The texts end here, but for the first of its kind where the hash has several owners.
    """
    last, chain = None, []
    for batch in slices(batches):
        link, digest, first = np.empty(batch.num_rows, np.int32), [], []
        for k, (h, text, shares) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(4).to_pylist())):
            if h != last:
                last, chain = h, []
            at = next((n for n, (t, _) in enumerate(chain) if t == text), -1)
            first.append(text if at < 0 and shares > 1 else None)
            if at < 0:
                at = len(chain)
                chain.append((text, hashlib.sha256(text).hexdigest()))
            link[k] = at
            digest.append(chain[at][1])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(link), pa.array(digest, pa.string()), batch.column(2), batch.column(3), pa.array(first, pa.binary())],
            ["h", "link", "text_sha256", "ids", "share", "first"])


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Owners' first texts (h, share, link, first) sorted by h: the place of each in the hash's whole chain, by comparing bytes."""
    last, chain = None, []
    for batch in slices(batches):
        place = np.empty(batch.num_rows, np.int32)
        for k, (h, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(3).to_pylist())):
            if h != last:
                last, chain = h, []
            if text not in chain:
                chain.append(text)
            place[k] = chain.index(text)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(place)], ["h", "share", "link", "place"])


def hot_hashes(counts: DataFrame, tasks: int) -> DataFrame:
    """(h, shares): hashes of ``counts`` (h, n) that hold more than an owner's fair share, and over how many owners they go."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    shares = F.least(F.ceil(F.col("n") * F.lit(tasks) / F.lit(max(total, 1))), F.lit(tasks)).cast("int")
    hot = counts.filter(F.col("n") > F.lit(max(HOT_ROWS, total * HOT_PART)))
    return hot.select("h", shares.alias("shares")).filter("shares > 1")


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The staged index pages: h, link (place in the chain), text_sha256, ids, page_row, share (the owner's, of a hash of
    several) and first (a text, once an owner, of such a hash); link and share together name an owner's text."""
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hashes = docs.select(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"))
    counts = stage(hashes.groupBy("h").agg(F.count(F.lit(1)).alias("n")), "exact-hashes")
    buckets = directory(counts.select("h"), capacity, tasks)
    depth = max(d for d, _ in buckets)
    rows = [(n, prefix << (depth - d), 1 << (depth - d)) for n, (d, prefix) in enumerate(buckets)]
    slots = spark.createDataFrame(rows, "bucket int, first long, width long")  # 2^MAX_DEPTH slots at most
    slots = slots.select("bucket", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("width") - 1)).alias("slot"))
    entries = _entries(docs, id_col, text_col)
    slot = F.shiftrightunsigned("h", 64 - depth) if depth else F.lit(0).cast("long")
    placed = entries.withColumn("slot", slot).join(F.broadcast(slots), "slot").join(F.broadcast(hot_hashes(counts, tasks)), "h", "left")
    shares = F.coalesce("shares", F.lit(1))
    placed = placed.withColumn("share", F.pmod(F.xxhash64("ids", "nth"), shares).cast("int"))
    # owner tasks: contiguous key ranges, several buckets each; the owner's number is the partition's
    owner = F.floor(F.col("bucket").cast("long") * F.lit(tasks) / F.lit(len(buckets))).cast("int")
    owned = placed.repartitionById(tasks, F.pmod(owner + F.col("share"), F.lit(tasks)).cast("int")).sortWithinPartitions("h")
    schema = "h long, link int, text_sha256 string, ids array<long>, share int, first binary"
    pages = owned.select("h", "text", "ids", "share", shares.alias("shares")).mapInArrow(_chain, schema)
    return stage(pages.withColumn("page_row", F.monotonically_increasing_id()), "exact-index")


def _whole_chains(pages: DataFrame) -> DataFrame:
    """``pages`` with one ``link`` a text, also where several owners hold its hash."""
    several = pages.filter(F.col("first").isNotNull()).select("h", "share", "link", "first")
    met = several.repartition("h").sortWithinPartitions("h").mapInArrow(_settle, "h long, share int, link int, place int")
    met = stage(met, "exact-places")
    out = pages.drop("first").join(met, ["h", "share", "link"], "left")
    return out.withColumn("link", F.coalesce("place", "link")).drop("place", "share")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row (id, keep_id, group_size, kept, text_sha256) per row of ``docs``."""
    pages = _whole_chains(index(docs, id_col, text_col, capacity))
    best = F.struct(F.get("ids", F.lit(0)).alias("id"), (-F.col("page_row")).alias("at"))
    totals = pages.groupBy("h", "link").agg(F.sum(F.size("ids")).cast("long").alias("group_size"), F.max(best).alias("best"))
    members = pages.join(totals, ["h", "link"])
    rows = members.select("page_row", "best", "group_size", "text_sha256", F.posexplode("ids").alias("nth", "id"))
    kept = (F.col("page_row") == -F.col("best.at")) & (F.col("nth") == 0)
    return rows.select("id", F.col("best.id").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256")
