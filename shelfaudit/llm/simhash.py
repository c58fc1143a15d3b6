"""SimHash near-duplicate detection with pigeonhole blocks.

Method: each text gets a 64-bit fingerprint of its word shingles. The 64 bits
are cut into ``max_bits + 2`` pieces; two fingerprints that differ in at most
``max_bits`` bits agree in two pieces at least, so each pair of pieces is a
block key and close fingerprints meet in some block. Candidates are verified
by their Hamming distance. Components of the links are found by alternating
large-star and small-star rounds, all of it in Spark.

Scale: links are searched between different fingerprints only (copies
collapse before any join). A block of up to ``BLOCK_LIMIT`` fingerprints is
compared pair by pair, at most ``BLOCK_LIMIT / 2`` pairs for each of its
fingerprints. In a fuller block (a hot block may hold a third of all
fingerprints) no pairs are made: for distance 2 each fingerprint emits itself
and its one-bit neighbours within the bits that the block leaves free; two
fingerprints share such a value exactly if they differ in 2 bits or fewer, so
each value is a star of at most 65 members. This is exact and linear.

Defined results: a null or empty text has no words and fingerprint zero, and
links like any other; fewer words than a shingle make one shingle of the
whole sequence; repeated rows stay rows of their own; a null id never
represents a component unless all its ids are null; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfaudit.llm.common import binary, map_batches
from shelfaudit.session import stage

#: Blocks beyond this many fingerprints are linked by one-bit neighbours instead of pairs.
BLOCK_LIMIT = 64
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def shingle_hashes(text: bytes, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every ``words``-word shingle, repeats included, of a lower-cased text."""
    w = text.lower().split()
    if not w:
        return np.empty(0, np.uint64)
    if len(w) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(w), seed)], np.uint64)
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(w) - words + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, ends[words - 1:].tolist())), np.uint64, len(starts))


def simhash(text: bytes, words: int) -> int:
    """64-bit fingerprint: a bit is 1 if set in over half of the shingle hashes."""
    h = shingle_hashes(text, words)
    if not len(h):
        return 0
    lanes = h.view(np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(lanes[:, k], minlength=256) @ _BITS for k in range(8)])
    return int(np.packbits(2 * counts > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, fp long) per row of ``docs``."""

    def setup():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            fps = np.fromiter((simhash(t, words) for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

        return work

    return map_batches(docs.select(F.col(id_col).cast("long").alias("id"), binary(F.col(text_col)).alias("t")), "id long, fp long", setup)


def _pieces(n: int) -> list[int]:
    """Bit masks of ``n`` pieces of 64 bits, as signed longs' bit patterns."""
    cuts = [round(64 * k / n) for k in range(n + 1)]
    return [((1 << b) - (1 << a)) for a, b in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(nodes: DataFrame, max_bits: int = 2) -> DataFrame:
    """Edges (a < b) among the distinct ``fp`` of ``nodes`` that connect all pairs within ``max_bits`` bits.

    Every edge joins fingerprints that differ in ``max_bits`` bits at most, and fingerprints
    that close are always in one component of the edges.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2")  # fuller blocks rely on one-bit neighbours
    masks = [x | y for x, y in combinations(_pieces(max_bits + 2), 2)]
    fp = F.col("fp")
    blocks = nodes.select("fp", F.posexplode(F.array(*[fp.bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("t", "key"))
    blocks = stage(blocks, "simhash-blocks")
    sizes = blocks.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sized = blocks.join(sizes, ["t", "key"])
    near = (
        sized.filter(F.col("n") <= BLOCK_LIMIT)
        .groupBy("t", "key").agg(F.sort_array(F.collect_list("fp")).alias("m"))
        .select("m", F.posexplode("m").alias("i", "a"))
        .select("a", F.explode(F.expr("filter(slice(m, i + 2, size(m)), b -> bit_count(a ^ b) <= %d)" % max_bits)).alias("b"))
    )
    free = F.array(*[F.array(*[F.lit(_signed(1 << k)) for k in range(64) if not m >> k & 1] or [F.lit(0)]) for m in masks])
    around = (
        sized.filter(F.col("n") > BLOCK_LIMIT)
        .select("fp", F.explode(F.concat(F.array(fp), F.transform(F.get(free, F.col("t")), lambda b: fp.bitwiseXOR(b)))).alias("mid"))
        .distinct()
    )
    if max_bits == 2:
        # who shares mid differs from it in one bit at most, hence from each other in two
        stars = (
            around.groupBy("mid").agg(F.collect_list("fp").alias("m")).filter(F.size("m") > 1)
            .select(F.array_min("m").alias("a"), F.explode("m").alias("b"))
        )
    else:  # a neighbour that is itself a fingerprint
        stars = around.join(nodes.select(F.col("fp").alias("mid")), "mid", "left_semi").select(F.least("fp", "mid").alias("a"), F.greatest("fp", "mid").alias("b"))
    stars = stars.filter((F.col("a") != F.col("b")) & (_distance(F.col("a"), F.col("b")) <= max_bits))
    return near.unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the component's smallest node.

    Alternating large-star and small-star rounds, each cut with a staged table;
    only the number of edges and a checksum come to the driver.
    """
    edges = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "simhash-edges")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = stage(small.filter("u != v").distinct(), "simhash-stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    # at the fixed point each node points at its root
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def simhash_near_dedup(docs: DataFrame, words: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, fp, component_id) per row of ``docs``; component_id is the smallest id that links reach."""
    fps = stage(fingerprints(docs, words, id_col, text_col), "simhash-fps")
    nodes = stage(fps.groupBy("fp").agg(F.min("id").alias("rep")), "simhash-nodes")
    roots = components(links(nodes.select("fp"), max_bits))
    labelled = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    ids = labelled.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = labelled.join(ids, "root").select(F.col("fp").alias("class_fp"), "component_id")
    return fps.join(classes, F.col("fp") == F.col("class_fp"), "left").select("id", "fp", "component_id")
