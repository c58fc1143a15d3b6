"""Cross-tokenizer alignment, as Arrow arrays from end to end.

Method: each text is encoded by a byte-level BPE (A, over a space and the text)
and by a piece model (B, which adds the space itself). The id lists of a slice of
documents are flattened with their parent indices, token sizes are looked up,
and a cumulative sum, segmented by document, gives each token's end byte.
A hash join of both sides on (document, end) finds the places where tokens
end: those of both sides cut the text into groups; and the stretch between two
neighbouring ends of either side is one link, the only overlap of one A and one B
token. ``Table.group_by`` counts the id pairs of the links in each task, and Spark
merges the partial counts over the whole corpus.

Scale: texts are read and encoded once; documents with their links (two short ints a
link) and partial counts are staged together, so the second pass, which looks
the merged counts up, reads no text. The merged counts are sent to the tasks as
sorted arrays where a count of them shows at most ``PAIRS`` pairs; beyond, links
are counted by document and joined with them by a shuffle. A task holds a
slice of documents, and at most HELD distinct pairs before it passes their
counts on.

Defined results: special tokens in a text are plain text; a null or empty text,
and one whose tokens' bytes aren't a space and the text (on either side), has no
tokens; repeated rows and null ids are documents of their own; broken UTF-8
counts as replacement characters; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfaudit.llm.bpe_tree import Remembered, Words, token_bytes
from shelfaudit.llm.common import binary, sized_slices, slices
from shelfaudit.session import stage

#: Pairs of ids whose counts are sent to all tasks (17 bytes each); more are joined by a shuffle.
PAIRS = 4_000_000
#: Distinct pairs a task holds before it passes their counts on, and pairs in one row of them.
HELD, PART = 200_000, 50_000
#: Bytes of text in a slice, about.
SLICE_BYTES = 1 << 20

#: How an id of a link is written.
ID = np.dtype("<u2")
#: The end byte's part of a key of (document, end); Spark's strings are shorter.
END = 1 << 32

#: A piece model's sign for a space, and its words: spaces and what follows them.
SPACE, BETWEEN_SPACES = "▁", re.compile(r" *[^ ]+(?: +\Z)?| +\Z")

_LIST = pa.list_(pa.int32())


class PieceWords(Remembered):
    """Of a piece model, if none of its pieces goes on over a space: a text's tokens are then those of what stands between
    spaces, each with the spaces before it. A text that the model rewrites, or that holds its sign for a space, is encoded whole."""

    def __init__(self, model):
        super().__init__()
        self.model = model
        pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
        self.apart = not any(SPACE in p.lstrip(SPACE) for p in pieces)

    def by_word(self, text: str) -> bool:
        return self.apart and SPACE not in text and self.model.normalize(text) == (SPACE + text.replace(" ", SPACE) if text else "")

    def words(self, text: str) -> list[str]:
        return BETWEEN_SPACES.findall(" " + text) if text else []

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, "<u4").tobytes() for ids in self.model.encode(texts, num_threads=1)]

    def of_words(self, words: list[str]) -> list[bytes]:
        return self.whole([w[1:] for w in words])  # the model adds a space


def _lists(packed: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(p) // 4 for p in packed)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), "<i4")))


class Tokenizers:
    """Both sides. ``byte_bpe``: the text of a byte-level BPE's JSON file; ``pieces``: the bytes of a piece model's file."""

    def __init__(self, byte_bpe: str, pieces: bytes):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallel part
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_bpe)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        special = {t["content"]: t["id"] for t in json.loads(byte_bpe)["added_tokens"]}
        self.a_words = Words(self.a, special, Tokenizer.from_str(byte_bpe))
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.b_words = PieceWords(self.b)
        a_bytes, b_bytes = token_bytes(byte_bpe), [self._piece(i) for i in range(self.b.get_piece_size())]
        self.bytes = [pa.array(x, pa.large_binary()) for x in (a_bytes, b_bytes)]
        self.sizes = [pc.binary_length(x) for x in self.bytes]
        if max(map(len, self.bytes)) > np.iinfo(ID).max + 1:
            raise ValueError(f"ids of links are written as {ID.name}; the vocabularies have more")
        # how a group writes an id: followed by a comma, or as the last of its side
        written = [f"{i}{mark}" for n, last in ((len(a_bytes), "|"), (len(b_bytes), ";")) for i in range(n) for mark in (",", last)]
        self.written = pa.array(written, pa.large_string())

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[bytes | None]) -> list[pa.ListArray]:
        """Id lists of A and B; empty on both sides where there is nothing to align."""
        whole = [(t or b"").decode("utf-8", "replace") for t in texts]
        found = [_lists(self.a_words.encode([" " + t if t else "" for t in whole])), _lists(self.b_words.encode(whole))]
        spaced = [b" " + t.encode() if t else b"" for t in whole]
        wrong = {n for side, table in zip(found, self.bytes) for n in _unlike(side, table, spaced)}
        if wrong:
            right = pa.array([n not in wrong for n in range(len(whole))])
            found = [pc.if_else(right, side, pa.scalar([], _LIST)) for side in found]
        return found


def _unlike(ids: pa.ListArray, table: pa.Array, texts: list[bytes]) -> list[int]:
    """Documents whose tokens' bytes aren't their text."""
    joined = pc.take(table, ids.flatten())
    at = np.frombuffer(joined.buffers()[1], np.int64)[:len(joined) + 1][ids.offsets.to_numpy()]
    held = memoryview(joined.buffers()[2] or b"").cast("B")  # Arrow's own are signed
    return [n for n, (s, e, t) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), texts)) if held[s:e] != t]


def _ends(ids: pa.ListArray, sizes: pa.Array, name: str) -> pa.Table:
    """(end, place) of every token: the document's number and the byte its token ends at, as one key; the token's number."""
    doc, flat = pc.list_parent_indices(ids), ids.flatten()
    running = pc.cumulative_sum(pc.cast(pc.take(sizes, flat), pa.int64()))
    upto = pa.concat_arrays([pa.array([0], pa.int64()), running.combine_chunks() if isinstance(running, pa.ChunkedArray) else running])
    before = pc.take(upto, ids.offsets[:-1])  # of each document
    end = pc.add(pc.multiply(pc.cast(doc, pa.int64()), pa.scalar(END)), pc.subtract(running, pc.take(before, doc)))
    return pa.table({"end": end, name: pa.array(np.arange(len(flat), dtype=np.int32))})


def _before(flags: pa.ChunkedArray) -> pa.ChunkedArray:
    """How many flags are set before each place."""
    own = pc.cast(flags, pa.int64())
    return pc.subtract(pc.cumulative_sum(own), own)


class Aligned:
    """The alignment of a slice of documents."""

    def __init__(self, tokenizers: Tokenizers, texts: list[bytes | None]):
        self.docs = len(texts)
        self.a, self.b = tokenizers.encode(texts)
        sides = [_ends(x, sizes, name) for x, sizes, name in zip((self.a, self.b), tokenizers.sizes, ("a", "b"))]
        met = sides[0].join(sides[1], keys="end", join_type="full outer", use_threads=False).sort_by("end")
        self.is_a, self.is_b = pc.is_valid(met["a"]), pc.is_valid(met["b"])
        self.both = pc.and_(self.is_a, self.is_b)
        # the stretch that ends in a row lies in the token that hasn't ended before it
        self.link_a, self.link_b = (_one(pc.take(ids.flatten(), _before(on))) for ids, on in ((self.a, self.is_a), (self.b, self.is_b)))
        self.starts = np.searchsorted(met["end"].to_numpy(), np.arange(self.docs + 1) * END)
        self.hashes = self._hashes(tokenizers)

    def links(self) -> list[pa.Array]:
        """Each document's A ids and B ids of its links, packed."""
        ends = (self.starts * ID.itemsize).astype(np.int32)
        packed = [pa.py_buffer(x.to_numpy().astype(ID).tobytes()) for x in (self.link_a, self.link_b)]
        return [pa.Array.from_buffers(pa.binary(), self.docs, [None, pa.py_buffer(ends.tobytes()), x]) for x in packed]

    def n_links(self) -> pa.Array:
        return pa.array(np.diff(self.starts), pa.int64())

    def groups(self) -> pa.Array:
        """Groups of each document."""
        upto = np.concatenate(([0], np.cumsum(_one(self.both).to_numpy(zero_copy_only=False))))
        return pa.array(upto[self.starts[1:]] - upto[self.starts[:-1]], pa.int64())

    def pairs(self) -> pa.Table:
        """(a, b, n): links of each pair of ids."""
        found = pa.table({"a": self.link_a, "b": self.link_b}).group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")])
        return found.rename_columns(["a", "b", "n"])

    def _hashes(self, tokenizers: Tokenizers) -> list[str]:
        """SHA-256 of each document's groups as ``a1,a2|b1;a3|b2,b3``; '' without tokens."""
        group = _before(self.both)
        ends = [_one(pc.filter(self.both, on)) for on in (self.is_a, self.is_b)]  # a token ends its side of a group
        own = [_one(pc.filter(group, on)) for on in (self.is_a, self.is_b)]
        a_upto, b_upto = (_one(pc.filter(pc.add(_before(on), pc.cast(on, pa.int64())), self.both)) for on in (self.is_a, self.is_b))
        b_before = pa.concat_arrays([pa.array([0], pa.int64()), b_upto])
        # A tokens stand behind the B tokens of earlier groups, B tokens behind the A tokens of their own and earlier ones
        n_a, n_b = len(own[0]), len(own[1])
        places = [pc.add(pa.array(np.arange(n_a)), pc.take(b_before, own[0])), pc.add(pa.array(np.arange(n_b)), pc.take(a_upto, own[1]))]
        first = [0, 2 * len(tokenizers.sizes[0])]
        order = np.empty(n_a + n_b, np.int64)
        for side, at, last, base in zip((self.a, self.b), places, ends, first):
            order[at.to_numpy()] = base + 2 * side.flatten().to_numpy().astype(np.int64) + last.to_numpy(zero_copy_only=False)
        text = pc.take(tokenizers.written, pa.array(order))
        at = np.frombuffer(text.buffers()[1], np.int64)[:len(text) + 1][self.a.offsets.to_numpy() + self.b.offsets.to_numpy()]
        held = memoryview(text.buffers()[2] or b"").cast("B")
        return [hashlib.sha256(held[s:e - 1]).hexdigest() if e > s else "" for s, e in zip(at[:-1].tolist(), at[1:].tolist())]


def _one(column) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return column


_ALIGNED = pa.schema([
    ("row", pa.int64()), ("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
    ("link_a", pa.binary()), ("link_b", pa.binary()), ("part_a", _LIST), ("part_b", _LIST), ("part_n", pa.list_(pa.int64())),
])
_ALIGNED_SQL = (
    "row long, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "link_a binary, link_b binary, part_a array<int>, part_b array<int>, part_n array<long>"
)


def _part_rows(pairs: pa.Table) -> Iterator[pa.RecordBatch]:
    """Partial counts as rows without a document: PART pairs a row."""
    for k in range(0, pairs.num_rows, PART):
        part = pairs.slice(k, PART)
        ends = pa.array([0, part.num_rows], pa.int32())
        lists = {f"part_{c}": pa.ListArray.from_arrays(ends, _one(part[c])) for c in ("a", "b", "n")}
        yield pa.RecordBatch.from_arrays([lists.get(f.name, pa.nulls(1, f.type)) for f in _ALIGNED], schema=_ALIGNED)


def align(docs: DataFrame, byte_bpe: str, pieces: bytes, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents: row, id, n_a, n_b, n_groups, n_links, groups_sha256, link_a, link_b; pairs: a, b, n, best), both staged.

    ``row`` tells rows with one id apart; ``best``: no pair of the same b has a larger n.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers, held = None, []

        def merged() -> pa.Table:
            found = pa.concat_tables(held).group_by(["a", "b"], use_threads=False).aggregate([("n", "sum")])
            return found.rename_columns(["a", "b", "n"])

        for batch in sized_slices(batches, 2, SLICE_BYTES):
            tokenizers = tokenizers or Tokenizers(byte_bpe, pieces)
            found = Aligned(tokenizers, batch.column(2).to_pylist())
            counts = [pc.cast(pc.list_value_length(x), pa.int64()) for x in (found.a, found.b)]
            link_a, link_b = found.links()
            none = [pa.nulls(batch.num_rows, t) for t in (_LIST, _LIST, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), *counts, found.groups(), found.n_links(),
                pa.array(found.hashes, pa.string()), link_a, link_b, *none,
            ], schema=_ALIGNED)
            held.append(found.pairs())
            if sum(t.num_rows for t in held) > HELD:
                held = [merged()]
                if held[0].num_rows > HELD // 2:
                    yield from _part_rows(held.pop())
        if held:
            yield from _part_rows(merged())

    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), binary(F.col(text_col)).alias("t"))
    found = stage(texts.mapInArrow(run, _ALIGNED_SQL), "align-links")
    parts = found.filter(F.col("row").isNull()).select(F.explode(F.arrays_zip("part_a", "part_b", "part_n")).alias("p"))
    pairs = parts.groupBy(F.col("p.part_a").alias("a"), F.col("p.part_b").alias("b")).agg(F.sum("p.part_n").alias("n"))
    pairs = stage(pairs, "align-pairs")
    most = pairs.groupBy(F.col("b").alias("most_b")).agg(F.max("n").alias("most"))
    pairs = stage(pairs.join(most, F.col("b") == F.col("most_b")).select("a", "b", "n", (F.col("n") == F.col("most")).alias("best")), "align-counts")
    return found.filter(F.col("row").isNotNull()).drop("part_a", "part_b", "part_n"), pairs


_FIGURES = ("row", "id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _unpacked(batch: pa.RecordBatch) -> list[np.ndarray]:
    """A ids and B ids of all links of a batch."""
    return [np.frombuffer(b"".join(batch.column(c).to_pylist()), ID).astype(np.int64) for c in ("link_a", "link_b")]


def _looked_up(documents: DataFrame, pairs: DataFrame) -> DataFrame:
    """Figures of the documents with the counts of all pairs in every task."""
    known = pairs.select((F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")).alias("pair"), "n", "best").toArrow()  # PAIRS rows at most
    pair = known["pair"].to_numpy()
    order = np.argsort(pair)
    tables = documents.sparkSession.sparkContext.broadcast((pair[order], known["n"].to_numpy()[order], known["best"].to_numpy()[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = tables.value
        for batch in slices(batches):
            a, b = _unpacked(batch)
            at = np.searchsorted(pair, (a << 32) + b)
            ends = np.cumsum(batch.column("n_links").to_numpy())
            upto = [np.concatenate(([0], np.cumsum(x[at], dtype=np.int64))) for x in (best, n)]
            totals = [pa.array(np.diff(x[ends], prepend=0)) for x in upto]
            own = batch.columns
            yield pa.RecordBatch.from_arrays([*own[:6], *totals, own[6]], list(_FIGURES))

    figures = "row long, id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return documents.select("row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "link_a", "link_b").mapInArrow(run, figures)


def _joined(documents: DataFrame, pairs: DataFrame) -> DataFrame:
    """Figures of the documents by a shuffle of their links, counted by document first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            a, b = _unpacked(batch)
            found = pa.table({"row": np.repeat(batch.column("row").to_numpy(), batch.column("n_links").to_numpy()), "a": a.astype(np.int32), "b": b.astype(np.int32)})
            found = found.group_by(["row", "a", "b"], use_threads=False).aggregate([([], "count_all")])
            yield from found.rename_columns(["row", "a", "b", "times"]).to_batches()

    links = documents.select("row", "n_links", "link_a", "link_b").mapInArrow(count, "row long, a int, b int, times long")
    sums = links.join(pairs, ["a", "b"]).groupBy(F.col("row").alias("of")).agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return documents.join(sums, F.col("row") == F.col("of"), "left").select(*_FIGURES[:6], *zero, "groups_sha256")


def alignment(docs: DataFrame, byte_bpe: str, pieces: bytes, id_col: str = "doc_id", text_col: str = "text", most_pairs: int = PAIRS) -> DataFrame:
    """One row (row, id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row of ``docs``."""
    documents, pairs = align(docs, byte_bpe, pieces, id_col, text_col)
    few = pairs.limit(most_pairs + 1).count() <= most_pairs
    return _looked_up(documents, pairs) if few else _joined(documents, pairs)
