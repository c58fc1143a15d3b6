"""BPE encoding and decoding by tree concatenation.

Method: a text longer than a leaf is halved until the pieces are leaves; these
are encoded in parallel, as rows of their own. Neighbours are then joined, in
rounds, until each text is one sequence again. A join keeps what both sides
have far from it and encodes a window around it anew, which grows until it
agrees with both sides exactly:

- Words of the pre-tokenizer: a word depends on what follows it by two
  characters at most, so all of the left side's words that end MARGIN bytes
  before the join stay. From there words are cut again until one starts where a
  word of the right side does, and all that follows is the right side's.
- A long word without any place to split it, cut by the join: its tokens are
  joined by a window of tokens, encoded anew. BPE gives a sequence exactly if it
  gives every two neighbours of it, so the window agrees if its first token is
  the left side's token there and its last the right side's.

Special tokens in a text are cut out first, like the tokenizer does, and no
leaf ends inside one. Decoding puts the bytes of the tokens together.

Scale: texts up to a leaf are encoded in one pass that moves nothing. Longer
ones are read in a second pass over the table and travel once as leaves, so
that a very long one is the work of many tasks, and then as tokens once a
round of FAN neighbours; in the end a text's tokens are one row. Encoded leaves are
staged, and only the tree's height comes to the driver.

Defined results: a null or empty text has no tokens; broken UTF-8 counts as
replacement characters; repeated rows are encoded alike and a null id is kept;
ids of tokens are little-endian unsigned 32-bit integers in one binary value;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfaudit.llm.common import binary, sized_slices
from shelfaudit.session import stage

#: Bytes of a leaf at most, and neighbours joined in a round (a power of two).
LEAF, FAN = 1 << 16, 8
#: A word that ends so many bytes before the end of a text doesn't depend on what follows: two characters of four bytes.
MARGIN = 8
#: Bytes of the right side, and tokens of a word on each side, that a window starts with.
FIRST_BYTES, FIRST_TOKENS = 64, 8
#: A word of more bytes is joined by its tokens.
LONG_WORD = 256
#: Bytes of short texts that are cut into words at once, about.
SLICE_BYTES = 1 << 20
#: Words that a task remembers the tokens of, as many again of those met before, and their longest in characters.
WORDS, REMEMBERED = 1 << 17, 64
# fixed value: how byte-level pre-tokenizers cut a text into words
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_alphabet() -> dict[str, int]:
    """The characters that byte-level BPE writes bytes with: printable Latin-1 ones stand for themselves, the others follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def token_bytes(vocabulary: str) -> list[bytes]:
    """Bytes of every token of a byte-level BPE file, by id; a special token's are its text in UTF-8."""
    file, alphabet = json.loads(vocabulary), byte_alphabet()
    words = {i: bytes(alphabet[c] for c in w) for w, i in file["model"]["vocab"].items()}
    words |= {t["id"]: t["content"].encode() for t in file["added_tokens"]}
    return [words.get(i, b"") for i in range(max(words, default=-1) + 1)]


def _pack(ids: np.ndarray) -> bytes:
    return ids.astype("<u4").tobytes()


@dataclass
class Tokens:
    """An encoded text: ids, and which of them start a word of the pre-tokenizer."""

    ids: np.ndarray
    starts: np.ndarray


class Remembered:
    """The tokens of texts word by word, each word encoded once as long as it is remembered."""

    def __init__(self):
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}  # words that go unless they are met again

    def by_word(self, text: str) -> bool:
        """Whether the tokens of a text are those of its words."""
        raise NotImplementedError

    def words(self, text: str) -> list[str]:
        raise NotImplementedError

    def whole(self, texts: list[str]) -> list[bytes]:
        """Packed ids of whole texts."""
        raise NotImplementedError

    def of_words(self, words: list[str]) -> list[bytes]:
        """Packed ids of single words."""
        raise NotImplementedError

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of texts."""
        other = [n for n, t in enumerate(texts) if not self.by_word(t)]
        left = set(other)
        found = [[] if n in left else self.words(t) for n, t in enumerate(texts)]
        if len(self.known) > WORDS:
            self.known, self.before = {}, self.known
        new = set().union(*found).difference(self.known)
        again = new & self.before.keys()
        self.known.update((w, self.before.pop(w)) for w in again)
        new = list(new - again)
        self.known.update(zip(new, self.of_words(new)))
        out = [b"".join(map(self.known.__getitem__, words)) for words in found]
        for n, ids in zip(other, self.whole([texts[n] for n in other])):
            out[n] = ids
        for w in new:
            if len(w) > REMEMBERED:
                del self.known[w]
        return out


class Words(Remembered):
    """Of a byte-level BPE, for texts without special tokens.

    Libraries differ on characters that newer Unicode versions have assigned, so
    a text that holds one is left to the tokenizer.
    """

    def __init__(self, tokenizer, special: dict[str, int], knows_special=None):
        """``special``: ids of special tokens, which the tokenizer ``knows_special`` (or else ``tokenizer``) knows in a text."""
        super().__init__()
        self.tokenizer, self.knows_special, self.unassigned = tokenizer, knows_special or tokenizer, {}
        self.between = next(((t, i) for t, i in special.items() if len(WORD.findall(t)) > 1), None)  # then no word holds it
        self.words = WORD.findall

    def by_word(self, text: str) -> bool:
        if text.isascii():
            return True
        own = self.unassigned
        for c in set(text):
            if c not in own:
                own[c] = unicodedata.category(c) == "Cn"
            if own[c]:
                return False
        return True

    def whole(self, texts: list[str]) -> list[bytes]:
        return [_pack(np.array(e.ids)) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def of_words(self, words: list[str]) -> list[bytes]:
        if self.between is None or not words:
            return self.whole(words)
        # a special token between them: one text costs less than many
        text, mark = self.between
        ids = np.array(self.knows_special.encode_batch_fast([text.join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.append(np.flatnonzero(ids == mark), len(ids)) * 4
        raw, begins = ids.tobytes(), np.append(0, ends[:-1] + 4)
        return [raw[a:b] for a, b in zip(begins.tolist(), ends.tolist())]


class Bpe:
    """A byte-level BPE tokenizer with what joining needs. ``vocabulary``: the text of its JSON file."""

    def __init__(self, vocabulary: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        file = json.loads(vocabulary)
        cutter = file["pre_tokenizer"]
        if any(t[k] for t in file["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")) or file["normalizer"] or (cutter["type"], cutter["add_prefix_space"], cutter["use_regex"]) != ("ByteLevel", False, True):
            raise ValueError("only plain byte-level tokenizers can be joined")
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.remembered = Words(self.tokenizer, self.special)
        self.special_ids = np.array(sorted(self.special.values()), np.int64)
        names = sorted(map(re.escape, self.special), key=lambda x: (-len(x), x))
        self.cut = re.compile("(" + "|".join(names) + ")") if names else None
        self.bytes = token_bytes(vocabulary)
        self.size = np.fromiter(map(len, self.bytes), np.int64, len(self.bytes))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids; special tokens are cut out first."""
        parts = [self.cut.split(t) if self.cut else [t] for t in texts]
        plain = iter(self.remembered.encode([p for own in parts for p in own[::2]]))
        return [b"".join(_pack(np.array([self.special[p]])) if k % 2 else next(plain) for k, p in enumerate(own)) for own in parts]

    def leaf(self, text: str) -> Tokens:
        found = self.tokenizer.encode(text, add_special_tokens=False)
        ids, words = np.array(found.ids, np.int64), np.array(found.word_ids, float)  # none: not a number, unequal to all
        starts = np.ones(len(ids), bool)
        special = np.isin(ids, self.special_ids)
        starts[1:] = (words[1:] != words[:-1]) | special[1:] | special[:-1]
        return Tokens(ids, starts)

    def text(self, ids: np.ndarray) -> bytes:
        return b"".join([self.bytes[i] for i in ids.tolist()])

    def leaves(self, text: str, size: int) -> list[str]:
        """2^n pieces of the text, none inside a special token, each of about ``size`` bytes or less."""
        n = 1
        while len(text.encode()) > n * size:
            n *= 2
        cuts = [len(text) * k // n for k in range(n + 1)]
        spans = [m.span() for m in self.cut.finditer(text)] if self.cut else []
        at = 0
        for k in range(1, n):
            while at < len(spans) and spans[at][1] <= cuts[k]:
                at += 1
            if at < len(spans) and spans[at][0] < cuts[k]:
                cuts[k] = spans[at][0]
        return [text[a:b] for a, b in zip(cuts, cuts[1:])]

    def words(self, text: str) -> list[tuple[str, int, int | None]]:
        """(word in the byte alphabet, its bytes, None) or (text, bytes, id) of a special token, in order."""
        out: list[tuple[str, int, int | None]] = []
        for k, part in enumerate(self.cut.split(text) if self.cut else [text]):
            if k % 2:
                out.append((part, len(part.encode()), self.special[part]))
            elif part:
                out += [(w, len(w), None) for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part)]
        return out

    def word_ids(self, word: str) -> np.ndarray:
        return np.fromiter((t.id for t in self.tokenizer.model.tokenize(word)), np.int64)

    def join_word(self, word: str, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ids of a word that begins with the tokens ``left`` of an encoding and ends with ``right`` of one."""
        l_ends, r_ends = np.cumsum(self.size[left]), np.cumsum(self.size[right])
        r_from = len(word) - (r_ends[-1] if len(right) else 0)
        n = FIRST_TOKENS
        while True:
            a, b = max(0, len(left) - n), min(len(right), n)
            start = int(l_ends[a - 1]) if a else 0
            end = int(r_from + r_ends[b - 1]) if b else int(r_from)
            if b == len(right):
                end = len(word)
            window = self.word_ids(word[start:end])
            if (start == 0 or window[0] == left[a]) and (end == len(word) or window[-1] == right[b - 1]):
                return np.concatenate([left[:a], window, right[b:]])
            n *= 2

    def join(self, left: Tokens, right: Tokens) -> Tokens:
        """The tokens of the two texts in one."""
        if not len(left.ids) or not len(right.ids):
            return right if len(right.ids) else left
        l_ends, r_ends = np.cumsum(self.size[left.ids]), np.cumsum(self.size[right.ids])
        size, r_size = int(l_ends[-1]), int(r_ends[-1])
        # the left side stays up to its last word that starts MARGIN bytes before its end
        l_starts = np.flatnonzero(left.starts)
        safe = np.flatnonzero((l_ends - self.size[left.ids])[l_starts] <= size - MARGIN)
        first = int(l_starts[safe[-1]]) if len(safe) else 0
        head = self.text(left.ids[first:])
        x = size - len(head)
        r_starts = {int(e): int(k) for k, e in zip(np.flatnonzero(right.starts), (r_ends - self.size[right.ids])[right.starts])}
        reach, n = FIRST_BYTES, 0
        while True:
            # the window ends with a token and a character of the right side
            n = max(n + 1, int(np.searchsorted(r_ends, reach)) + 1)
            tail = self.text(right.ids[:n])
            while n < len(right.ids) and self.bytes[right.ids[n]][0] & 0xC0 == 0x80:
                tail += self.bytes[right.ids[n]]
                n += 1
            n = min(n, len(right.ids))
            whole = len(tail) == r_size
            found, at = [], 0
            for word in self.words((head + tail).decode()):
                z = at - len(head)
                if z in r_starts and (whole or z <= len(tail) - MARGIN):
                    return self._joined(left, right, first, x, found, r_starts[z])
                found.append((at, *word))
                at += word[1]
            if whole:
                return self._joined(left, right, first, x, found, len(right.ids))
            reach = 2 * len(tail)

    def _joined(self, left: Tokens, right: Tokens, first: int, x: int, words: list, rest: int) -> Tokens:
        """``words`` (place behind x, word, bytes, special id) between the left side's ``first`` token and the right side's ``rest``."""
        ids, starts = [left.ids[:first]], [left.starts[:first]]
        l_ends = np.cumsum(self.size[left.ids])
        r_ends = l_ends[-1] + np.cumsum(self.size[right.ids])
        l_from, r_from = l_ends - self.size[left.ids], r_ends - self.size[right.ids]
        for at, word, size, special in words:
            p, q = x + at, x + at + size
            if special is not None:
                own = np.array([special], np.int64)
            elif size <= LONG_WORD:
                own = self.word_ids(word)
            else:
                own = self.join_word(word, self._inside(left, l_from, l_ends, p, q, True), self._inside(right, r_from, r_ends, p, q, False))
            ids.append(own)
            mark = np.zeros(len(own), bool)
            mark[:1] = True
            starts.append(mark)
        return Tokens(np.concatenate([*ids, right.ids[rest:]]), np.concatenate([*starts, right.starts[rest:]]))

    @staticmethod
    def _inside(side: Tokens, begins: np.ndarray, ends: np.ndarray, p: int, q: int, from_start: bool) -> np.ndarray:
        """The side's tokens between the bytes p and q of its one word that starts at p (or ends at q); none without such a word."""
        if from_start:
            a = int(np.searchsorted(begins, p))
            if a == len(begins) or begins[a] != p or not side.starts[a]:
                return side.ids[:0]
            b = int(np.searchsorted(ends, q, "right"))
            more = np.flatnonzero(side.starts[a + 1:b])
            return side.ids[a:a + 1 + int(more[0]) if len(more) else max(a, b)]
        b = int(np.searchsorted(ends, q))
        if b == len(ends) or ends[b] != q or (b + 1 < len(ends) and not side.starts[b + 1]):
            return side.ids[:0]
        a = int(np.searchsorted(begins, p))
        more = np.flatnonzero(side.starts[a:b + 1])
        return side.ids[a + int(more[-1]) if len(more) else a:b + 1]


def read_vocabulary(path: str) -> str:
    """The tokenizer's JSON file, read by the driver; it travels with the tasks."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def _text(own: list[bytes], ids: bytes) -> bytes:
    """The text of packed ids; broken UTF-8 as replacement characters."""
    return b"".join([own[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace").encode()


def _short(df: DataFrame, vocabulary: str, decode: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = None
        for batch in sized_slices(batches, 1, SLICE_BYTES):
            bpe = bpe or Bpe(vocabulary)
            found = bpe.encode([t.decode("utf-8", "replace") for t in batch.column(1).to_pylist()])
            columns = {"id": batch.column(0), "ids": pa.array(found, pa.binary())}
            if decode:
                columns["text"] = pa.array([_text(bpe.bytes, ids) for ids in found], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return df.select("id", "t").mapInArrow(run, "id long, ids binary" + ", text string" * decode)


_NODE = "row long, id long, height int, k long, ids binary, starts binary"


def _leaves(df: DataFrame, vocabulary: str, leaf: int) -> DataFrame:
    """Staged and encoded leaves (row, id, height, k, ids, starts) of the long texts, each encoded wherever it was dealt."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = None
        for batch in sized_slices(batches, 2):
            bpe = bpe or Bpe(vocabulary)
            for row, i, t in zip(*(c.to_pylist() for c in batch.columns)):
                parts = bpe.leaves(t.decode("utf-8", "replace"), leaf)
                n = len(parts)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row] * n, pa.int64()), pa.array([i] * n, pa.int64()), pa.array([n.bit_length() - 1] * n, pa.int32()),
                    pa.array(range(n), pa.int64()), pa.array([p.encode() for p in parts], pa.binary()),
                ], ["row", "id", "height", "k", "t"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = None
        for batch in sized_slices(batches, 4):
            bpe = bpe or Bpe(vocabulary)
            found = [bpe.leaf(t.decode()) for t in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([_pack(f.ids) for f in found], pa.binary()), pa.array([np.packbits(f.starts).tobytes() for f in found], pa.binary())], ["row", "id", "height", "k", "ids", "starts"])

    parts = df.select(F.monotonically_increasing_id().alias("row"), "id", "t").mapInArrow(cut, "row long, id long, height int, k long, t binary")
    return stage(parts.repartition("row", "k").mapInArrow(encode, _NODE), "bpe-leaves")


def _round(nodes: DataFrame, vocabulary: str, fan: int) -> DataFrame:
    """Up to ``fan`` neighbouring nodes of a text become one."""
    kept: list[Bpe] = []

    def of_group(group: pa.Table) -> pa.Table:
        if not kept:
            kept.append(Bpe(vocabulary))
        rows = sorted(group.to_pylist(), key=lambda r: r["k"])
        level = []
        for r in rows:
            ids = np.frombuffer(r["ids"], "<u4").astype(np.int64)
            level.append(Tokens(ids, np.unpackbits(np.frombuffer(r["starts"], np.uint8), count=len(ids)).astype(bool)))
        while len(level) > 1:  # 2^n leaves, so neighbours are siblings
            level = [kept[0].join(a, b) for a, b in zip(level[::2], level[1::2])]
        one = rows[0] | {"k": rows[0]["k"] // fan, "height": max(0, rows[0]["height"] - fan.bit_length() + 1), "ids": _pack(level[0].ids), "starts": np.packbits(level[0].starts).tobytes()}
        return pa.Table.from_pylist([one], pa.schema([("row", pa.int64()), ("id", pa.int64()), ("height", pa.int32()), ("k", pa.int64()), ("ids", pa.binary()), ("starts", pa.binary())]))

    return nodes.groupBy("row", F.floor(F.col("k") / fan).alias("to")).applyInArrow(of_group, _NODE)


def bpe_encode(docs: DataFrame, vocabulary: str, leaf: int = LEAF, fan: int = FAN, decode: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, ids binary) per row of ``docs``; ``vocabulary`` is the text of a byte-level BPE file (``read_vocabulary``).

    With ``decode`` also ``text``, decoded from the ids where they are made (as ``decode_column`` does elsewhere).
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), binary(F.col(text_col)).alias("t"))
    # the encoded leaves of texts beyond a leaf; a text that is one leaf already takes no part in any round
    nodes = _leaves(texts.filter(F.length("t") > leaf), vocabulary, leaf)
    height = nodes.agg(F.max("height")).first()[0] or 0
    while height > 0:
        nodes = _round(nodes, vocabulary, fan)
        height -= fan.bit_length() - 1
    nodes = nodes.select("id", "ids", *([decode_column(vocabulary, F.col("ids")).alias("text")] if decode else []))
    return _short(texts.filter(F.length("t") <= leaf), vocabulary, decode).unionByName(nodes)


def decode_column(vocabulary: str, ids: Column) -> Column:
    """The text of ``ids`` (binary, as ``bpe_encode`` gives them), special tokens included; null has none."""
    kept: list = []

    @F.arrow_udf("string")
    def bpe_decode(values: pa.Array) -> pa.Array:
        if not kept:
            kept.append(token_bytes(vocabulary))
        own = kept[0]
        return pa.array([None if v is None else _text(own, v) for v in values.to_pylist()], pa.binary()).cast(pa.string())

    return bpe_decode(ids)
