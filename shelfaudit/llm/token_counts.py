"""Token counts of sections by offset-mapped attribution.

Method: a whole text is encoded once with a byte-level BPE. Token lengths give
each token's span of bytes; sections have spans of their own (a section ends
with its line break). Tokens and sections are joined by interval: a token that
lies in one section counts there, one that crosses a boundary counts for the
section that holds most of its bytes, the earlier one on a tie. So the
sections' counts always add up to the whole text's, which encoding the
sections one by one doesn't give.

Scale: one pass without a shuffle; the vocabulary file (a parameter, under a
megabyte) is read once by the driver and travels with the tasks.

Defined results: a null or empty text has no tokens and one empty section;
repeated rows are counted alike; other columns are ignored.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfaudit.llm.common import binary, map_batches

#: Default vocabulary: lines of base64 token and rank.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: how this vocabulary's pre-tokenizer splits text
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def encoder(vocabulary: bytes):
    """(encode(text) -> token ids, byte length of each token id)."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    size = np.zeros(max(ranks.values()) + 1, np.int64)
    size[list(ranks.values())] = [len(t) for t in ranks]
    return tiktoken.Encoding("sections", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, size


def sections(text: bytes, separator: bytes = b"\n") -> np.ndarray:
    """Byte ends (exclusive) of the sections; the last one is what follows the last separator, even if empty."""
    ends, at = [], text.find(separator)
    while at >= 0:
        ends.append(at + len(separator))
        at = text.find(separator, ends[-1])
    return np.array([*ends, len(text)], np.int64)


def attribute(token_ends: np.ndarray, section_ends: np.ndarray) -> tuple[np.ndarray, int]:
    """(tokens of each section, tokens that cross a boundary)."""
    starts = np.concatenate(([0], token_ends[:-1])) if len(token_ends) else token_ends
    first = np.searchsorted(section_ends, starts, "right")
    last = np.searchsorted(section_ends, token_ends, "left")
    # spans are clipped to sections; empty sections at the same place are passed over
    crossing = np.flatnonzero(last > first)
    home = np.minimum(first, len(section_ends) - 1)
    for t in crossing.tolist():
        best, at = -1, starts[t]
        for k in range(first[t], last[t] + 1):
            held = min(token_ends[t], section_ends[k]) - at
            if held > best:
                best, home[t] = held, k
            at = max(at, section_ends[k])
    return np.bincount(home, minlength=len(section_ends)), len(crossing)


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, separator: str = "\n", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, n_tokens, n_sections, n_crossing, section_tokens array<long>, section_bytes array<long>) per row of ``docs``."""
    with open(vocabulary, "rb") as f:
        raw = f.read()
    mark = separator.encode()

    def setup():
        encode, size = encoder(raw)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for t in batch.column(1).to_pylist():
                whole = t.decode("utf-8", "replace")  # Spark's strings are UTF-8; broken bytes count as replacements
                t = whole.encode()
                ids = np.asarray(encode(whole), np.int64)
                ends = sections(t, mark)
                counts, crossing = attribute(np.cumsum(size[ids]) if len(ids) else np.empty(0, np.int64), ends)
                rows.append((len(ids), len(ends), crossing, counts, np.diff(ends, prepend=0)))
            longs = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
            lists = [pa.array([r[k] for r in rows], pa.list_(pa.int64())) for k in (3, 4)]
            return pa.RecordBatch.from_arrays([batch.column(0), *longs, *lists], ["id", "n_tokens", "n_sections", "n_crossing", "section_tokens", "section_bytes"])

        return work

    return map_batches(docs.select(F.col(id_col).cast("long").alias("id"), binary(F.col(text_col)).alias("t")), "id long, n_tokens long, n_sections long, n_crossing long, section_tokens array<long>, section_bytes array<long>", setup)
