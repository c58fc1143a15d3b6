"""Alignment against a plain loop over tokens."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shelfaudit.llm import alignment as al
from shelfaudit.llm import queries
from shelfaudit.llm.bpe_tree import read_vocabulary
from tests.llm.conftest import EDGE

BYTE_BPE = read_vocabulary(queries.BYTE_BPE)
with open(queries.PIECES, "rb") as _f:
    PIECES = _f.read()
MORE = [(20, "special <|endoftext|> tokens <s>a</s>"), (21, "naïve ▁ piece"), (22, " two  spaces\n\n\tand tabs "), (23, "ﬁ ligature Ⅳ"), (24, "the same words the same words"), (25, "​"), (26, "a"), (26, "b")]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_str(BYTE_BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_proto=PIECES)


def byte_of():
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, n = {chr(b): b for b in own}, 0
    for b in range(256):
        if b not in own:
            table[chr(256 + n)] = b
            n += 1
    return table


def spans(ids, pieces):
    out, at = [], 0
    for i, p in zip(ids, pieces):
        out.append((i, at, at + len(p)))
        at += len(p)
    return out


def brute(rows, tokenizers):
    """A row of figures a document, in the order of ``rows``."""
    a_tok, b_tok = tokenizers
    table, found, counts = byte_of(), [], Counter()
    for i, t in rows:
        a = b = []
        if t:
            ids = a_tok.encode(" " + t, add_special_tokens=False).ids
            a_bytes = [bytes(table[c] for c in a_tok.id_to_token(x)) for x in ids]
            b_ids = b_tok.encode(t)
            b_bytes = [bytes([int(p[3:5], 16)]) if b_tok.is_byte(x) else p.replace("▁", " ").encode() for x, p in zip(b_ids, map(b_tok.id_to_piece, b_ids))]
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + t).encode():
                a, b = spans(ids, a_bytes), spans(b_ids, b_bytes)
        links, k = [], 0
        for x, s, e in a:
            while k < len(b) and b[k][2] <= s:
                k += 1
            j = k
            while j < len(b) and b[j][1] < e:
                links.append((x, b[j][0]))
                j += 1
        counts.update(links)
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, low = [], 0
        for c in cuts:
            side = lambda own: ",".join(str(x) for x, s, e in own if low <= s and e <= c)  # noqa: B023, E731
            groups.append(side(a) + "|" + side(b))
            low = c
        found.append((i, len(a), len(b), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(n, most.get(y, 0))
    return sorted([(i, na, nb, g, len(ls), sum(counts[x] == most[x[1]] for x in ls), sum(counts[x] for x in ls), h) for i, na, nb, g, ls, h in found], key=str)


def figures(df):
    names = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


@pytest.mark.parametrize("most_pairs", [al.PAIRS, 10])
def test_equals_brute_force(spark, docs_of, tokenizers, monkeypatch, most_pairs):
    """With the merged counts in every task, and with a join instead; partial counts passed on early and in parts."""
    monkeypatch.setattr(al, "HELD", 60)
    monkeypatch.setattr(al, "PART", 7)
    monkeypatch.setattr(al, "SLICE_BYTES", 200)
    short = [(i, t if t is None or len(t) < 60_000 else " ".join(t.split()[:3000])) for i, t in EDGE]
    rows = [*short, *MORE]
    got = al.alignment(docs_of(rows), BYTE_BPE, PIECES, most_pairs=most_pairs)
    assert figures(got) == brute(rows, tokenizers)


def test_texts_that_a_tokenizer_changes_have_no_tokens(spark, docs_of, tokenizers):
    got = {r.id: r for r in al.alignment(docs_of(MORE), BYTE_BPE, PIECES).collect()}
    assert (got[21].n_a, got[21].n_b, got[21].groups_sha256) == (0, 0, "")
    assert got[20].n_a > 0 and got[22].n_groups > 0


def test_pieces_by_word_equal_whole_texts(tokenizers):
    draw = random.Random(2)
    words = al.PieceWords(tokenizers[1])
    assert words.apart
    texts = ["".join(draw.choices([" ", "  ", "a", "word", "\n", "\t", "é", "\U0001F600", "▁", ".", "​", "\u00a0", "　", "12"], k=draw.randint(1, 40))) for _ in range(3000)]
    texts += ["", " ", "   ", "x ", " x", "a \n", "\n", "\x00 b", *(t for _, t in EDGE if t and len(t) < 1000)]
    got = words.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == tokenizers[1].encode(texts)
    assert not words.by_word("naïve ▁") and words.by_word("  two")


def test_query_on_its_table(spark, tokenizers):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op11_alignment(spark, sf).withColumnRenamed("doc_id", "id")
    assert figures(got) == brute(rows, tokenizers)


def test_empty_table(spark, docs_of):
    assert al.alignment(docs_of(EDGE).limit(0), BYTE_BPE, PIECES).collect() == []
    assert figures(al.alignment(docs_of([(1, None), (2, "")]), BYTE_BPE, PIECES)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
