"""Tree concatenation against the tokenizer on whole texts."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfaudit.llm import bpe_tree, queries
from shelfaudit.llm.bpe_tree import WORD, Bpe, bpe_encode, decode_column, read_vocabulary, token_bytes
from tests.llm.conftest import EDGE

VOCABULARY = read_vocabulary(queries.BYTE_BPE)
SPECIAL = "<|endoftext|>"
# pieces whose words depend on what stands beside them
PIECES = ["a", "b", " ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", "é", "\U0001F600", "١", "23", "the", "don't", SPECIAL, "<|endo", "!", "!!", "ß", "===", "　"]


@pytest.fixture(scope="module")
def bpe():
    return Bpe(VOCABULARY)


def whole(bpe, text):
    return bpe.tokenizer.encode(text or "", add_special_tokens=False).ids


def tree(bpe, parts):
    level = [bpe.leaf(p) for p in parts]
    while len(level) > 1:
        level = [bpe.join(a, b) for a, b in zip(level[::2], level[1::2])]
    return level[0]


def texts():
    draw = random.Random(5)
    for k in range(300):
        yield "".join(draw.choices(PIECES, k=draw.randint(1, 90)))
        yield "".join(draw.choices("ab", k=draw.randint(1, 2500)))
        yield "".join(draw.choices("etaoinshrdlu", k=draw.randint(1, 3000)))
        yield draw.choice(["a", "ab", "é", " ", "=", "the", "\U0001F600", "\n", "  x", "1"]) * draw.randint(1, 1200)


def test_joined_leaves_equal_the_whole_text(bpe):
    draw = random.Random(6)
    for t in texts():
        parts = bpe.leaves(t, draw.choice([5, 17, 64, 300]))
        assert "".join(parts) == t and len(parts).bit_count() == 1
        got = tree(bpe, parts)
        assert got.ids.tolist() == whole(bpe, t), repr(t[:80])
        assert got.starts.tolist() == bpe.leaf(t).starts.tolist()
        assert bpe.text(got.ids) == t.encode()


def test_a_window_is_small_on_a_long_word(bpe, monkeypatch):
    """Joining a word of 40,000 letters encodes a few tokens around the join, not the word."""
    t = "".join(random.Random(3).choices("etaoinshrdlu", k=40_000))
    left, right = bpe.leaf(t[:20_000]), bpe.leaf(t[20_000:])
    seen = []
    own = Bpe.word_ids
    monkeypatch.setattr(Bpe, "word_ids", lambda self, w: (seen.append(len(w)), own(self, w))[1])
    assert bpe.join(left, right).ids.tolist() == whole(bpe, t)
    assert sum(seen) < 1000


def test_no_leaf_ends_inside_a_special_token(bpe):
    t = ("x" * 30 + SPECIAL) * 40 + SPECIAL * 5
    parts = bpe.leaves(t, 16)
    assert "".join(parts) == t and sum(p.count(SPECIAL) for p in parts) == 45
    assert tree(bpe, parts).ids.tolist() == whole(bpe, t)


def test_words_are_cut_as_the_tokenizer_does(bpe):
    """Beside letters, digits, signs and spaces, for every character; texts with newly assigned ones are left to it."""
    cut = bpe.tokenizer.pre_tokenizer.pre_tokenize_str
    rare = 0
    for c in map(chr, (*range(0xD800), *range(0xE000, 0x110000))):
        t = f"a{c}1{c}!{c} {c}{c}x"
        if bpe.remembered.by_word(t):
            assert [len(w.encode()) for w in WORD.findall(t)] == [len(w) for w, _ in cut(t)], hex(ord(c))
        else:
            rare += 1
    assert rare
    odd = ["a\u0558 \u05581", "b", "\U00010EC6\U00010EC6 x"]
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe.encode(odd)] == [whole(bpe, t) for t in odd]


def test_word_by_word_equals_whole_texts(bpe, monkeypatch):
    monkeypatch.setattr(bpe_tree, "WORDS", 50)  # forgotten again and again
    own = [t for _, t in zip(range(400), texts())]
    for k in range(0, len(own), 20):
        got = [np.frombuffer(x, "<u4").tolist() for x in bpe.encode(own[k:k + 20])]
        assert got == [whole(bpe, t) for t in own[k:k + 20]]


def test_rows_equal_whole_texts(spark, docs_of, bpe):
    rows = [*EDGE, (20, "x  " + SPECIAL + " y" + SPECIAL), (21, "a" * 9000 + " b"), (None, " " * 5000 + "z"), (22, "=" * 7000)]
    for leaf in (256, 1 << 16):
        found = bpe_encode(docs_of(rows), VOCABULARY, leaf=leaf, fan=4)
        assert found.columns == ["id", "ids"]
        got = found.withColumn("text", decode_column(VOCABULARY, F.col("ids"))).collect()
        got = sorted(((r.id, np.frombuffer(bytes(r.ids), "<u4").tolist(), r.text) for r in got), key=str)
        assert got == sorted(((i, whole(bpe, t), t or "") for i, t in rows), key=str)


def test_query_on_its_table(spark, bpe):
    got = {r.doc_id: r for r in queries.op12_bpe(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = whole(bpe, d.text)
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(bpe.tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_empty_table_and_bytes(spark, docs_of, bpe):
    assert bpe_encode(docs_of(EDGE).limit(0), VOCABULARY).collect() == []
    assert spark.createDataFrame([(None,)], "ids binary").select(decode_column(VOCABULARY, F.col("ids")).alias("t")).first().t is None
    own = token_bytes(VOCABULARY)
    assert own[50256] == SPECIAL.encode() and len(own) == 50257 and own[220] == b" "
