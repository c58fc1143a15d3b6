"""Language-model scoring: a log-bilinear neural model trained in numpy with noise-contrastive estimation.

Method: tokens are lower-cased words and one end per text. The model's symbols
are the WORDS most frequent tokens of the training texts and CLASSES ending
classes for all others (a hash of a word's last three bytes). The previous
symbol's vector, through a matrix, predicts the next symbol's: score = (C r) . q + b.
It is trained on the symbol pairs of *all* training texts, counted in
Spark (at most SYMBOLS^2 numbers), by noise-contrastive estimation against
the unigram noise. Nothing is drawn: each step takes every counted pair with
its count and all symbols as noise with their expected number, so its work is
bounded by SYMBOLS^2 at any corpus size. One product of all contexts with all symbols, normalised by
rows, then gives every log-probability. A word of a class has the class's
probability times (c + 1) / (N + V + 1) of the class, so that all words, those
never seen included, share one distribution.

Base score: add-one unigrams, sum of log10((c + 1) / (N + V + 1)).

Scale: counts are summed in tasks before they move. Counts of the HEAD most
frequent words (a bound, a few MB) travel with the tasks, the others are
joined by word, so neither frequent words make hot keys nor is the vocabulary
held anywhere as a whole. What is gathered grows with the corpus.

Defined results: a null or empty text is its end alone; a null id counts as
training fold; without training texts every base count is zero; repeated rows
are scored alike; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfaudit.llm.common import binary, fold_of, map_batches, slices
from shelfaudit.session import stage

END = b""  # no word is empty
WORDS, CLASSES = 1536, 512
SYMBOLS = WORDS + CLASSES
HEAD = 100_000
WIDTH, STEPS, NOISE, RATE, SEED = 24, 200, 256, 0.05, 11
#: Distinct words a counting task holds before it passes its counts on.
HELD = 500_000


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def class_of(word: bytes) -> int:
    return WORDS + zlib.crc32(word[-3:]) % CLASSES


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "c"])

    for batch in slices(batches):
        for t in batch.column(0).to_pylist():
            seen.update(tokens(t))
            if len(seen) > HELD:
                yield out()
                seen.clear()
    yield out()


@dataclass
class Vocabulary:
    """Counts that travel with tasks: HEAD words by falling count, the totals, and each class's (N, V)."""

    words: list[bytes]
    counts: np.ndarray
    total: int
    distinct: int
    class_n: np.ndarray
    class_v: np.ndarray

    def symbols(self) -> tuple[dict[bytes, int], np.ndarray]:
        """(rank of each head word, symbol of each rank); the end and the next most frequent words are symbols."""
        rank = {w: k for k, w in enumerate(self.words)}
        symbol = np.empty(len(self.words), np.int64)
        for k, w in enumerate(self.words):
            symbol[k] = k if k < WORDS else class_of(w)
        return rank, symbol


def vocabulary(train: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """(vocabulary, staged counts of all words: word binary, c) of the texts ``t``."""
    counts = stage(train.mapInArrow(_count_words, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")), "lm-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("word")).first()
    # the end first, so that it is a symbol however rare
    top = counts.orderBy((F.col("word") != F.lit(END)).cast("int"), F.desc("c"), "word").limit(HEAD).toArrow()
    words = top.column("word").to_pylist() or [END]
    symbols = set(words[:WORDS])

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, v = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for batch in slices(batches):
            for w, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if w not in symbols:
                    k = class_of(w) - WORDS
                    n[k] += c
                    v[k] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(n), pa.array(v)], ["k", "n", "v"])

    n, v = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in counts.mapInArrow(classes, "k long, n long, v long").groupBy("k").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        n[r.k], v[r.k] = r.n, r.v
    return Vocabulary(words, np.array(top.column("c").to_pylist() or [0], np.int64), int(total), int(distinct), n, v), counts


class Reader:
    """Symbols of a text's tokens; built once a task from the vocabulary."""

    def __init__(self, known: Vocabulary):
        self.rank, self.symbol = known.symbols()
        self._classes: dict[bytes, int] = {}

    def read(self, text: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """(tokens, rank of each or -1, symbol of each)."""
        words = tokens(text)
        get = self.rank.get
        ranks = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        symbols = self.symbol[ranks]
        classes = self._classes
        for i in np.flatnonzero(ranks < 0).tolist():
            ending = words[i][-3:]
            k = classes.get(ending)
            if k is None:
                if len(classes) > 100_000:
                    classes.clear()
                k = classes[ending] = class_of(ending)
            symbols[i] = k
        return words, ranks, symbols


def pair_counts(train: DataFrame, known: Vocabulary) -> np.ndarray:
    """How often each symbol follows each, over all training texts: SYMBOLS x SYMBOLS; a text follows an end."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, seen = Reader(known), np.zeros(SYMBOLS * SYMBOLS, np.int64)
        for batch in slices(batches):
            for t in batch.column(0).to_pylist():
                symbols = reader.read(t)[2]
                np.add.at(seen, np.concatenate(([0], symbols[:-1])) * SYMBOLS + symbols, 1)
        at = np.flatnonzero(seen)
        for k in range(0, len(at), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(at[k:k + 100_000]), pa.array(seen[at[k:k + 100_000]])], ["pair", "n"])

    found = train.mapInArrow(pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SYMBOLS * SYMBOLS, np.int64)
    out[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(SYMBOLS, SYMBOLS)


@dataclass
class LogBilinear:
    """Context vectors r, context matrix c, symbol vectors q, symbol biases b."""

    r: np.ndarray
    c: np.ndarray
    q: np.ndarray
    b: np.ndarray

    def log10_probabilities(self) -> np.ndarray:
        """Normalised log10 P(symbol | previous symbol), SYMBOLS x SYMBOLS, in blocks of contexts."""
        out = np.empty((len(self.r), len(self.q)), np.float32)
        for k in range(0, len(self.r), 256):
            s = (self.r[k:k + 256] @ self.c) @ self.q.T + self.b
            s -= s.max(1, keepdims=True)
            out[k:k + 256] = (s - np.log(np.exp(s).sum(1, keepdims=True))) / np.log(10)
        return out


def train_nce(pairs: np.ndarray, steps: int = STEPS) -> LogBilinear:
    """Noise-contrastive estimation, NOISE noise symbols a pair by the unigram counts; each step is over all counted pairs.

    A symbol that no pair has stays at its smoothed unigram.
    """
    rng = np.random.default_rng(SEED)
    noise_p = pairs.sum(0) + 0.5
    noise_p = noise_p / noise_p.sum()
    expected = (NOISE * noise_p).astype(np.float32)
    log_kp = np.log(expected)
    p = {
        "r": rng.normal(0, 0.3, (SYMBOLS, WIDTH)), "c": np.eye(WIDTH) + rng.normal(0, 0.05, (WIDTH, WIDTH)),
        "q": rng.normal(0, 0.3, (SYMBOLS, WIDTH)), "b": np.log(noise_p),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    of_context = pairs.sum(1)
    contexts, unseen = np.flatnonzero(of_context), pairs.sum(0) == 0
    p["r"][of_context == 0] = 0
    p["q"][unseen] = 0
    if not len(contexts):
        return LogBilinear(**p)
    share = (pairs[contexts] / of_context.sum()).astype(np.float32)
    mean, square = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for step in range(steps):
        g = {k: np.zeros_like(v) for k, v in p.items()}
        for k in range(0, len(contexts), 256):
            own, data = contexts[k:k + 256], share[k:k + 256]
            r = p["r"][own]
            guess = r @ p["c"]
            # of the pairs and the noise at (context, symbol), the part that the model takes for pairs
            d = 1 / (1 + np.exp(np.clip(log_kp - guess @ p["q"].T - p["b"], -30, 30)))
            d *= data + data.sum(1, keepdims=True) * expected
            d -= data
            d_guess = d @ p["q"]
            g["q"] += d.T @ guess
            g["b"] += d.sum(0)
            g["c"] += r.T @ d_guess
            g["r"][own] = d_guess @ p["c"].T
        g["q"][unseen], g["b"][unseen] = 0, 0
        rate = RATE * (1 - 0.9 * step / steps)
        for k in p:
            mean[k] += 0.1 * (g[k] - mean[k])
            square[k] += 0.01 * (g[k] ** 2 - square[k])
            p[k] -= rate * (mean[k] / (1 - 0.9 ** (step + 1))) / (np.sqrt(square[k] / (1 - 0.99 ** (step + 1))) + 1e-14)
    return LogBilinear(**p)


def lm_scores(docs: DataFrame, folds: int = 7, held_fold: int = 2, steps: int = STEPS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs``.

    Learns from the rows outside the held-out fold only; every row is scored.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), (fold_of(F.col(id_col), folds) == held_fold).alias("held"), binary(F.col(text_col)).alias("t"))
    train = texts.filter(~F.col("held")).select("t")
    known, counts = vocabulary(train)
    model = train_nce(pair_counts(train, known), steps)

    def setup():
        reader, table = Reader(known), model.log10_probabilities()
        log_c = np.log10(known.counts + 1.0)
        is_known = known.counts > 0
        class_log = np.concatenate((np.zeros(WORDS), np.log10(known.class_n + known.class_v + 1.0)))

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for t in batch.column(2).to_pylist():
                words, ranks, symbols = reader.read(t)
                head = ranks >= 0
                own = ranks[head]
                lm = float(table[np.concatenate(([0], symbols[:-1])), symbols].sum(dtype=np.float64) - class_log[symbols].sum() + log_c[own[own >= WORDS]].sum())
                tail = Counter(words[i] for i in np.flatnonzero(~head).tolist())
                rows.append((len(words), int(is_known[own].sum()), float(log_c[own].sum()), lm, list(tail), list(tail.values())))
            cols = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64())))]
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], ["id", "held", "n", "known", "base", "lm", "words", "times"])

        return work

    read = map_batches(texts, "id long, held boolean, n long, known long, base double, lm double, words array<binary>, times array<long>", setup)
    read = stage(read.withColumn("row", F.monotonically_increasing_id()), "lm-read")
    tail = read.select(F.col("row").alias("t_row"), F.explode(F.arrays_zip("words", "times")).alias("x")).select("t_row", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
    tail = tail.join(counts, "word").groupBy("t_row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("log_c"))
    extra = F.coalesce("log_c", F.lit(0.0))
    total = F.lit(float(known.total + known.distinct + 1))
    return read.join(tail, F.col("row") == F.col("t_row"), "left").select(
        "id", F.col("held").alias("held_out"), F.col("n").alias("n_tokens"), (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"), (F.col("base") + extra - F.col("n") * F.log10(total)).alias("base_score"), (F.col("lm") + extra).alias("score"),
    )
