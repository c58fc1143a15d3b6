"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Method: texts are folded (lower case, compatibility forms, homoglyphs of other
scripts to Latin letters, digits and signs that stand for letters to those
letters; all else is a word gap). Lexicon entries are word beginnings and
whole words; an entry's weight is its log odds between toxic and clean
training texts. Entries of the longest match count; exception phrases (an
entry with the word before or after it that clean texts hold and toxic ones
don't) match longer and cancel it. The summed weight is normalised by the
length in words and mapped to 0..1 by a logistic curve.

Scale: the lexicon is learned from a bounded sample (SAMPLE whole texts of
SAMPLE_BYTES together, parameters) and is itself bounded (LEXICON entries). Texts of
the sample stay on the executors, which count beginnings and phrases and
compute each text's features; the driver gets LEXICON entries, LEXICON phrases
and four numbers a text. Scoring is one pass without a shuffle.

Defined results: a null or empty text has no hits and gets the score of a text
without hits; without any toxic training text the lexicon is empty; labels,
source, language and id are never inputs; repeated rows are scored alike;
other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfaudit.llm.common import SLICE, binary, slices
from shelfaudit.llm.labelled import best_cut, labelled_sample

#: Entries and exceptions the model may hold.
LEXICON = 4000
#: Shortest word beginning that can be an entry, and the longest.
SHORTEST, LONGEST = 4, 12
#: Toxic texts an entry must occur in (two where there are few), and its least log odds.
LEAST_TEXTS, LEAST_ODDS = 3, 2.0
CUT = 0.7
#: Candidates a counting task holds before it passes its counts on.
HELD = 100_000
#: Labelled texts the lexicon is learned from, and their bytes (documented bounds).
SAMPLE, SAMPLE_BYTES = 12_000, 64 << 20
# fixed values: look-alikes of Latin letters in Cyrillic and Greek, and digits and signs used for letters
LOOKALIKES = dict(zip("асеорхуівкмтнѕјԁԛһɡαορνικτυεɑ", "aceopxyibkmthsjdqhgaopviktuea"))
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
_FOLD = str.maketrans(LOOKALIKES | {k: v for k, v in SUBSTITUTES.items() if k.isdigit()})
_SIGNS = re.compile(r"[@$](?=[^\W_])")
_GAP = re.compile(r"[\W_]+")


def fold(text: bytes) -> str:
    """Folded words with one space before, between and after."""
    t = text.decode("utf-8", "replace")
    if not t.isascii():
        t = unicodedata.normalize("NFKC", t)
    t = t.lower()
    if "@" in t or "$" in t:
        t = _SIGNS.sub(lambda m: SUBSTITUTES[m.group()], t)
    return " " + _GAP.sub(" ", t.translate(_FOLD)).strip() + " "


def _grams(word: str) -> Iterator[str]:
    """Lexicon candidates of a word: its beginnings, and the whole word."""
    for n in range(SHORTEST, min(len(word), LONGEST) + 1):
        yield " " + word[:n]
    if len(word) >= SHORTEST - 1:
        yield " " + word + " "


@dataclass
class Toxicity:
    """A fitted model: entries with weights, exception phrases, and the logistic curve."""

    weights: dict[str, float]
    exceptions: list[str]
    slope: np.ndarray

    def automaton(self):
        found = ahocorasick.Automaton()
        for e in self.exceptions:
            found.add_word(e, (e, 0.0))
        for k, w in self.weights.items():
            found.add_word(k, (k, w))
        found.make_automaton()
        return found if len(found) else None

    def hits(self, folded: str, automaton) -> list[tuple[str, float, int]]:
        """Longest matches: (entry, weight, place of its last character). Words share the gap between them,
        so it is doubled for matching."""
        if automaton is None:
            return []
        return [(v[0], v[1], end) for end, v in automaton.iter_long(folded.replace(" ", "  ")) if v[1]]

    def features(self, folded: str, hits: list[float]) -> np.ndarray:
        words = max(1, folded.count(" ") - 1)
        total = sum(hits)
        return np.array([np.log1p(total), min(3.0, 10.0 * total / (words + 20)), np.log(words + 20) / 5, 1.0])

    def score(self, x: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(x @ self.slope, -30, 30))))


def _counted(batches: Iterator[pa.RecordBatch], found_in) -> Iterator[pa.RecordBatch]:
    """(gram, toxic texts, clean texts) of a task's part of the sample; ``found_in(text)`` gives a text's grams."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())

    def out() -> pa.RecordBatch:
        grams = list(seen[0].keys() | seen[1].keys())
        counts = [pa.array([s[g] for g in grams], pa.int64()) for s in seen]
        for s in seen:
            s.clear()
        return pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), *counts], ["gram", "toxic", "clean"])

    for batch in slices(batches):
        for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen[1 - y].update(found_in(fold(t)))
            if len(seen[0]) + len(seen[1]) > HELD:
                yield out()
    yield out()


def _totals(sample: DataFrame, make_found_in) -> DataFrame:
    """(gram, toxic, clean) over the sample; ``make_found_in()`` makes a task's function of a folded text."""
    counts = sample.mapInArrow(lambda batches: _counted(batches, make_found_in()), "gram string, toxic long, clean long")
    return counts.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _phrases(folded: str, automaton) -> tuple[list[str], list[str]]:
    """(entries hit, phrases of a hit word with the word before or after it)."""
    words = folded.split()
    entries, phrases = [], []
    for i, w in enumerate(words):
        got = [v for _, v in automaton.iter_long(f" {w} ")] if automaton else []
        if got:
            entries.append(max(got, key=lambda v: len(v[0]))[0])
            phrases += [f" {a}  {b} " for a, b in zip(words[max(0, i - 1):i + 1], words[max(1, i):i + 2])]
    return entries, phrases


def fit(sample: DataFrame) -> Toxicity:
    """Learn lexicon, exceptions and curve from a bounded sample (t, y) that can be read again."""
    sizes = {r.y: r.n for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    odds = F.log((F.col("toxic") + 0.5) / (n1 + 1)) - F.log((F.col("clean") + 0.5) / (n0 + 1))
    sample = sample.repartition(8)  # bounded
    counts = _totals(sample, lambda: lambda folded: {g for w in set(folded.split()) for g in _grams(w)})
    least = LEAST_TEXTS if n1 >= 5 * LEAST_TEXTS else 2
    found = counts.filter(F.col("toxic") >= least).withColumn("odds", odds).filter(F.col("odds") >= LEAST_ODDS).orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "gram").limit(LEXICON).collect()
    counted = {r.gram: (r.toxic, r.clean) for r in found}

    def weight(toxic: float, clean: float) -> float:
        return max(0.0, float(np.log((toxic + 0.5) / (n1 + 1)) - np.log((clean + 0.5) / (n0 + 1))))

    model = Toxicity({g: weight(*c) for g, c in counted.items()}, [], np.zeros(4))

    def make_phrases():
        automaton = model.automaton()
        return lambda folded: set(_phrases(folded, automaton)[1])

    # phrases around the entries that clean texts hold and toxic ones don't
    cancel = _totals(sample, make_phrases).filter("clean >= 2 AND toxic = 0").orderBy(F.desc("clean"), "gram").limit(LEXICON)
    exceptions = [r.gram for r in cancel.collect()] if counted else []
    model = Toxicity(model.weights, exceptions, model.slope)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in slices(batches):
            rows = []
            for t, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                folded = fold(t)
                # leave-one-out weights: a text doesn't vouch for its own entries
                own = [weight(counted[g][0] - (label == 1), counted[g][1] - (label == 0)) if counted[g][0] - (label == 1) > 0 else 0.0 for g, _, _ in model.hits(folded, automaton)]
                rows.append(model.features(folded, own).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1)], ["x", "y"])

    rows = sorted((r.x, r.y) for r in sample.mapInArrow(features, "x array<double>, y int").collect())  # four numbers a text, in one order
    model.slope = _logistic(np.array([x for x, _ in rows]).reshape(-1, 4), np.array([y for _, y in rows], float))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Class-balanced ridge logistic regression by Newton steps, then shifted so that the best cut scores CUT."""
    b = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        b[-1] = -3.0 if not len(y) or y.max() == 0 else 3.0
        return b
    w = np.where(y == 1, 0.5 / (y == 1).mean(), 0.5 / (y == 0).mean())
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (w * p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * np.eye(len(b))
        step = np.linalg.solve(h, x.T @ (w * (y - p)) - ridge * b)
        b += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    b[-1] += np.log(CUT / (1 - CUT)) - best_cut(x @ b, y)
    return b


def score_column(model: Toxicity, text: Column) -> Column:
    """The score as an expression, so that other columns pass by untouched."""
    kept: list = []

    @F.arrow_udf("double")
    def toxicity_score(texts: pa.Array) -> pa.Array:
        if not kept:
            kept.append(model.automaton())
        out = []
        for k in range(0, len(texts), SLICE):
            for t in texts.slice(k, SLICE).to_pylist():
                folded = fold(t)
                out.append(model.score(model.features(folded, [w for _, w, _ in model.hits(folded, kept[0])])))
        return pa.array(out, pa.float64())

    return toxicity_score(binary(text))


def fit_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 3, held_fold: int = 1, rows: int = SAMPLE, most_bytes: int = SAMPLE_BYTES, id_col: str = "doc_id", text_col: str = "text") -> Toxicity:
    return fit(labelled_sample(docs, labels, "toxic", folds, held_fold, rows, most_bytes, id_col, text_col))
