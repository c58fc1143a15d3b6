"""Secret scan: base patterns, and formats inferred as probabilistic automata.

Method: labelled credentials (the base patterns' values in the texts, SAMPLE of
each kind by hash, and examples of public token formats made by rule) are written
as strings of character classes, the head that all of a label's values share as one symbol.
For each label compatible prefix-tree states are merged into a probabilistic
automaton (``automata``). Every candidate, a run of 16 or more token
characters or what base spans leave of it, and every part of one that starts
after '=', '/' or '.' or at a known head and ends before one of the next three of these (or with the run, for
the run's start and known heads), however long, is scored by each automaton against a background, the symbol counts
of the ordinary candidates of all texts; one that is as likely as nearly all of a label's own examples, and
likelier than as background, becomes a span of that format. Base spans always
stay, and no other span overlaps one. Formats learned from a base
pattern's values are named like-assign, like-access and like-hex.

Scale: the labelled sample is bounded (SAMPLE values a label), so are the
automata; the background is one pass that counts a few dozen symbols a task, and
scanning one more without a shuffle.

Defined results: a null or empty text has no spans; offsets are code points,
ends exclusive; repeated rows are scanned alike; without any base match the
automata are those of the public formats; other columns are ignored.
"""

from __future__ import annotations

import math
import os
import random
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfaudit.llm.automata import FLOOR, Automaton
from shelfaudit.llm.common import map_batches, slices
from shelfaudit.session import stage

#: Values a label that the automata are learned from.
SAMPLE = 200
KINDS = ("assign", "access", "hex")
#: Formats learned from base values are labelled apart from the base patterns' own kinds.
LIKE = "like-"
_KEYS = ("password", "passwd", "secret", "token", "api_key", "apikey")


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_ASSIGN = re.compile(r"(%s)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)" % "|".join([*map(_either, _KEYS[:4]), _either("api") + "_?" + _either("key")]))
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f]+ that have 24 or more
LEAST = 16
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % LEAST)
_AFTER = re.compile(r"[=/.](?![=/.])")  # a part starts behind the last of separators
_BEFORE = re.compile(r"(?<![=/.-])[=/.]")  # and ends before the first
_CLASS = {**{c: "0" for c in "0123456789"}, **{c: "a" for c in "abcdef"}, **{c: "g" for c in "ghijklmnopqrstuvwxyz"}, **{c: "A" for c in "ABCDEF"}, **{c: "G" for c in "GHIJKLMNOPQRSTUVWXYZ"}}
_ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
# fixed values: public token formats as (label, prefix, alphabet, lengths of what follows)
FORMATS = (
    ("aws-key", "AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", (16,)),
    ("aws-temporary-key", "ASIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", (16,)),
    ("github", "ghp_", _ALNUM, (36,)),
    ("github-oauth", "gho_", _ALNUM, (36,)),
    ("gitlab", "glpat-", _ALNUM + "_-", (20,)),
    ("google-api", "AIza", _ALNUM + "_-", (35,)),
    ("npm", "npm_", _ALNUM, (36,)),
    ("sendgrid", "SG.", _ALNUM + "_-.", (22, 66)),
    ("slack", "xoxb-", "0123456789-" + _ALNUM, (48, 52)),
    ("stripe", "sk_live_", _ALNUM, (24, 99)),
    ("pypi", "pypi-", _ALNUM + "_-", (160, 180)),
)
# fixed values: how keys of several parts are really built, as (label, prefix, (alphabet, lengths) of each part, what stands between parts)
PARTED = (
    ("sendgrid-key", "SG.", ((_ALNUM + "_-", (22,)), (_ALNUM + "_-", (43,))), "."),
    ("slack-bot", "xoxb-", (("0123456789", (10, 11, 12, 13)), ("0123456789", (10, 11, 12, 13)), (_ALNUM, (24,))), "-"),
    ("slack-bot-short", "xoxb-", (("0123456789", (10, 11, 12, 13)), (_ALNUM, (24,))), "-"),
    ("json-web-token", "eyJ", ((_ALNUM + "_-", tuple(range(15, 90, 5))), (_ALNUM + "_-", (30, 60, 100, 150, 250, 400, 700)), (_ALNUM + "_-", (43, 86, 342))), "."),
)


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the base patterns, by start, then kind as listed."""
    found = []
    low = text.lower()
    if any(k in low for k in _KEYS):
        found += [("assign", m.start(), m.end(), m.group(2)) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m.group()) for m in _ACCESS.finditer(text) if len(m.group()) >= 20]
    found += [("hex", m.start(), m.end(), m.group()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


@dataclass
class Formats:
    """Fitted automata by label, with the least score of nearly all of their own examples, and the background."""

    heads: list[str]
    automata: dict[str, Automaton]
    least: dict[str, float]
    background: dict[str, float]

    def symbols(self, s: str) -> tuple[str, ...]:
        head = next((h for h in self.heads if s.startswith(h)), "")
        rest = [_CLASS.get(c, c) for c in s[len(head):]]
        return (head, *rest) if head else tuple(rest)

    def likelihoods(self, s: str) -> dict[str, float]:
        """Log-likelihood ratio to the background a symbol, by label."""
        x = self.symbols(s)
        ground = sum(self.background.get(c, math.log(FLOOR)) for c in x)
        return {k: (a.log_probability(x) - ground) / len(x) for k, a in self.automata.items()}

    def format_of(self, s: str) -> tuple[str, float] | None:
        fits = [(v, k) for k, v in self.likelihoods(s).items() if v > 0 and v >= self.least[k]]
        return (max(fits)[1], max(fits)[0]) if fits else None

    def parts(self, run: str) -> list[tuple[int, int, str, float]]:
        """Fitting parts of a run that don't overlap, as (start, end, label, likelihood ratio a symbol).

        The run itself is one; others start after a separator or at a known
        head, and end before any later separator or with the run, whatever
        their length. Of parts that overlap the one with the largest
        likelihood ratio goes first. Only each start's best part is held; it
        is looked for again when a part that went first cuts it.
        """
        size = len(run)
        while size and run[size - 1] in ".=-":  # sentence ends; padding is no part of a format
            size -= 1
        if size < LEAST:
            return []
        fit = self.format_of(run[:size])
        found = [(-fit[1] * len(self.symbols(run[:size])), 0, size, *fit)] if fit else []
        heads = {m.start() for h in self.heads for m in re.finditer(f"(?={re.escape(h)})", run[:size])}
        starts = {m.end() for m in _AFTER.finditer(run, 0, size)} | heads | {0}
        ends = sorted({m.start() for m in _BEFORE.finditer(run, 0, size)} | {size})
        marks = [_CLASS.get(c, c) for c in run]
        ground = [0.0, *accumulate(self.background.get(c, math.log(FLOOR)) for c in marks)]

        def best(start: int, limit: int) -> tuple[float, int, int, str, float] | None:
            head = next((h for h in self.heads if run.startswith(h, start)), "")
            body = start + len(head)
            # the run itself is done
            own = ends[bisect_left(ends, max(body + 1, start + LEAST)):bisect_right(ends, limit - (start == 0 and limit == size))]
            before = ground[body] - (self.background.get(head, math.log(FLOOR)) if head else 0.0)
            most = None
            for label, a in self.automata.items() if own else ():
                if (head or marks[start]) not in a.next[0]:
                    continue  # no automaton's floor is above the background
                for e, p, seen in a.walk(head, marks, body, own):
                    gain = p - (ground[e] - before)  # more than with the length's
                    if gain <= 0:
                        if seen:
                            continue
                        break  # behind an unseen step it only falls: no symbol is rarer than the floor
                    n = e - body + bool(head)
                    gain += a.log_length(n)
                    if gain > 0 and gain / n >= self.least[label]:
                        most = min(most or (math.inf,), (-gain, start, e, label, gain / n))
            return most

        found += [b for s in starts if s + LEAST <= size and (b := best(s, size))]
        heapify(found)
        out: list[tuple[int, int, str, float]] = []
        while found:
            _, s, e, label, v = heappop(found)
            at = bisect_left(out, (s,))
            if at and out[at - 1][1] > s:
                continue
            limit = out[at][0] if at < len(out) else size
            if e <= limit:
                out.insert(at, (s, e, label, v))
            elif (s, e) != (0, size) and (b := best(s, limit)):
                heappush(found, b)
        return out


def with_heads(labelled: dict[str, list[str]]) -> Formats:
    """No automata yet, but the heads of the labelled credentials, so that symbols can be counted."""
    heads = {os.path.commonprefix(values) for values in labelled.values() if len(values) > 2}
    return Formats(sorted((h for h in heads if len(h) > 2), key=lambda h: (-len(h), h)), {}, {}, {})


def learn(labelled: dict[str, list[str]], ordinary: list[str]) -> Formats:
    """Automata of labelled credentials; ``ordinary`` candidates make the background."""
    model = with_heads(labelled)
    known = {v for values in labelled.values() for v in values}
    return fit(model, labelled, Counter(c for s in ordinary if s not in known for c in model.symbols(s)))


def fit(model: Formats, labelled: dict[str, list[str]], marks: Counter) -> Formats:
    """Automata of labelled credentials; ``marks`` are the counts of the background's symbols."""
    marks = marks + Counter("0aAgG+/_.=-" * 5)
    total = sum(marks.values())
    # no symbol is rarer than an unseen step, or what an automaton can't read would seem likely
    model.background = {c: math.log(max(FLOOR, n / total)) for c, n in marks.items()}
    for label, values in sorted(labelled.items()):
        if values:
            model.automata[label] = Automaton([model.symbols(v) for v in values])
    for label, values in labelled.items():
        own = sorted(model.likelihoods(v)[label] for v in values)
        # a hair less: the same value's sums differ by rounding when they are made within a run
        model.least[label] = own[len(own) // 50] - 1e-9 if own else math.inf
    return model


def examples() -> dict[str, list[str]]:
    """Labelled examples of the public formats, the same on every run."""
    made = {}
    for label, prefix, alphabet, lengths in FORMATS:
        draw = random.Random(label)
        made[f"format-{label}"] = [prefix + "".join(draw.choices(alphabet, k=draw.choice(lengths))) for _ in range(SAMPLE)]
    for label, prefix, parts, mark in PARTED:
        draw = random.Random(label)
        made[f"format-{label}"] = [prefix + mark.join("".join(draw.choices(a, k=draw.choice(n))) for a, n in parts) for _ in range(SAMPLE)]
    return made


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SAMPLE values of each label with the smallest hashes in a task."""
    best: dict[str, dict[str, int]] = {}
    for batch in slices(batches):
        for t in batch.column(0).to_pylist():
            if not t:
                continue
            for k, _, _, v in base_spans(t):
                own = best.setdefault(k, {})
                own[v] = xxhash.xxh64_intdigest(v)
                if len(own) > 4 * SAMPLE:
                    best[k] = dict(sorted(own.items(), key=lambda x: (x[1], x[0]))[:SAMPLE])
    rows = [(k, v, h - (1 << 63)) for k, own in best.items() for v, h in sorted(own.items(), key=lambda x: (x[1], x[0]))[:SAMPLE]]
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())], ["label", "value", "h"])


def count_marks(docs: DataFrame, model: Formats, known: set[str], text_col: str = "text") -> Counter:
    """How often each symbol stands in the ordinary candidates of all texts: a few dozen numbers a task."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in slices(batches):
            for t in batch.column(0).to_pylist():
                if not t:
                    continue
                for s, e in free_runs(t, [(a, b) for _, a, b, _ in base_spans(t)]):
                    if t[s:e] not in known:
                        seen.update(model.symbols(t[s:e]))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["symbol", "n"])

    found = docs.select(F.col(text_col).alias("t")).mapInArrow(marks, "symbol string, n long").groupBy("symbol").agg(F.sum("n").alias("n"))
    return Counter({r.symbol: r.n for r in found.collect()})


def fit_formats(docs: DataFrame, text_col: str = "text") -> Formats:
    """Learn from the texts' own base matches (SAMPLE of each kind, by hash), the public formats and the symbols of all ordinary candidates."""
    found = docs.select(F.col(text_col).alias("t")).mapInArrow(_samples, "label string, value string, h long").distinct()
    found = stage(found, "secret-samples")  # SAMPLE rows a label and task at most; the texts are read once
    labelled: dict[str, list[str]] = examples()
    for label in KINDS:
        labelled[LIKE + label] = [r.value for r in found.filter(F.col("label") == label).orderBy("h", "value").limit(SAMPLE).collect()]
    model = with_heads(labelled)
    return fit(model, labelled, count_marks(docs, model, {v for values in labelled.values() for v in values}, text_col))


def free_runs(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """(start, end) of the candidates: what the base spans leave of the runs of token characters, LEAST or more."""
    taken, at = sorted(taken), 0
    for m in _CANDIDATE.finditer(text):
        s, end = m.span()
        while at < len(taken) and taken[at][0] < end:
            a, b = taken[at]
            if a - s >= LEAST:
                yield s, a
            s = max(s, b)
            if b > end:
                break  # it may reach into the next run
            at += 1
        if end - s >= LEAST:
            yield s, end


def all_spans(text: str, model: Formats) -> list[tuple[str, int, int, float]]:
    """Base spans and those of fitting candidates and parts of them between the base spans, by start, then kind."""
    rows = base_spans(text)
    out = [(k, s, e, 1.0) for k, s, e, _ in rows]
    for s, e in free_runs(text, [(a, b) for _, a, b, _ in rows]):
        out += [(label, s + a, s + b, 1 - math.exp(-v)) for a, b, label, v in model.parts(text[s:e])]
    rank = {k: n for n, k in enumerate(KINDS)}
    return sorted(out, key=lambda x: (x[1], rank.get(x[0], len(KINDS)), x[0]))


def secret_scan(docs: DataFrame, model: Formats, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, spans array<struct<kind, start, end, score>>) per row of ``docs``."""
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def setup():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [[dict(zip(("kind", "start", "end", "score"), s)) for s in all_spans(t, model)] if t else [] for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(kind))], ["id", "spans"])

        return work

    return map_batches(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")), "id long, spans array<struct<kind:string,start:long,end:long,score:double>>", setup)
