"""Quality by attention-based multiple-instance learning.

Method: a text is a bag of passages (``PASSAGE`` words each, the whole text).
Each passage is encoded: hashed byte bigrams and a few character and
repetition shares go through a learned layer to ``WIDTH`` numbers h. Gated
attention w . (tanh(V h) * sigmoid(U h)), a softmax over the passages, weighs
them; the weighted passage representation is scored by a logistic unit. All
weights are learned together from document labels by Adam, in numpy.

Scale: fitted on a bounded sample (labelled.TRAIN_ROWS whole texts of TRAIN_BYTES
together, parameters), whose features the executors compute: the driver holds
1 KB a passage, up to about three times the sample's bytes. Scoring is one pass
without a shuffle.

Defined results: a null or empty text is one passage of zeros; labels, source,
language and id are never inputs; without two label values in training every
text gets the one seen (0.5 if none); repeated rows are scored alike; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfaudit.llm.common import binary, slices
from shelfaudit.llm.labelled import TRAIN_BYTES, TRAIN_ROWS, best_cut, labelled_sample

PASSAGE, WIDTH, HASHED, SHARES = 64, 16, 256, 9
CUT = 0.7
STEPS, RATE, RIDGE, SEED = 150, 0.02, 1e-4, 7

_KIND = np.full(256, 5, np.uint8)  # 5: beyond ASCII
_KIND[:128] = 4  # other signs
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[48:58], _KIND[65:91], _KIND[97:123] = 1, 2, 3


def passages(text: bytes) -> np.ndarray:
    """Features of each passage of the whole text, (passages, HASHED + SHARES)."""
    words = text.split()
    if not words:
        return np.zeros((1, HASHED + SHARES), np.float32)
    n = -(-len(words) // PASSAGE)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    raw = np.frombuffer(b" ".join(words), np.uint8)
    ends = np.cumsum(lengths + 1) - 1
    last = np.append(ends[PASSAGE - 1::PASSAGE], ends[-1])[:n]
    of = np.zeros(len(raw), np.int64)
    of[last[:-1]] = 1
    of = np.cumsum(of)
    size = np.bincount(of, minlength=n).astype(np.float32)[:, None]
    out = np.empty((n, HASHED + SHARES), np.float32)
    pair = (raw[:-1].astype(np.int64) * 31 + raw[1:]) % HASHED
    out[:, :HASHED] = np.bincount(of[:-1] * HASHED + pair, minlength=n * HASHED).reshape(n, HASHED) / size * 8
    kinds = np.bincount(of * 6 + _KIND[raw], minlength=n * 6).reshape(n, 6) / size
    out[:, HASHED:HASHED + 6] = kinds * 4
    for k in range(n):
        w = words[k * PASSAGE:(k + 1) * PASSAGE]
        out[k, -3] = len(set(w)) / len(w)
        out[k, -2] = sum(a == b for a, b in zip(w, w[1:])) / len(w)
        out[k, -1] = min(3.0, size[k, 0] / len(w) / 8)
    return out


@dataclass
class Quality:
    """A fitted model: encoder (We, be), gate (V, U, w) and scorer (ws, bs)."""

    p: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        h = np.tanh(x @ p["We"] + p["be"])
        v, u = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (v * u) @ p["w"]
        counts = np.diff(np.append(starts, len(x)))
        a = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), counts))
        a /= np.repeat(np.add.reduceat(a, starts), counts)
        z = np.add.reduceat(a[:, None] * h, starts)
        return {"h": h, "v": v, "u": u, "a": a, "z": z, "counts": counts, "logit": z @ p["ws"] + p["bs"]}

    def score(self, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(x, starts)["logit"].astype(np.float64), -30, 30)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = [passages(t) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([f.tobytes() for f in found], pa.binary()), batch.column(1)], ["x", "y"])


def fit(sample: DataFrame, steps: int = STEPS) -> Quality:
    """Learn all weights from a bounded sample (t, y); features are computed on the executors."""
    rows = sample.mapInArrow(_features, "x binary, y int").toPandas()
    rng = np.random.default_rng(SEED)
    f = HASHED + SHARES
    p = {
        "We": rng.normal(0, 0.3, (f, WIDTH)), "be": np.zeros(WIDTH), "V": rng.normal(0, 0.3, (WIDTH, WIDTH)), "U": rng.normal(0, 0.3, (WIDTH, WIDTH)),
        "w": rng.normal(0, 0.3, WIDTH), "ws": rng.normal(0, 0.3, WIDTH), "bs": np.zeros(1),
    }
    model = Quality({k: v.astype(np.float32) for k, v in p.items()})
    y = rows.y.to_numpy(np.float32) if len(rows) else np.empty(0, np.float32)
    if len(y) == 0 or y.min() == y.max():
        model.p["ws"][:] = 0
        model.p["bs"][:] = 0.0 if not len(y) else 4.0 * (2 * y[0] - 1)
        return model
    order = np.lexsort((rows.x.map(hash_bytes).to_numpy(), y))  # the same order whatever the partitions were
    bags = [np.frombuffer(b, np.float32).reshape(-1, f) for b in rows.x.iloc[order]]
    y = y[order]
    x = np.concatenate(bags)
    starts = np.concatenate(([0], np.cumsum([len(b) for b in bags])[:-1]))
    weight = np.where(y == 1, 0.5 / (y == 1).mean(), 0.5 / (y == 0).mean()) / len(y)
    m, s = {k: np.zeros_like(v) for k, v in model.p.items()}, {k: np.zeros_like(v) for k, v in model.p.items()}
    for t in range(1, steps + 1):
        q, o = model.p, model.forward(x, starts)
        d = (weight * (1 / (1 + np.exp(-np.clip(o["logit"], -30, 30))) - y)).astype(np.float32)
        dz = np.repeat(d[:, None] * q["ws"], o["counts"], axis=0)
        da = (dz * o["h"]).sum(1)
        mean = np.add.reduceat(o["a"] * da, starts)
        de = o["a"] * (da - np.repeat(mean, o["counts"]))
        dv, du = de[:, None] * q["w"] * o["u"] * (1 - o["v"] ** 2), de[:, None] * q["w"] * o["v"] * o["u"] * (1 - o["u"])
        dh = (o["a"][:, None] * dz + dv @ q["V"].T + du @ q["U"].T) * (1 - o["h"] ** 2)
        g = {"We": x.T @ dh, "be": dh.sum(0), "V": o["h"].T @ dv, "U": o["h"].T @ du, "w": (o["v"] * o["u"]).T @ de, "ws": o["z"].T @ d, "bs": d.sum(keepdims=True)}
        for k in q:
            grad = g[k] + RIDGE * q[k]
            m[k] += 0.1 * (grad - m[k])
            s[k] += 0.01 * (grad ** 2 - s[k])
            q[k] -= (RATE * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(s[k] / (1 - 0.99 ** t)) + 1e-8)).astype(np.float32)
    model.p["bs"] += np.float32(np.log(CUT / (1 - CUT)) - best_cut(model.forward(x, starts)["logit"], y))
    return model


def hash_bytes(b: bytes) -> int:
    import zlib

    return zlib.crc32(b)


def score_column(model: Quality, text: Column) -> Column:
    """The score as an expression, so that other columns pass by untouched."""

    @F.arrow_udf("double")
    def quality_score(texts: pa.Array) -> pa.Array:
        out = []
        for k in range(0, len(texts), 64):  # small blocks bound the features held at once
            bags = [passages(t) for t in texts.slice(k, 64).to_pylist()]
            starts = np.concatenate(([0], np.cumsum([len(b) for b in bags])[:-1]))
            out.append(model.score(np.concatenate(bags), starts))
        return pa.array(np.concatenate(out) if out else np.empty(0), pa.float64())

    return quality_score(binary(text))


def fit_quality(docs: DataFrame, labels: DataFrame, folds: int = 4, held_fold: int = 2, rows: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES, id_col: str = "doc_id", text_col: str = "text") -> Quality:
    return fit(labelled_sample(docs, labels, "quality", folds, held_fold, rows, most_bytes, id_col, text_col))
