"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded, a gated attention layer
weighs the passages with weights learned from document labels alone, and the
weighted passage representation is scored (Ilse, Tomczak and Welling 2018). The
only inputs are the characters of the text.

The model is fitted with numpy on at most ``MAX_LABELLED`` labelled documents, those
with the smallest key hashes, as many of them in this order as hold ``MAX_PASSAGES``
passages together; each takes part whole. The least text stands for a key with several.
Scoring covers every passage of every document.

Defined results: a NULL or empty text is one empty passage and gets a score;
without labels of both classes every score is 0.5; repeated rows score alike;
rows with a NULL key or label never train; other columns are kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import checkpointed, serving

#: Bound of the training sample, in labelled documents.
MAX_LABELLED = 3000
#: Bound of the same sample, in passages of its documents (284 bytes each at the driver).
MAX_PASSAGES = 300_000
PASSAGE_WORDS = 64
HASHED = 128
#: Longest run of characters of one word that counts, so that a passage stays small.
WORD_CHARS = 400
PASS_AT = 0.3
HIDDEN, GATE, EPOCHS, BATCH, RATE, DECAY, SEED = 24, 12, 30, 64, 0.01, 1e-4, 7

_CLASSES = np.full(256, 7, dtype=np.int64)
for _i in range(128):
    _c = chr(_i)
    _CLASSES[_i] = 0 if _c.islower() else 1 if _c.isupper() else 2 if _c.isdigit() else 3 if _c == "\n" else 4 if _c.isspace() else 5 if _c in "#*$%&|<>!" else 6
FEATURES = 8 + 6 + HASHED


def passages(text: str | None) -> Iterator[list[str]]:
    """Consecutive runs of PASSAGE_WORDS words; long words are cut into pieces."""
    words = (text or "").split(" ")
    if any(len(w) > WORD_CHARS for w in words):
        words = [w[i : i + WORD_CHARS] for w in words for i in range(0, max(1, len(w)), WORD_CHARS)]
    for i in range(0, len(words), PASSAGE_WORDS):
        yield words[i : i + PASSAGE_WORDS]


def features(text: str | None) -> np.ndarray:
    """One row of FEATURES numbers for each passage of a text."""
    rows = []
    for words in passages(text):
        raw = " ".join(words).encode()
        row = np.zeros(FEATURES, dtype=np.float32)
        if raw:
            b = np.frombuffer(raw, dtype=np.uint8).astype(np.int64)
            n = len(b)
            row[:8] = np.bincount(_CLASSES[b], minlength=8) / n
            pairs = list(zip(words, words[1:]))
            row[8] = np.log1p(n) / 6
            row[9] = len(set(words)) / len(words)
            row[10] = len(set(pairs)) / len(pairs) if pairs else 1.0
            row[11] = n / len(words) / 10
            row[12] = len(zlib.compress(raw, 1)) / (n + 20)
            row[13] = max(map(len, words)) / WORD_CHARS
            if n > 1:
                row[14:] = np.sqrt(np.bincount((b[:-1] * 31 + b[1:]) % HASHED, minlength=HASHED) / (n - 1))
        rows.append(row)
    return np.stack(rows)


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


class GatedAttention:
    """Encoder, gated attention and scorer; plain numpy, small enough to ship in a closure."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, rng: np.random.Generator):
        draw = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape)
        self.mean, self.spread = mean, spread
        self.p = {"W": draw(FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "V": draw(HIDDEN, GATE), "U": draw(HIDDEN, GATE), "w": draw(GATE), "c": draw(HIDDEN), "d": np.zeros(1)}

    def forward(self, x: np.ndarray, starts: np.ndarray):
        p = self.p
        x = np.clip((x - self.mean) / self.spread, -6, 6)
        h = np.tanh(x @ p["W"] + p["b"])
        tv, su = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (tv * su) @ p["w"]
        sizes = np.diff(np.append(starts, len(x)))
        a = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        a /= np.repeat(np.add.reduceat(a, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts)
        return x, h, tv, su, a, z, sizes, _sigmoid(z @ p["c"] + p["d"])

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        starts = np.cumsum([0, *map(len, bags)])[:-1]
        return self.forward(np.concatenate(bags), starts)[-1]

    def gradients(self, bags: list[np.ndarray], y: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        starts = np.cumsum([0, *map(len, bags)])[:-1]
        x, h, tv, su, a, z, sizes, s = self.forward(np.concatenate(bags), starts)
        ds = (s - y) / len(y)
        dz = np.repeat(ds[:, None] * p["c"], sizes, axis=0)
        da = (dz * h).sum(1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, starts), sizes))
        dg = de[:, None] * p["w"]
        dtv, dsu = dg * su * (1 - tv**2), dg * tv * su * (1 - su)
        dh = (a[:, None] * dz + dtv @ p["V"].T + dsu @ p["U"].T) * (1 - h**2)
        return {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dtv, "U": h.T @ dsu, "w": (tv * su).T @ de, "c": z.T @ ds, "d": np.array([ds.sum()])}


def train(bags: list[np.ndarray], y: np.ndarray) -> GatedAttention | None:
    """Adam on log loss; None if a class is missing. Deterministic for given bags."""
    if len(set(y.tolist())) < 2:
        return None
    rng = np.random.default_rng(SEED)
    flat = np.concatenate(bags)
    model = GatedAttention(flat.mean(0), flat.std(0) + 0.02, rng)
    m, v, t = {k: 0.0 for k in model.p}, {k: 0.0 for k in model.p}, 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), BATCH):
            part = order[i : i + BATCH]
            t += 1
            for k, g in model.gradients([bags[j] for j in part], y[part]).items():
                g = g + DECAY * model.p[k]
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                model.p[k] -= RATE * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return model


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo 5; fold 0 is held out."""
    return F.crc32(key.cast("string").cast("binary")) % 5


def most_passages(text: Column) -> Column:
    """No fewer than the passages of a text: its words, and the pieces of its long words, in runs of PASSAGE_WORDS."""
    known = F.coalesce(text, F.lit(""))
    words = F.length(known) - F.length(F.replace(known, F.lit(" "))) + 1
    return F.floor((words + F.floor(F.length(known) / WORD_CHARS)) / PASSAGE_WORDS) + 1


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, key: str = "doc_id", text: str = "text", label: str = "quality", max_passages: int = MAX_PASSAGES) -> GatedAttention | None:
    """Fits on labelled rows outside fold 0. Passage features come to the driver, texts do not.

    The labelled sample is cut to ``max_labelled`` keys before the join, so its
    broadcast is bounded and documents are neither shuffled nor sorted. Of these keys, in
    the same order, the ones within ``max_passages`` are encoded; the window over them has
    a short row a key.
    """
    sample = (
        labels.select(F.col(key).alias("_key"), F.col(label).alias("_label"))
        .where("_key is not null and _label is not null")
        .groupBy("_key")
        .agg(F.min("_label").alias("_label"))
        .where(fold(F.col("_key")) != 0)
        .orderBy(F.xxhash64("_key"), "_key")
        .limit(max_labelled)
    )

    @F.pandas_udf("binary")
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        serving("quality")
        for part in parts:
            yield pd.Series([features(x).astype(np.float16).tobytes() for x in part], dtype=object)

    texts = checkpointed(
        docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
        .join(F.broadcast(sample), "_key")
        # One text for each key: rows that repeat a key do not make the sample larger.
        .groupBy("_key", "_label")
        .agg(F.min("_text").alias("_text"))
    )
    held = F.sum("passages").over(Window.orderBy(F.xxhash64("_key"), "_key").rowsBetween(Window.unboundedPreceding, 0))
    chosen = texts.select("_key", most_passages(F.col("_text")).alias("passages")).withColumn("held", held).where(F.col("held") <= max_passages)
    rows = texts.join(F.broadcast(chosen.select("_key")), "_key", "left_semi").select("_key", "_label", encode("_text").alias("bag")).collect()
    rows.sort(key=lambda r: (r["_key"], bytes(r["bag"])))
    bags = [np.frombuffer(r["bag"], dtype=np.float16).reshape(-1, FEATURES).astype(np.float32) for r in rows]
    return train(bags, np.array([float(r["_label"] > 0) for r in rows])) if rows else None


def score_column(model: GatedAttention | None, text: Column) -> Column:
    """Score of every text, 0 to 1, higher where the label 1 is likelier."""
    if model is None:
        return F.lit(0.5)

    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        serving("quality")
        for part in parts:
            out = []
            for i in range(0, len(part), 64):
                out.extend(model.score([features(x) for x in part.iloc[i : i + 64]]).tolist())
            yield pd.Series(out, dtype="float64")

    return run(text)
