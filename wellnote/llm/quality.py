"""Document quality by attention-based multiple-instance learning.

A text is a bag of passages of ``PASSAGE`` bytes.  Each passage is encoded from its hashed byte
trigrams; gated attention, learned from document labels alone, weighs the passages; the score is a
logistic function of the weighted sum.  Every passage of a text takes part in its score.

The model is fitted in numpy on at most ``PER_LABEL`` labelled texts of each label and about
``FIT_BYTES`` bytes of them, a sample of rows chosen by text hash; of these every passage takes part.
It scores all rows on the executors.

Defined results: a null or empty text is one passage without trigrams; without labelled rows all
scores are 0.5, with one label only that label's rate; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellnote.llm.common import Adam, bounded_sample, is_held_out, text_id

PASSAGE = 512
BUCKETS = 512
HIDDEN, ATTENTION = 16, 8
PER_LABEL = 1200
FIT_BYTES = 32 << 20
STEPS, BATCH, RATE = 500, 64, 0.01


def passages(text: str | None) -> np.ndarray:
    """Square roots of trigram shares, one row per passage of the UTF-8 bytes."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    n = len(data)
    count = max(1, -(-n // PASSAGE))
    if n < 3:
        return np.zeros((count, BUCKETS), np.float32)
    wide = data.astype(np.int32)
    grams = (wide[:-2] * 7919 + wide[1:-1] * 104729 + wide[2:] * 1299709) >> 3
    at = (grams % BUCKETS) + (np.arange(n - 2, dtype=np.int32) // PASSAGE) * BUCKETS
    table = np.bincount(at, minlength=count * BUCKETS).astype(np.float32).reshape(count, BUCKETS)
    return np.sqrt(table / np.maximum(table.sum(axis=1, keepdims=True), 1))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class AttentionModel:
    """Passage encoder, gated attention and logistic output."""

    def __init__(self, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)

        def weights(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.p = {"W": 3 * weights(BUCKETS, HIDDEN), "b": np.zeros(HIDDEN, np.float32),
                  "V": weights(HIDDEN, ATTENTION), "U": weights(HIDDEN, ATTENTION),
                  "a": weights(ATTENTION, 1), "o": weights(HIDDEN, 1), "c": np.zeros(1, np.float32)}
        self.constant: float | None = None

    def forward(self, x: np.ndarray, starts: np.ndarray) -> tuple:
        """Scores of bags whose passages start at ``starts``, and what backward needs."""
        p = self.p
        sizes = np.diff(np.append(starts, len(x)))
        h = np.tanh(x @ p["W"] + p["b"])
        v, u = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = ((v * u) @ p["a"])[:, 0]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        attention = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(h * attention[:, None], starts, axis=0)
        score = _sigmoid((z @ p["o"])[:, 0] + p["c"][0])
        return score, (sizes, h, v, u, attention, z)

    def fit(self, texts: list, labels: np.ndarray, seed: int = 12, encode=passages) -> "AttentionModel":
        """``texts`` are encoded as batches need them: their tables take far more memory than they do."""
        if len(labels) == 0 or labels.min() == labels.max():
            self.constant = float(labels.mean()) if len(labels) else 0.5
            return self
        rng, adam, p = np.random.default_rng(seed), Adam(self.p, RATE), self.p
        groups = [np.flatnonzero(labels == k) for k in (0, 1)]
        for step in range(STEPS):
            # Half of each batch from either label: labels may be very uneven.
            chosen = np.concatenate([rng.choice(g, BATCH // 2) for g in groups])
            bags = [encode(texts[i]) for i in chosen]
            x = np.concatenate(bags)
            sizes = np.array([len(b) for b in bags])
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            score, (sizes, h, v, u, att, z) = self.forward(x, starts)
            d = ((score - labels[chosen]) / len(chosen)).astype(np.float32)[:, None]
            grads = {"o": z.T @ d, "c": d.sum(axis=0)}
            dz = np.repeat(d @ p["o"].T, sizes, axis=0)
            dh = dz * att[:, None]
            datt = (dz * h).sum(axis=1)
            de = att * (datt - np.repeat(np.add.reduceat(datt * att, starts), sizes))
            grads["a"] = (v * u).T @ de[:, None]
            dg = de[:, None] @ p["a"].T
            dv, du = dg * u * (1 - v * v), dg * v * u * (1 - u)
            grads["V"], grads["U"] = h.T @ dv, h.T @ du
            dh += dv @ p["V"].T + du @ p["U"].T
            dh *= 1 - h * h
            grads["W"], grads["b"] = x.T @ dh + 1e-5 * p["W"], dh.sum(axis=0)
            adam.step(grads, RATE * (1 - step / STEPS) + 1e-4)
        return self

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Score of every text; texts are encoded in groups of bounded size."""
        out = np.empty(len(texts))
        if self.constant is not None:
            out[:] = self.constant
            return out
        held: list[np.ndarray] = []
        rows = first = 0
        for i, text in enumerate(texts):
            held.append(passages(text))
            rows += len(held[-1])
            if rows >= 2048 or i + 1 == len(texts):
                starts = np.concatenate(([0], np.cumsum([len(b) for b in held])[:-1]))
                out[first: i + 1] = self.forward(np.concatenate(held), starts)[0]
                held, rows, first = [], 0, i + 1
        return np.clip(out, 0.0, 1.0)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> AttentionModel:
    """A model fitted on labelled documents outside the held-out fold."""
    marked = labels.filter(~is_held_out(F.col("doc_id")) & F.col(label).isNotNull()) \
        .select("doc_id", F.col(label).alias("_label")).distinct()
    labelled = docs.filter("text is not null").select("doc_id", text_id().alias("tid"), F.octet_length("text").alias("bytes")) \
        .join(marked, "doc_id").select("tid", F.col("_label").alias("label"), "bytes")
    sample = bounded_sample(docs, labelled, PER_LABEL, FIT_BYTES)
    return AttentionModel().fit([t for t, _ in sample], np.array([int(k) for _, k in sample], np.float32))


def score_column(model: AttentionModel, text: str = "text") -> Column:
    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd
        return pd.Series(model.scores([None if t is None else t for t in texts]))
    return score(F.col(text))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from 0.5 on) of every row."""
    model = train(docs, labels)
    return docs.select(F.col("doc_id"), is_held_out(F.col("doc_id")).alias("held_out"),
                       score_column(model).alias("score")) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
