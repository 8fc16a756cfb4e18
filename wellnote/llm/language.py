"""Language identification with a bidirectional gated recurrent network over bytes.

A text is read in windows of ``WINDOW`` bytes, all of them.  A forward and a backward recurrent
network of ``HIDDEN`` units label every position; a document's probabilities are the means over
all its positions.  The network is trained in numpy by backpropagation through time on the windows, all of
them, of at most ``PER_LANGUAGE`` texts and about ``FIT_BYTES`` bytes of each language outside the
held-out fold, and applied on the executors.

Defined results: texts that are null or have no letter are ``und`` with score 0; without training
rows every text is ``und``; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellnote.llm.common import Adam, bounded_sample, is_held_out, text_id

WINDOW = 64
HIDDEN = 8
PER_LANGUAGE = 150
FIT_BYTES = 8 << 20
STEPS, BATCH, RATE = 240, 128, 0.02
#: Windows that go through the network at once.
BLOCK = 2048
UNKNOWN = "und"


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte windows (zero-padded) of all texts and the number of windows of each."""
    sizes = [-(-len(t) // WINDOW) for t in texts]
    data = b"".join(t.ljust(n * WINDOW, b"\0") for t, n in zip(texts, sizes))
    return np.frombuffer(data, np.uint8).reshape(-1, WINDOW), np.array(sizes, np.int64)


class BiGRU:
    """Per-position language probabilities of byte windows."""

    def __init__(self, languages: list[str], seed: int = 21) -> None:
        rng = np.random.default_rng(seed)
        self.languages = languages

        def weights(rows: int, columns: int, scale: float) -> np.ndarray:
            return (scale * rng.standard_normal((rows, columns))).astype(np.float32)

        self.p = {"Ef": weights(256, 3 * HIDDEN, 0.5), "Uf": weights(HIDDEN, 3 * HIDDEN, 0.3),
                  "Eb": weights(256, 3 * HIDDEN, 0.5), "Ub": weights(HIDDEN, 3 * HIDDEN, 0.3),
                  "O": weights(2 * HIDDEN, len(languages), 0.3),
                  "c": np.zeros(len(languages), np.float32)}

    def _states(self, x: np.ndarray, way: str, keep: bool = False) -> tuple[np.ndarray, list]:
        """States after each position of ``x`` (positions, windows), in the order of ``x``."""
        table, u = self.p["E" + way], self.p["U" + way]
        steps, count = x.shape
        out = np.empty((steps, count, HIDDEN), np.float32)
        h = np.zeros((count, HIDDEN), np.float32)
        kept = []
        for t in range(steps):
            g = table[x[t]]
            hu = h @ u
            gates = g[:, : 2 * HIDDEN]
            gates += hu[:, : 2 * HIDDEN]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            c = r * hu[:, 2 * HIDDEN:]
            c += g[:, 2 * HIDDEN:]
            np.tanh(c, out=c)
            new = h - c
            new *= z
            new += c
            if keep:
                kept.append((h, z, r, c, hu[:, 2 * HIDDEN:]))
            h = new
            out[t] = h
        return out, kept

    def _scan(self, x: np.ndarray, way: str) -> np.ndarray:
        """The same states as (positions, units, windows), laid out for speed when nothing is learned."""
        table, u = self.p["E" + way].T.copy(), self.p["U" + way].T.copy()
        table[: 2 * HIDDEN] *= 0.5
        u[: 2 * HIDDEN] *= 0.5
        steps, count = x.shape
        out = np.empty((steps, HIDDEN, count), np.float32)
        h = np.zeros((HIDDEN, count), np.float32)
        g, hu = np.empty((3 * HIDDEN, count), np.float32), np.empty((3 * HIDDEN, count), np.float32)
        for t in range(steps):
            np.take(table, x[t], axis=1, out=g, mode="clip")
            np.matmul(u, h, out=hu)
            gates = g[: 2 * HIDDEN]
            gates += hu[: 2 * HIDDEN]
            np.tanh(gates, out=gates)
            gates += 1
            gates *= 0.5
            c = hu[2 * HIDDEN:]
            c *= g[HIDDEN: 2 * HIDDEN]
            c += g[2 * HIDDEN:]
            np.tanh(c, out=c)
            new = out[t]
            np.subtract(h, c, out=new)
            new *= g[:HIDDEN]
            new += c
            h = new
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(positions, languages, windows) for byte windows given as (positions, windows)."""
        o = self.p["O"]
        logits = o[:HIDDEN].T @ self._scan(x, "f")
        logits += o[HIDDEN:].T @ self._scan(x[::-1], "b")[::-1]
        logits += self.p["c"][:, None]
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def _gradients(self, x: np.ndarray, way: str, kept: list, dout: np.ndarray) -> dict[str, np.ndarray]:
        """Backpropagation through time of one direction."""
        u = self.p["U" + way]
        du, dx = np.zeros_like(u), np.empty((*x.shape, 3 * HIDDEN), np.float32)
        dh = np.zeros_like(dout[0])
        for t in range(len(x) - 1, -1, -1):
            h, z, r, c, hc = kept[t]
            dh = dh + dout[t]
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (h - c) * z * (1 - z)
            dr = dc * hc * r * (1 - r)
            dx[t] = np.concatenate((dz, dr, dc), axis=1)
            dhu = np.concatenate((dz, dr, dc * r), axis=1)
            du += h.T @ dhu
            dh = dh * z + dhu @ u.T
        flat, at = dx.reshape(-1, 3 * HIDDEN), x.reshape(-1)
        de = np.stack([np.bincount(at, weights=flat[:, j], minlength=256)
                       for j in range(3 * HIDDEN)], axis=1).astype(np.float32)
        return {"E" + way: de, "U" + way: du}

    def fit(self, x: np.ndarray, labels: np.ndarray, seed: int = 22) -> "BiGRU":
        """``x``: byte windows (windows, positions); ``labels``: index of each window's language."""
        rng, adam = np.random.default_rng(seed), Adam(self.p, RATE)
        groups = [np.flatnonzero(labels == k) for k in range(len(self.languages))]
        for step in range(STEPS):
            language = rng.integers(0, len(groups), BATCH)
            chosen = np.array([groups[k][rng.integers(len(groups[k]))] for k in language])
            part = np.ascontiguousarray(x[chosen].T)
            forward, kept_f = self._states(part, "f", keep=True)
            backward, kept_b = self._states(part[::-1], "b", keep=True)
            states = np.concatenate((forward, backward[::-1]), axis=2)
            logits = states @ self.p["O"] + self.p["c"]
            logits = np.exp(logits - logits.max(axis=2, keepdims=True))
            d = logits / logits.sum(axis=2, keepdims=True)
            d[:, np.arange(BATCH), language] -= 1
            there = (part != 0)[:, :, None]
            d *= there / max(1, there.sum())
            flat = states.reshape(-1, 2 * HIDDEN)
            grads = {"O": flat.T @ d.reshape(-1, d.shape[2]), "c": d.sum(axis=(0, 1))}
            back = d @ self.p["O"].T
            grads |= self._gradients(part, "f", kept_f, back[:, :, :HIDDEN])
            grads |= self._gradients(part[::-1], "b", kept_b, back[::-1, :, HIDDEN:])
            adam.step(grads, RATE * (1 - step / STEPS) + 1e-4)
        return self

    def label(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, mean probability) of every text."""
        data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        sums = np.zeros((len(texts), len(self.languages)))
        x, sizes = windows(data)
        owner = np.repeat(np.arange(len(texts)), sizes)
        for at in range(0, len(x), BLOCK):
            part = np.ascontiguousarray(x[at: at + BLOCK].T)
            p = self.probabilities(part)
            p *= (part != 0)[:, None, :]
            np.add.at(sums, owner[at: at + BLOCK], p.sum(axis=0).T)
        out = []
        for text, s in zip(texts, sums):
            total = s.sum()
            if not total or not any(map(str.isalpha, text or "")):
                out.append((UNKNOWN, 0.0))
            else:
                best = int(s.argmax())
                out.append((self.languages[best], float(min(1.0, s[best] / total))))
        return out


def train(docs: DataFrame) -> BiGRU | None:
    """A network fitted on text and lang of documents outside the held-out fold; None without rows."""
    labelled = docs.filter(~is_held_out(F.col("doc_id"))).filter("text <> ''") \
        .select(text_id().alias("tid"), F.col("lang").alias("label"), F.octet_length("text").alias("bytes"))
    sample = bounded_sample(docs, labelled, PER_LANGUAGE, FIT_BYTES)
    languages = sorted({k for _, k in sample})
    if not languages:
        return None
    parts, labels = [], []
    for text, lang in sample:
        own, _ = windows([text.encode("utf-8", "surrogatepass")])
        parts.append(own)
        labels += [languages.index(lang)] * len(own)
    return BiGRU(languages).fit(np.concatenate(parts), np.array(labels))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    model = train(docs)

    @F.pandas_udf("lang_pred string, score double")
    def label(texts):
        import pandas as pd
        found: list[tuple[str, float]] = []
        held: list[str | None] = []
        weight = 0
        for text in texts:
            held.append(text)
            weight += len(text or "")
            if weight >= 1 << 20:
                found += model.label(held) if model else [(UNKNOWN, 0.0)] * len(held)
                held, weight = [], 0
        if held:
            found += model.label(held) if model else [(UNKNOWN, 0.0)] * len(held)
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    return docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"),
                       label("text").alias("_found")) \
        .select("doc_id", "held_out", "_found.lang_pred", "_found.score")
