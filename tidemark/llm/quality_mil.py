"""Quality by attention-based multiple-instance learning.

A text is a bag of passages of PASSAGE words.  Each passage is encoded from the mean of
its words' hashed vectors and a row of counts (repetition, letters, signs, lengths);
gated attention (a tanh and a sigmoid branch) weighs the passages, and a logistic unit
scores their weighted mean.  Only texts have labels; the weights are learned from those.
Trained in numpy on a bounded sample; scoring runs in tasks over whole texts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.llm.common import fresh_name, text_of
from tidemark.llm.labelled import training_texts
from tidemark.llm.text_arrays import (Adam, blanks, codes_of, hashes, letters, platt, runs,
                                      sigmoid)

PASSAGE = 40
#: Training texts of label 1 and 0 at most, and passages of one (evenly spaced).
GOOD_TEXTS, POOR_TEXTS, TRAIN_PASSAGES = 1500, 1500, 64
WORD_ROWS, WORD_DIM, ENCODED, ATTEND = 4096, 8, 16, 8
EPOCHS, BATCH, RATE = 8, 64, 0.01
COUNTS = 11


def passages(texts: list[str]):
    """Of every passage: its text, counts [n, COUNTS]; of every word: passage and row.

    Words are runs of anything but white space.
    """
    codes, start = codes_of(texts)
    first, last = runs(~blanks(codes))
    doc = np.searchsorted(start, first, "right") - 1
    in_doc = np.arange(len(doc)) - np.searchsorted(doc, doc)
    size = np.bincount(doc, minlength=len(texts))
    # A short rest joins the passage before it.
    n_of = np.maximum(size // PASSAGE, size > 0)
    begin = np.cumsum(n_of) - n_of
    word_p = begin[doc] + np.minimum(in_doc // PASSAGE, n_of[doc] - 1)
    n = int(n_of.sum())
    owner = np.repeat(np.arange(len(texts)), n_of)
    h = hashes(codes, first, last)
    words = np.bincount(word_p, minlength=n).astype(np.float64)

    def per_passage(x):
        return np.bincount(word_p, x, minlength=n)

    def within(flags):  # characters of each word that have a property
        c = np.concatenate([[0], np.cumsum(flags)])
        return c[last] - c[first]

    alnum = letters(codes)
    chars = (last - first).astype(np.float64)
    total = np.maximum(per_passage(chars), 1)
    upper = (codes >= 65) & (codes <= 90)
    digit = (codes >= 48) & (codes <= 57)
    distinct = np.unique(np.stack([word_p.astype(np.uint64), h], 1), axis=0)[:, 0] \
        if len(h) else np.zeros(0, np.uint64)
    again = np.concatenate([[False], (h[1:] == h[:-1]) & (word_p[1:] == word_p[:-1])]) \
        if len(h) else np.zeros(0, bool)
    signs = within(~alnum)
    w = np.maximum(words, 1)
    mean = total / w
    f = np.stack([
        np.bincount(distinct.astype(np.int64), minlength=n) / w, per_passage(again) / w,
        per_passage(signs) / total, per_passage(signs >= 2) / w, per_passage(within(digit)) / total,
        per_passage(within(upper)) / total, np.log(mean), np.log1p(w),
        np.sqrt(np.maximum(per_passage(chars ** 2) / w - mean ** 2, 0)) / 4,
        per_passage(chars == 1) / w, per_passage((signs == chars)) / w], axis=1)
    return owner, f.astype(np.float32), word_p, (h >> np.uint64(52)).astype(np.int64), words


class Model:
    def __init__(self, seed: int = 11):
        g = np.random.default_rng(seed)
        f = lambda *s, scale: (g.standard_normal(s) * scale).astype(np.float32)
        d = WORD_DIM + COUNTS
        self.p = {"words": f(WORD_ROWS, WORD_DIM, scale=0.1), "enc": f(d, ENCODED, scale=d ** -0.5),
                  "enc_b": np.zeros(ENCODED, np.float32), "v": f(ENCODED, ATTEND, scale=0.3),
                  "u": f(ENCODED, ATTEND, scale=0.3), "w": f(ATTEND, scale=0.3),
                  "out": f(ENCODED, scale=0.3), "out_b": np.zeros(1, np.float32)}
        self.mean, self.std = np.zeros(COUNTS, np.float32), np.ones(COUNTS, np.float32)
        self.scale = (1.0, 0.0)

    def inputs(self, f, word_p, row, words):
        e = np.zeros((len(f), WORD_DIM), np.float32)
        for k in range(WORD_DIM):
            e[:, k] = np.bincount(word_p, self.p["words"][row, k], minlength=len(f))
        return np.concatenate([e / np.maximum(words, 1)[:, None], (f - self.mean) / self.std],
                              axis=1).astype(np.float32)

    def forward(self, x, owner):
        """Logits of the texts that ``owner`` (sorted) names, and what the gradient needs."""
        p = self.p
        h = np.tanh(x @ p["enc"] + p["enc_b"])
        t, s = np.tanh(h @ p["v"]), sigmoid(h @ p["u"])
        e = (t * s) @ p["w"]
        at = np.flatnonzero(np.diff(owner, prepend=-1))
        bag = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(owner))))
        a = np.exp(e - np.maximum.reduceat(e, at)[bag])
        a = a / np.add.reduceat(a, at)[bag]
        z = np.add.reduceat(a[:, None] * h, at, axis=0)
        return z @ p["out"] + p["out_b"], (h, t, s, a, z, at, bag)

    def gradients(self, x, owner, y, weight):
        p = self.p
        logit, (h, t, s, a, z, at, bag) = self.forward(x, owner)
        d = (sigmoid(logit) - y) * weight
        g = {"out": z.T @ d, "out_b": d.sum(keepdims=True)}
        dz = d[:, None] * p["out"]
        da = (dz[bag] * h).sum(1)
        de = a * (da - np.add.reduceat(a * da, at)[bag])
        g["w"] = (t * s).T @ de
        dt = de[:, None] * p["w"] * s * (1 - t * t)
        ds = de[:, None] * p["w"] * t * s * (1 - s)
        g["v"], g["u"] = h.T @ dt, h.T @ ds
        dh = (a[:, None] * dz[bag] + dt @ p["v"].T + ds @ p["u"].T) * (1 - h * h)
        g["enc"], g["enc_b"] = x.T @ dh, dh.sum(0)
        return g, (dh @ p["enc"].T)[:, :WORD_DIM]

    def logits(self, texts: list[str]) -> np.ndarray:
        """nan without words."""
        out = np.full(len(texts), np.nan)
        owner, f, word_p, row, words = passages(texts)
        if len(owner):
            out[np.unique(owner)] = self.forward(self.inputs(f, word_p, row, words), owner)[0]
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        a, b = self.scale
        x = self.logits(texts)
        return np.where(np.isnan(x), 0.0, sigmoid(a * np.nan_to_num(x) + b))


def train(texts: list[str], labels: list[int], seed: int = 11) -> Model:
    y = np.array(labels, np.float64)
    m, g = Model(seed), np.random.default_rng(seed)
    owner, f, word_p, row, words = passages(texts)
    if not 0 < y.sum() < len(y) or not len(owner):
        m.scale = (0.0, float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))))
        return m
    m.mean, m.std = f.mean(0), f.std(0) + 1e-3
    bags, at = np.unique(owner, return_index=True)
    count = np.diff(np.append(at, len(owner)))
    word_at = np.searchsorted(word_p, np.arange(len(owner) + 1))
    adam = Adam(m.p, RATE)
    share = y[bags].mean()
    for epoch in range(EPOCHS):
        adam.rate = RATE * (1 - epoch / EPOCHS) + 1e-4
        order = g.permutation(np.concatenate([np.arange(len(bags))] * max(
            1, 1500 // len(bags))))
        for i in range(0, len(order), BATCH):
            c = np.unique(order[i:i + BATCH])
            own = [at[k] + np.unique(np.linspace(0, count[k] - 1, min(count[k], TRAIN_PASSAGES))
                                     .astype(int)) for k in c]
            ps = np.concatenate(own)
            bag = np.repeat(np.arange(len(c)), [len(x) for x in own])
            n = np.diff(word_at)[ps]
            wi = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) \
                + np.repeat(word_at[ps], n)
            wp = np.repeat(np.arange(len(ps)), n)
            x = m.inputs(f[ps], wp, row[wi], words[ps])
            yc = y[bags[c]]
            grads, dx = m.gradients(x, bag, yc, np.where(yc == 1, 0.5 / share,
                                                         0.5 / (1 - share)) / len(c))
            grads["words"] = np.zeros_like(m.p["words"])
            np.add.at(grads["words"], row[wi], (dx / np.maximum(words[ps], 1)[:, None])[wp])
            adam.step(grads)
    x = m.logits(texts)
    seen = ~np.isnan(x)
    m.scale = platt(x[seen], y[seen])
    return m


def fit(docs: DataFrame, labels: DataFrame, good: int = GOOD_TEXTS,
        poor: int = POOR_TEXTS) -> Model:
    """Learn from the labelled texts outside fold 0, a bounded number of each label."""
    return train(*training_texts(docs, labels, "quality", good, poor, "quality"))


def score(docs: DataFrame, model: Model, text_col: str = "text",
          out_col: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1, higher for better texts.

    Null, empty and blank texts score 0; repeated rows score alike; an empty table gives
    no rows; a clashing name gets underscores.  Without labels of both kinds every text
    with words gets the labels' share.
    """
    out = fresh_name(out_col, docs.columns)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                s = shared.value.scores(part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(s, pa.float64())],
                    [*part.schema.names[:-1], out])

    return docs.withColumn(fresh_name("text_", docs.columns), text_of(text_col)).mapInArrow(
        run, StructType([*docs.schema.fields, StructField(out, DoubleType())]))
