"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters by a learned vector (words of the training texts) beside the mean of its
character trigrams' vectors (any word).  A GRU runs over each window of words in both
directions, attention pools its states, and a logistic unit scores the window.  All
windows of WINDOW words, a new one every STRIDE, are scored, of training texts too; a
text's score is its worst window's, calibrated on the training texts.  Trained in numpy
on a bounded sample (TOXIC_TEXTS and OTHER_TEXTS at most); scoring runs in tasks over whole texts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.llm.common import fresh_name, text_of
from tidemark.llm.labelled import training_texts
from tidemark.llm.text_arrays import Adam, codes_of, hashes, letters, platt, runs, sigmoid

WINDOW, STRIDE = 48, 24
#: Training texts of label 1 and 0 at most.
TOXIC_TEXTS, OTHER_TEXTS = 1200, 2400
#: Words with a vector of their own.
VOCABULARY = 20_000
WORD_DIM, CHAR_DIM, CHAR_ROWS, HIDDEN, ATTEND = 12, 8, 4096, 8, 12
EPOCHS, BATCH, RATE = 6, 128, 0.02
#: Windows scored at a time.
AT_ONCE = 2048


def words_of(texts: list[str]):
    """Characters, and start, end, hash and text number of every word."""
    codes, start = codes_of([t.lower() for t in texts])
    first, last = runs(letters(codes))
    doc = np.searchsorted(start, first, "right") - 1
    return codes, first, last, hashes(codes, first, last), doc


def gathered(texts: list[str], at_once: int = 128):
    """Hash and text number of every word, and the distinct words by hash, a few texts at
    a time: what a training sample needs of its texts, without an array per character."""
    hs, docs, seen = [], [], {}
    for k in range(0, len(texts), at_once):
        codes, first, last, h, doc = words_of(texts[k:k + at_once])
        own, at = np.unique(h, return_index=True)
        flat = codes.tobytes()
        for w, a, b in zip(own.tolist(), first[at].tolist(), last[at].tolist()):
            if w not in seen:
                seen[w] = flat[4 * a:4 * b]
        hs.append(h)
        docs.append((doc + k).astype(np.int32))
    h = np.concatenate([*hs, np.zeros(0, np.uint64)])
    doc = np.concatenate([*docs, np.zeros(0, np.int32)])
    distinct = np.array(sorted(seen), np.uint64)
    size = np.array([len(seen[w]) // 4 for w in distinct.tolist()], np.int64)
    codes = np.frombuffer(b"".join(seen[w] for w in distinct.tolist()), "<u4")
    return h, doc, distinct, codes, np.cumsum(size) - size, np.cumsum(size)


def trigrams(codes, first, last) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the trigram table for each word (with marked ends), and where words begin."""
    n = last - first
    begin = np.cumsum(n) - n
    at = np.arange(int(n.sum())) - np.repeat(begin, n)
    pos = at + np.repeat(first, n)
    size = np.repeat(n, n)
    c = codes[pos].astype(np.uint64)
    left = np.where(at > 0, codes[np.maximum(pos - 1, 0)], 1).astype(np.uint64)
    right = np.where(at < size - 1, codes[np.minimum(pos + 1, len(codes) - 1)], 2
                     ).astype(np.uint64)
    h = (left * np.uint64(0x9E3779B97F4A7C15) ^ c) * np.uint64(0xBF58476D1CE4E5B9) ^ right
    h = h * np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(52)).astype(np.int32), begin


def windows(doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and text of every window; the last one of a text ends where it ends."""
    count = np.bincount(doc, minlength=n_docs)
    begin = np.cumsum(count) - count
    n = np.where(count == 0, 0, 1 + np.ceil(np.maximum(count - WINDOW, 0) / STRIDE)).astype(int)
    owner = np.repeat(np.arange(n_docs), n)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    first = np.minimum(k * STRIDE, np.maximum(count[owner] - WINDOW, 0)) + begin[owner]
    return first, owner


class Network:
    """Parameters ``p``, the vocabulary's sorted hashes and the calibration."""

    def __init__(self, vocabulary: np.ndarray, hint: np.ndarray, seed: int = 7):
        g = np.random.default_rng(seed)
        f = lambda *s, scale=1.0: (g.standard_normal(s) * scale).astype(np.float32)
        self.vocabulary, self.scale = vocabulary, (1.0, 0.0)
        d, h = WORD_DIM + CHAR_DIM, HIDDEN
        words = f(len(vocabulary) + 1, WORD_DIM, scale=0.1)
        words[:-1, 0], words[-1] = hint, 0
        self.p = {"words": words, "chars": f(CHAR_ROWS, CHAR_DIM, scale=0.1),
                  "in": f(d, 6 * h, scale=d ** -0.5), "bias": np.zeros(6 * h, np.float32),
                  "rec": f(2, h, 3 * h, scale=h ** -0.5), "att": f(2 * h, ATTEND, scale=0.3),
                  "att_v": f(ATTEND, scale=0.3), "out": f(2 * h, scale=0.3),
                  "out_b": np.zeros(1, np.float32)}

    def rows(self, word_hash: np.ndarray) -> np.ndarray:
        v = self.vocabulary
        if not len(v):
            return np.zeros(len(word_hash), np.int64)
        i = np.minimum(np.searchsorted(v, word_hash), len(v) - 1)
        return np.where(v[i] == word_hash, i, len(v))

    def embedded(self, rows, tri, begin, n_tri):
        """Input vectors of distinct words."""
        chars = np.stack([np.add.reduceat(self.p["chars"][tri, k], begin) / n_tri
                          for k in range(CHAR_DIM)], 1) \
            if len(begin) else np.zeros((0, CHAR_DIM), np.float32)
        return np.concatenate([self.p["words"][rows], chars], axis=1).astype(np.float32)

    def forward(self, x: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows; ``x``: projected distinct words, ids and mask [windows, T]."""
        n, T = ids.shape
        h_dim, p = HIDDEN, self.p
        h = np.zeros((2, n, h_dim), np.float32)
        states = np.zeros((T, n, 2 * h_dim), np.float32)
        tape = []
        half = x.reshape(len(x), 2, 3 * h_dim)
        for t in range(T):
            ts = (t, T - 1 - t)
            xt = np.stack([half[ids[:, ts[0]], 0], half[ids[:, ts[1]], 1]])
            m = np.stack([mask[:, ts[0]], mask[:, ts[1]]])[:, :, None]
            g = h @ p["rec"]
            zr = 1 / (1 + np.exp(-(xt[..., :2 * h_dim] + g[..., :2 * h_dim])))
            z, r = zr[..., :h_dim], zr[..., h_dim:]
            c = np.tanh(xt[..., 2 * h_dim:] + r * g[..., 2 * h_dim:])
            new = h + m * (1 - z) * (c - h)
            if keep:
                tape.append((h, z, r, c, g[..., 2 * h_dim:], m))
            h = new
            states[ts[0], :, :h_dim], states[ts[1], :, h_dim:] = h[0], h[1]
        u = np.tanh(states @ p["att"])
        e = u @ p["att_v"] + np.where(mask.T, 0, -1e9)
        a = np.exp(e - e.max(0))
        a = (a / a.sum(0)).astype(np.float32)
        pooled = np.einsum("tn,tnh->nh", a, states)
        logit = pooled @ p["out"] + p["out_b"]
        return (logit, (states, u, a, pooled, tape)) if keep else logit

    def gradients(self, e, x, ids, mask, y, weight):
        """Gradients of the weighted log loss; also of the distinct words' inputs."""
        p, h_dim, (n, T) = self.p, HIDDEN, ids.shape
        logit, (states, u, a, pooled, tape) = self.forward(x, ids, mask, keep=True)
        d = ((sigmoid(logit) - y) * weight).astype(np.float32)
        g = {"out": pooled.T @ d, "out_b": d.sum(keepdims=True)}
        d_pool = d[:, None] * p["out"]
        d_a = np.einsum("nh,tnh->tn", d_pool, states)
        d_e = a * (d_a - (a * d_a).sum(0))
        g["att_v"] = np.einsum("tn,tna->a", d_e, u)
        d_u = d_e[:, :, None] * p["att_v"] * (1 - u * u)
        g["att"] = np.einsum("tnh,tna->ha", states, d_u)
        d_states = a[:, :, None] * d_pool + d_u @ p["att"].T
        d_rec = np.zeros_like(p["rec"])
        d_x = np.zeros((len(x), 2, 3 * h_dim), np.float32)
        dh = np.zeros((2, n, h_dim), np.float32)
        for t in range(T - 1, -1, -1):
            h, z, r, c, gn, m = tape[t]
            ts = (t, T - 1 - t)
            dh = dh + np.stack([d_states[ts[0], :, :h_dim], d_states[ts[1], :, h_dim:]])
            dc = dh * m * (1 - z) * (1 - c * c)
            dz = -dh * m * (c - h) * z * (1 - z)
            dr = dc * gn * r * (1 - r)
            d_in = np.concatenate([dz, dr, dc], axis=2)
            d_g = np.concatenate([dz, dr, dc * r], axis=2)
            d_rec += np.einsum("dnh,dng->dhg", h, d_g)
            dh = dh * (1 - m * (1 - z)) + d_g @ p["rec"].transpose(0, 2, 1)
            for k in (0, 1):
                np.add.at(d_x[:, k], ids[:, ts[k]], d_in[k])
        d_x = d_x.reshape(len(x), -1)
        g |= {"rec": d_rec, "bias": d_x.sum(0), "in": e.T @ d_x}
        return g, d_x @ p["in"].T

    def project(self, e):
        return (e @ self.p["in"] + self.p["bias"]).astype(np.float32)

    def worst(self, texts: list[str]) -> np.ndarray:
        """The highest window logit of each text; nan without words."""
        out = np.full(len(texts), np.nan)
        codes, first, last, h, doc = words_of(texts)
        if not len(h):
            return out
        _, at, inverse = np.unique(h, return_index=True, return_inverse=True)
        x = self.project(self.embedded(self.rows(h[at]), *self._spelling(codes, first, last, at)))
        start, owner = windows(doc, len(texts))
        logits = np.concatenate([
            self.forward(x, *_grid(inverse, doc, start[k:k + AT_ONCE]))
            for k in range(0, len(start), AT_ONCE)])
        np.fmax.at(out, owner, logits)
        return out

    @staticmethod
    def _spelling(codes, first, last, at):
        tri, begin = trigrams(codes, first[at], last[at])
        return tri, begin, (last - first)[at].astype(np.float32)

    def scores(self, texts: list[str]) -> np.ndarray:
        a, b = self.scale
        x = self.worst(texts)
        return np.where(np.isnan(x), 0.0, sigmoid(a * np.nan_to_num(x) + b))


def _grid(inverse, doc, start):
    """Word numbers and mask of windows; beyond a text's end the mask is False."""
    i = start[:, None] + np.arange(WINDOW)
    j = np.minimum(i, len(doc) - 1)
    mask = (i < len(doc)) & (doc[j] == doc[np.minimum(start, len(doc) - 1)][:, None])
    return np.where(mask, inverse[j], 0), mask


def train(texts: list[str], labels: list[int], seed: int = 7) -> Network:
    """Fit on texts; a text is as toxic as its worst window, so only that one of a toxic
    text is taught (all of them at first), and the worst and a random one of the others."""
    y = np.array(labels, np.float32)
    h, doc, distinct, codes, first, last = gathered(texts)
    inverse = np.searchsorted(distinct, h).astype(np.int32)
    pairs = np.unique(doc.astype(np.int64) * max(len(distinct), 1) + inverse)
    d, w = pairs // max(len(distinct), 1), pairs % max(len(distinct), 1)
    df = np.bincount(w, minlength=len(distinct))
    pos = np.bincount(w, y[d] if len(d) else None, minlength=len(distinct))
    order = np.argsort(-df, kind="stable")[:VOCABULARY]
    chosen = np.sort(order[df[order] >= 5])
    rate = (pos[chosen] + 0.5) / (df[chosen] - pos[chosen] + 0.5) \
        * (len(y) - y.sum() + 1) / (y.sum() + 1)
    net = Network(distinct[chosen], np.clip(np.log(rate), -3, 3).astype(np.float32), seed)
    if not 0 < y.sum() < len(y) or not len(h):
        net.scale = (0.0, float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))))
        return net
    rows = net.rows(distinct)
    tri, begin, n_tri = net._spelling(codes, first, last, slice(None))
    start, owner = windows(doc, len(texts))
    g = np.random.default_rng(seed)
    adam = Adam(net.p, RATE)

    def logits():
        x = net.project(net.embedded(rows, tri, begin, n_tri))
        return np.concatenate([net.forward(x, *_grid(inverse, doc, start[i:i + AT_ONCE]))
                               for i in range(0, len(start), AT_ONCE)])

    for epoch in range(EPOCHS):
        score = logits() if epoch else g.random(len(start))
        by_score = np.lexsort((-score, owner))
        worst = by_score[np.flatnonzero(np.diff(owner[by_score], prepend=-1))]
        shuffled = g.permutation(len(owner))
        other = shuffled[np.unique(owner[shuffled], return_index=True)[1]]
        other = other[(y[owner[other]] == 0) | (epoch == 0)]
        chosen = np.concatenate([worst, other])
        chosen = np.concatenate([chosen] * max(1, 6000 // max(len(chosen), 1)))
        chosen = g.permutation(chosen)
        share = y[owner[chosen]].mean()
        adam.rate = RATE * (1 - epoch / EPOCHS) + 1e-3
        for i in range(0, len(chosen), BATCH):
            c = chosen[i:i + BATCH]
            ids, mask = _grid(inverse, doc, start[c])
            used, local = np.unique(ids, return_inverse=True)
            # Spelling of the words in this batch.
            n = n_tri[used].astype(np.int64)
            own = np.cumsum(n) - n
            t = tri[np.arange(int(n.sum())) - np.repeat(own, n) + np.repeat(begin[used], n)]
            e = net.embedded(rows[used], t, own, n_tri[used])
            yc = y[owner[c]]
            weight = np.where(yc == 1, 0.5 / share, 0.5 / (1 - share)) / len(c)
            grads, d_e = net.gradients(e, net.project(e), local.reshape(ids.shape), mask, yc,
                                       weight)
            grads["words"] = np.zeros_like(net.p["words"])
            np.add.at(grads["words"], rows[used], d_e[:, :WORD_DIM])
            grads["words"][-1] = 0
            grads["chars"] = np.zeros_like(net.p["chars"])
            np.add.at(grads["chars"], t, np.repeat(d_e[:, WORD_DIM:] / n_tri[used][:, None],
                                                   n, axis=0))
            adam.step(grads)
    final = logits()
    top = np.full(len(texts), -np.inf)
    np.maximum.at(top, owner, final)
    seen = np.isfinite(top)
    net.scale = platt(top[seen], y[seen])
    return net


def fit(docs: DataFrame, labels: DataFrame, toxic_texts: int = TOXIC_TEXTS,
        other_texts: int = OTHER_TEXTS) -> Network:
    """Learn from the labelled texts outside fold 0, a bounded number of each label."""
    return train(*training_texts(docs, labels, "toxic", toxic_texts, other_texts, "toxicity"))


def score(docs: DataFrame, net: Network, text_col: str = "text",
          out_col: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 (a clashing name gets underscores).

    Null and empty texts and texts without a letter or digit score 0; repeated rows score
    alike; an empty table gives no rows; without labels of both kinds every text with
    words gets the labels' share.
    """
    out = fresh_name(out_col, docs.columns)
    shared = docs.sparkSession.sparkContext.broadcast(net)

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


def clean(docs: DataFrame, net: Network, threshold: float = 0.5) -> DataFrame:
    """The rows that score below ``threshold``, with the columns they had."""
    out = fresh_name("score", docs.columns)
    return score(docs, net).where(F.col(out) < threshold).select(*docs.columns)
