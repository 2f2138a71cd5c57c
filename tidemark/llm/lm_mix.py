"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A text is its words and an end mark.  A word of the vocabulary (the commonest of the
training part, seen twice at least) is the bits of its Huffman code, any other an escape
and then its bytes and a space, by a Huffman code of the corpus' bytes.  Bits of words are
predicted by how often the words occur, by counts under the word before and by counts
under the two words before; spelled bits by counts under the last byte, the last three and
all of the word so far.  The contexts of words reach across spaces from the first word of
a text to its end mark; counts come from all training texts, whole.

The predictors' logits are added with weights that a gate chooses by how much each has
seen.  Online, each text corrects that sum by weights of its own (one set for words, one
for spelled bits) that learn from every bit, and an adaptive table refines the result.
Both adapt from a text's first bit to its last, after every STEP bits; texts run side by
side as lanes, and a score depends on nothing but the model and the text.  The sum of log2
of the bits' probabilities is the text's size in bits.

The gate's weights are learned in tasks on one in TUNING training texts, chosen by a hash
of the id and taken whole, against tables that leave those texts out; the tables that
score hold every training text.  Tables have a fixed number of slots (the model's memory).
"""

from __future__ import annotations

import heapq
from functools import lru_cache
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_fold, written

END = 256
#: Slots of each spelling predictor's table, as powers of two (bounds the broadcast).
SLOT_BITS = (16, 20, 22)
#: Slots under the word before and under the two words before, as powers of two.
WORD_BITS = (22, 22)
BLOCK = 1 << 16
#: Bits after which a text's weights and its refining table learn.
STEP = 128
#: Bits of a column of places in `mixed`.
SEGMENT = 1024
#: Words whose bits a worker mixes at a time, and those it looks up at a time.
PART, SLICE = 1 << 19, 1 << 12
#: Bytes of texts that are scored side by side.
GROUP = 3 << 20
#: Bytes whose words are hashed at a time.
HASHED = 1 << 20
#: One in so many training texts teaches the gate's weights.
TUNING = 5
#: Newton steps at most, their largest change of a weight, the change that ends them and
#: the pull towards the starting weights (in bits seen).
STEPS, LEAP, STILL, PULL = 12, 1.0, 2e-3, 20.0
#: Commonest words whose counts go to every task; the rest is joined.
COMMON_WORDS = 1 << 18
#: Cells per predictor of the counts that the gate learns from, one logit wide.
BINS = 16
#: A step's bits may all meet one entry of a refining table, so STEP * REFINE is below 1.
RATE, REFINE, GATES, BUCKETS = 0.004, 0.0075, 64, 24
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0xD6E8FEB86659FD93)]
#: A-Z in lower case, white space as a space.
_FOLD = bytes(x + 32 if 65 <= x <= 90 else 32 if 9 <= x <= 13 else x for x in range(256))


class Words:
    """Words of a batch of texts in order, an end mark (empty) after each text's: bytes,
    spans, text numbers and hashes."""

    def __init__(self, texts: list[bytes]):
        n = len(texts)
        size = np.array([len(t) for t in texts], np.int64)
        self.data = np.frombuffer(b" ".join([*texts, b""]).translate(_FOLD), np.uint8)
        start = np.cumsum(size + 1) - size - 1
        word = self.data != 32
        edge = np.flatnonzero(word[1:] != word[:-1]) + 1
        if len(word) and word[0]:
            edge = np.concatenate([[0], edge])
        first, last = edge[::2], edge[1::2]
        doc = np.searchsorted(start, first, "right") - 1
        put = np.searchsorted(doc, np.arange(n), "right")
        self.first = np.insert(first, put, start + size)
        self.last = np.insert(last, put, start + size)
        self.doc = np.insert(doc, put, np.arange(n))
        self.hash = hashes_of(self.data, self.first, self.last)

    def before(self) -> tuple[np.ndarray, np.ndarray]:
        """The word before and the two before, in 32 bits."""
        past = np.concatenate([np.zeros(2, np.uint64), self.hash])
        doc = np.concatenate([[-1, -1], self.doc])
        one = np.where(doc[1:-1] == self.doc, past[1:-1], np.uint64(0))
        two = np.where(doc[:-2] == self.doc, past[:-2], np.uint64(0))
        return _short(one * _M[1]), _short((one * _M[1] + two) * _M[2])


def binaries(data, first, last):
    """An Arrow array of the spans' bytes."""
    import pyarrow as pa

    n = last - first
    to = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(to[-1]) + np.repeat(first - to[:-1], n)
    return pa.Array.from_buffers(pa.binary(), len(n), [
        None, pa.py_buffer(to.astype(np.int32)), pa.py_buffer(data[at])])


class Code:
    """A Huffman code of 257 symbols: their paths (2 * node + bit), starts and lengths."""

    def __init__(self, counts: np.ndarray):
        heap = [(int(c) + 1, i, i) for i, c in enumerate(counts)]
        heapq.heapify(heap)
        kids, n = {}, len(counts)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            kids[n] = (a[2], b[2])
            heapq.heappush(heap, (a[0] + b[0], n, n))
            n += 1
        paths, stack = {}, [(n - 1, ())]
        while stack:
            node, path = stack.pop()
            if node in kids:
                for bit, kid in enumerate(kids[node]):
                    stack.append((kid, (*path, (node - len(counts), bit))))
            else:
                paths[node] = path
        self.length = np.array([len(paths[i]) for i in range(len(counts))], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.path = np.array([2 * node + bit for i in range(len(counts))
                              for node, bit in paths[i]], np.uint32)


def symbols(data: np.ndarray, first: np.ndarray, last: np.ndarray):
    """Symbols of words (bytes, then a space) and where each word starts; an empty word
    is the end mark."""
    n = last - first
    size = n + 1
    start = np.concatenate([[0], np.cumsum(size)])
    out = np.repeat(np.where(n > 0, 32, END), size)
    at = np.arange(start[-1]) - np.repeat(start[:-1], size)
    inside = at < np.repeat(n, size)
    out[inside] = data[(np.repeat(first, size) + at)[inside]]
    return out, start, at


def bits_of(path, start, n):
    """Nodes and bits of the paths [start, start + n) in a row."""
    to = np.cumsum(n)
    places = np.repeat(start - (to - n), n)
    places += np.arange(len(places))
    steps = path.take(places)
    return steps >> np.uint32(1), (steps & np.uint32(1)).astype(np.uint8)


def hashed(context, n, node, bits: int):
    """Slots of bits under contexts (32 bits, of n bits each) and nodes."""
    h = np.repeat(context, n)
    h += node * np.uint32(0x9E3779B1)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x27D4EB2F)
    h >>= np.uint32(32 - bits)
    return h.astype(np.int64)


def _short(h):
    """32 bits of 64-bit contexts."""
    return ((h ^ (h >> np.uint64(29))) * _M[0] >> np.uint64(32)).astype(np.uint32)


def slots_of(code: Code, s: np.ndarray, at: np.ndarray):
    """Bits of spelled words' symbols, their slots and the number of bits before each."""
    past = [np.where(at >= k, np.concatenate([np.zeros(k, np.int64), s[:-k]])[:len(s)] + 1, 0)
            for k in (1, 2, 3)]
    term = (s.astype(np.uint64) + np.uint64(1)) * (_M[0] * (at.astype(np.uint64) * _M[1]
                                                            | np.uint64(1)))
    total = np.concatenate([[np.uint64(0)], np.cumsum(term)])[:-1]
    prefix = (total - total[np.arange(len(s)) - at]) * _M[2]
    three = (past[0] | (past[1] << 9) | (past[2] << 18)).astype(np.uint64) * _M[1]
    n = code.length[s]
    node, bit = bits_of(code.path, code.start[s], n)
    last = np.repeat(past[0].astype(np.uint32) << np.uint32(8), n)
    slots = [((last | node) & np.uint32(0xFFFF)).astype(np.int64),
             hashed(_short(three), n, node, SLOT_BITS[1]),
             hashed(_short(prefix), n, node, SLOT_BITS[2])]
    return bit, slots, np.concatenate([[0], np.cumsum(n)])


_BASE = np.concatenate([[0], np.cumsum([1 << b for b in SLOT_BITS])])


def _joined_words(words: list[bytes]):
    data = np.frombuffer(b" ".join(words), np.uint8)
    n = np.array([len(w) for w in words], np.int64)
    first = np.cumsum(n + 1) - n - 1
    return data, first, first + n


def byte_counts(words: DataFrame) -> np.ndarray:
    """How often each symbol occurs; ``words`` has w (binary) and n."""
    def run(batches):
        import pyarrow as pa

        total = np.zeros(257)
        for b in batches:
            s, start, _ = symbols(*_joined_words(b.column("w").to_pylist()))
            total += np.bincount(s, np.repeat(b.column("n").to_numpy(), np.diff(start)),
                                 minlength=257)
        yield pa.RecordBatch.from_pydict({"s": pa.array(range(257), pa.int32()),
                                          "n": pa.array(total, pa.float64())})

    out = np.zeros(257)
    for r in words.mapInArrow(run, "s int, n double").groupBy("s").sum("n").collect():
        out[r[0]] = r[1]
    return out


def packed(x: np.ndarray) -> bytes:
    """Counts in the fewest bytes each, compressed."""
    import pyarrow as pa

    kind = np.min_scalar_type(int(x.max(initial=0)))
    return bytes([kind.itemsize]) + pa.Codec("zstd", 1).compress(
        x.astype(kind).tobytes(), asbytes=True)


def add_packed(total: np.ndarray, b: bytes) -> None:
    import pyarrow as pa

    x = pa.Codec("zstd").decompress(memoryview(b)[1:], len(total) * b[0])
    total += np.frombuffer(x, f"<u{b[0]}")


COUNTS = "block int, tune boolean, counts binary"


def count_blocks(table: np.ndarray, tune: bool):
    """Rows of COUNTS of a task's table: twice BLOCK counts each (0 and 1 by slot)."""
    import pyarrow as pa

    for k, x in enumerate(table.reshape(-1, 2 * BLOCK)):
        if x.any():
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([k], pa.int32()), "tune": pa.array([tune], pa.bool_()),
                "counts": pa.array([packed(x)], pa.binary())})


def summed(counts: DataFrame, slots: int) -> np.ndarray:
    """Of all slots logit (1/512) and trust (0 to 3), as logit * 4 | trust, from rows of
    COUNTS: without the tuning texts' counts, and with them."""
    def add(batches):
        import pyarrow as pa

        total: dict = {}
        for b in batches:
            for k, tune, x in zip(*[c.to_pylist() for c in b.columns]):
                add_packed(total.setdefault(k, np.zeros((2, 2 * BLOCK), np.uint64))[int(tune)], x)
        for k, x in total.items():
            body = b""
            for n in (x[0], x[0] + x[1]):
                n = n.reshape(-1, 2).astype(float)
                logit = np.log((n[:, 1] + 0.4) / (n[:, 0] + 0.4))
                n = n.sum(1)
                trust = (n > 0).astype(np.int16) + (n > 3) + (n > 30)
                logit = np.round(np.clip(logit, -8, 8) * 512).astype(np.int16)
                body += (logit * 4 | trust).astype("<i2").tobytes()
            yield pa.RecordBatch.from_pydict({"block": pa.array([k], pa.int32()),
                                              "counts": pa.array([body], pa.binary())})

    out = np.zeros((2, slots), np.int16)
    for r in (counts.repartition("block").mapInArrow(add, "block int, counts binary")
              .collect()):
        out[:, r[0] * BLOCK:(r[0] + 1) * BLOCK] = np.frombuffer(r[1], "<i2").reshape(2, -1)
    return out


def spelling_tables(words: DataFrame, code: Code) -> np.ndarray:
    """What `summed` gives, of words (w, n and, of these, t in tuning texts)."""
    shared = words.sparkSession.sparkContext.broadcast(code)

    def count(batches):
        import pyarrow as pa

        tables = [np.zeros(2 * _BASE[-1], np.int32) for _ in range(2)]
        for own in grouped(batches, "w", GROUP >> 5):
            b = pa.Table.from_batches(own)
            s, start, at = symbols(*_joined_words(b.column("w").to_pylist()))
            bit, slots, cut = slots_of(shared.value, s, at)
            n, t = (b.column(c).to_numpy() for c in ("n", "t"))
            for table, own in ((tables[0], n - t), (tables[1], t)):
                own = np.repeat(own.astype(np.int32), np.diff(cut[start]))
                some = np.flatnonzero(own)
                for k, x in enumerate(slots):
                    np.add.at(table, 2 * (_BASE[k] + x[some]) + bit[some], own[some])
        for tune, table in enumerate(tables):
            yield from count_blocks(table, bool(tune))

    return summed(words.mapInArrow(count, COUNTS), _BASE[-1])


def bit_tables(words: DataFrame, code: Code) -> tuple[np.ndarray, np.ndarray]:
    """Logits (1/512) and trust (0 to 3) of all slots, from every word and its count."""
    words = words.select("w", "n", F.lit(0).cast("bigint").alias("t"))
    return unpacked(spelling_tables(words, code)[1])


def unpacked(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return x >> 2, (x & 3).astype(np.uint8)


def count_cells(total, xs, gate, bit, weight=1.0) -> None:
    """Add bits to their counts by gate, the three logits in bins, and bit."""
    at = gate
    for x in xs:
        at = at * BINS
        at += np.clip(x + np.float32(BINS / 2), 0, BINS - 1).astype(np.int64)
    np.add.at(total, 2 * at + bit, weight)


def fitted(cells: DataFrame, start: np.ndarray) -> np.ndarray:
    """The gate's weights, by Newton steps on the sums of cells (k, x)."""
    total = np.zeros((GATES, BINS ** 3, 2))
    sums = cells.groupBy("k").agg(F.sum("x").alias("x")).toArrow()
    total.reshape(-1)[sums.column("k").to_numpy()] = sums.column("x").to_numpy()
    mid = np.arange(BINS) - BINS / 2 + 0.5
    x = np.stack([*[a.ravel() for a in np.meshgrid(mid, mid, mid, indexing="ij")],
                  np.full(BINS ** 3, 0.3)], 1)
    now = start.astype(np.float64)
    for g in range(GATES):
        used = np.flatnonzero(total[g].any(1))
        own, n = x[used], total[g][used]
        for _ in range(STEPS):
            p = 1 / (1 + np.exp(-np.clip(own @ now[g], -30, 30)))
            grad = own.T @ (n.sum(1) * p - n[:, 1]) + PULL * (now[g] - start[g])
            curve = (own * (n.sum(1) * p * (1 - p))[:, None]).T @ own + PULL * np.eye(4)
            step = np.linalg.solve(curve, grad)
            step *= min(1, LEAP / max(np.abs(step).max(), 1e-9))
            now[g] -= step
            if np.abs(step).max() < STILL:
                break
    return now.astype(np.float32)


def cell_rows(total: np.ndarray):
    import pyarrow as pa

    at = np.flatnonzero(total)
    return pa.RecordBatch.from_pydict({"k": pa.array(at, pa.int32()),
                                       "x": pa.array(total[at], pa.float64())})


#: The input whose weight is a gate's bias.
BIAS = np.float32(0.3)


def taken(table, base, slots) -> list:
    """The slots' entries under each context."""
    return [table[base[k]:base[k + 1]].take(at) for k, at in enumerate(slots)]


def as_logits(v):
    """Logits of a table's entries; trust, in the lowest two bits, adds less than 0.0015."""
    x = v.astype(np.float32)
    x *= np.float32(1 / 2048)
    return x


def looked_up(entries):
    """Logits under each context and the gate, which is their trust."""
    gate = np.int16(0)
    for k, v in enumerate(entries):
        gate = gate | (v & np.int16(3)) << np.int16(2 * k)
    return [as_logits(v) for v in entries], gate.astype(np.int64)


def gated(weights, xs, gate):
    """The logits' weighted sum."""
    q = weights[:, 3].take(gate) * BIAS
    for k, x in enumerate(xs):
        q += weights[:, k].take(gate) * x
    return q


class Model:
    """Code, tables and the gate's weights; about 10 MB."""

    def __init__(self, code: Code, logit: np.ndarray, trust: np.ndarray):
        self.code, self.table = code, logit * np.int16(4) | trust.astype(np.int16)
        self.weights = np.zeros((GATES, 4), np.float32)
        g = np.arange(GATES)
        self.weights[:, 0] = 0.3
        self.weights[:, 1] = np.array([0, 0.1, 0.3, 0.4])[(g >> 2) & 3]
        self.weights[:, 2] = np.array([0, 0.4, 0.7, 0.9])[g >> 4]

    def logits(self, data, first, last):
        """Of distinct words: bits, the three logits, gate, and each word's first bit."""
        s, start, at = symbols(data, first, last)
        bit, slots, cut = slots_of(self.code, s, at)
        xs, gate = looked_up(taken(self.table, _BASE, slots))
        return bit, xs, gate, cut[start]

    def inputs(self, data, first, last):
        """What `logits` gives, with the logits and the bias in columns."""
        bit, xs, gate, cut = self.logits(data, first, last)
        return bit, np.stack([*xs, np.full(len(bit), BIAS)], 1), gate, cut

    def spelled(self, data, first, last):
        """Of distinct words: summed and longest logits, bits, each word's first bit."""
        dot, longest, bits, size = [], [], [], [np.zeros(1, np.int64)]
        for a in range(0, len(first), SLICE // 4):
            z = slice(a, a + SLICE // 4)
            bit, xs, gate, cut = self.logits(data, first[z], last[z])
            dot.append(gated(self.weights, xs, gate))
            longest.append(xs[2])
            bits.append(bit)
            size.append(np.diff(cut))
        # Places beyond the last bit are what lanes are filled up with.
        end = np.zeros(STEP, np.float32)
        return (np.concatenate([*dot, end]), np.concatenate([*longest, end]),
                np.concatenate([*bits, end.astype(np.uint8)]), np.cumsum(np.concatenate(size)))


def learn(words: DataFrame, model: Model) -> None:
    """Fit the gate's weights to words (w, n): tasks count bits in cells, Newton steps
    follow on their sums."""
    shared = words.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        total = np.zeros(2 * GATES * BINS ** 3)
        for b in batches:
            bit, xs, gate, cut = shared.value.logits(*_joined_words(b.column("w").to_pylist()))
            n = np.repeat(b.column("n").to_numpy(), np.diff(cut)).astype(float)
            count_cells(total, xs, gate, bit, n)
        yield cell_rows(total)

    model.weights = fitted(words.mapInArrow(run, "k int, x double"), model.weights)
    shared.destroy()


class WordCode:
    """A Huffman code of the vocabulary and an escape: the symbols' paths (2 * node + bit),
    where each begins, and the nodes' logits by the counts without tuning texts and all."""

    def __init__(self, counts: np.ndarray, rest: np.ndarray):
        n = len(counts)
        order = np.argsort(counts, kind="stable")
        # The lightest two of the leaves and of the nodes made so far, both in order.
        leaves, made = (counts[order] + 1).tolist(), []
        parent, side = np.zeros(2 * n - 1, np.int32), np.zeros(2 * n - 1, np.uint8)
        order, pairs = order.tolist(), np.zeros((n - 1, 2), np.int32)
        leaf = inner = 0
        for k in range(n - 1):
            weight = 0
            for j in (0, 1):
                if inner == len(made) or leaf < n and leaves[leaf] <= made[inner]:
                    weight += leaves[leaf]
                    pairs[k, j] = order[leaf]
                    leaf += 1
                else:
                    weight += made[inner]
                    pairs[k, j] = n + inner
                    inner += 1
            made.append(weight)
        parent[pairs] = np.arange(n, 2 * n - 1, dtype=np.int32)[:, None]
        side[pairs[:, 1]] = 1
        up, on, steps = np.arange(n, dtype=np.int32), np.arange(n, dtype=np.int32), []
        while len(on := on[up[on] != 2 * n - 2]):
            steps.append((on, parent[up[on]] - n, side[up[on]]))
            up[on] = parent[up[on]]
        self.length = np.zeros(n, np.int64)
        for on, _, _ in steps:
            self.length[on] += 1
        self.start = np.cumsum(self.length) - self.length
        # Places beyond the last symbol's are what lanes are filled up with.
        self.path = np.zeros(int(self.length.sum()) + STEP, np.uint32)
        for k, (on, node, bit) in enumerate(steps):
            self.path[(self.start + self.length - 1 - k)[on]] = 2 * node + bit
        self.logits = []
        for c in (rest, counts):
            total = [*c.tolist(), *[0] * len(pairs)]
            seen = np.zeros((max(len(pairs), 1), 2))
            for k, (a, b) in enumerate(pairs.tolist()):
                total[n + k] = total[a] + total[b]
                seen[k] = total[a], total[b]
            logit = np.log((seen[:, 1] + 0.4) / (seen[:, 0] + 0.4))
            self.logits.append(np.clip(logit, -8, 8).astype(np.float32))


class Vocabulary:
    """Hashes of the commonest words in order, their counts, their code with an escape."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, tuned: np.ndarray,
                 total: int, total_tuned: int):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order]
        tuned = tuned[order]
        self.code = WordCode(
            np.append(self.counts, total - self.counts.sum()),
            np.append(self.counts - tuned, total - total_tuned - (self.counts - tuned).sum()))
        edge = np.searchsorted(self.keys >> np.uint64(44), np.arange((1 << 20) + 1))
        self.edge, self.depth = edge.astype(np.int32), int(np.diff(edge).max())

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Numbers of words by their hashes; others get the escape's."""
        out = np.full(len(h), len(self.keys))
        if not len(self.keys):
            return out
        at = self.edge[(h >> np.uint64(44)).astype(np.int64)].astype(np.int64)
        left = np.arange(len(h))
        for k in range(self.depth):
            i = np.minimum(at[left] + k, len(self.keys) - 1)
            hit = self.keys[i] == h[left]
            out[left[hit]] = i[hit]
            left = left[~hit]
        return out

    def slots(self, start, n, before):
        """Nodes and bits of words' codes, and their slots under both contexts."""
        node, bit = bits_of(self.code.path, start, n)
        return node, bit, [hashed(c, n, node, b) for c, b in zip(before, WORD_BITS)]

    def sliced(self, number, before):
        """`slots` of words' codes, a slice of the words at a time."""
        for a in range(0, len(number), SLICE):
            z = slice(a, a + SLICE)
            yield self.slots(self.code.start[number[z]], self.code.length[number[z]],
                             [c[z] for c in before])


def laid_out(start, n, lane, lanes: int):
    """Starts and sizes of items in a row, lane by lane, where one more fills each lane up to
    whole steps; where those were put in, the lanes' first entries and sizes without."""
    bits = np.bincount(lane, n, lanes).astype(np.int64)
    fill = -bits % STEP
    put = np.searchsorted(lane, np.arange(lanes), "right")
    return (np.insert(start, put, 0), np.insert(n, put, fill), put,
            np.cumsum(bits + fill) - bits - fill, bits)


_WORD_BASE = np.concatenate([[0], np.cumsum([1 << b for b in WORD_BITS])])


def word_tables(texts: DataFrame, words: Vocabulary) -> np.ndarray:
    """Logits and trust (logit * 4 | trust) of the words' slots, from every training text:
    without the tuning texts, and with them.  ``texts`` has t (binary) and tune."""
    shared = texts.sparkSession.sparkContext.broadcast(words)

    def count(tune: bool):
        def run(batches):
            v = shared.value
            table = np.zeros(2 * _WORD_BASE[-1], np.int32)
            for own in grouped(batches, "t", HASHED):
                w = Words([t for b in own for t in b.column("t").to_pylist()])
                number, before = v.numbers(w.hash), w.before()
                for _, bit, slots in v.sliced(number, before):
                    for k, at in enumerate(slots):
                        at += _WORD_BASE[k]
                        at *= 2
                        at += bit
                        np.add.at(table, at, np.int32(1))
            yield from count_blocks(table, tune)
        return run

    # A task sends a whole table, so each takes several partitions where there are many.
    tasks = max(texts.sparkSession.sparkContext.defaultParallelism,
                texts.rdd.getNumPartitions() // 4)
    both = [texts.where("tune" if tune else "not tune").select("t").coalesce(tasks)
            .mapInArrow(count(tune), COUNTS) for tune in (False, True)]
    out = summed(both[0].union(both[1]), _WORD_BASE[-1])
    shared.destroy()
    return out


class TextModel:
    """Vocabulary and word tables, the gate's weights, and what spells other words."""

    def __init__(self, words: Vocabulary, logit: np.ndarray, table: np.ndarray, speller: Model):
        self.words, self.logit, self.table, self.speller = words, logit, table, speller
        self.weights = np.zeros((GATES, 4), np.float32)
        g = np.arange(GATES)
        self.weights[:, 0] = np.array([1, 0.7, 0.5, 0.3])[g & 3]
        self.weights[:, 1] = np.array([0, 0.2, 0.4, 0.6])[g & 3]
        self.weights[:, 2] = np.array([0, 0.2, 0.4, 0.6])[(g >> 2) & 3]

    def inputs(self, node, entries):
        """The three logits of bits and their gate."""
        xs, gate = looked_up(entries)
        return [self.logit.take(node), *xs], gate

    def mixable(self, number, before, lane, lanes: int):
        """Of words' bits in lanes: the gate's sum and the two contexts' entries, the bits,
        the lanes' first entries and numbers of bits."""
        code = self.words.code
        start, n, put, begin, bits = laid_out(code.start[number], code.length[number], lane,
                                              lanes)
        before = [np.insert(c, put, 0) for c in before]
        out = [np.empty(int(n.sum()), t) for t in (np.float32, np.int16, np.int16)]
        y, to = np.empty(len(out[0]), np.uint8), 0
        for a in range(0, len(n), SLICE):
            z = slice(a, a + SLICE)
            node, bit, slots = self.words.slots(start[z], n[z], [c[z] for c in before])
            entries = taken(self.table, _WORD_BASE, slots)
            own = slice(to, to + len(bit))
            out[0][own] = gated(self.weights, *self.inputs(node, entries))
            out[1][own], out[2][own] = entries
            y[own] = bit
            to = own.stop
        return out, y, begin, bits

    def log2(self, w: Words, number: np.ndarray, n_docs: int) -> np.ndarray:
        """log2 of the probability of each text, end mark included."""
        before, out = w.before(), np.zeros(n_docs)
        spelled = number == len(self.words.keys)
        kept: list = [None, None]
        for a, b in pairwise(parts(w.doc)):
            z = slice(a, b)
            docs, lane = np.unique(w.doc[z], return_inverse=True)
            state = [Lanes(len(docs), n, kept[k] if a and docs[0] == w.doc[a - 1] else None)
                     for k, n in enumerate((3, 2))]
            out[docs] += state[0].run(*self.mixable(number[z], [c[z] for c in before], lane,
                                                    len(docs)))
            own = np.flatnonzero(spelled[z])
            if len(own):
                _, at, same = np.unique(w.hash[z][own], return_index=True, return_inverse=True)
                dot, longest, bit, cut = self.speller.spelled(
                    w.data, w.first[z][own][at], w.last[z][own][at])
                start, n, _, begin, bits = laid_out(cut[same], np.diff(cut)[same], lane[own],
                                                    len(docs))
                to = np.cumsum(n)
                places = np.repeat(start - (to - n), n)
                places += np.arange(len(places))
                out[docs] += state[1].run([dot.take(places), longest.take(places)],
                                          bit.take(places), begin, bits)
            kept = [s.last() for s in state]
        return out


def parts(doc: np.ndarray) -> list[int]:
    """Edges of parts of PART words at most: whole texts, and longer ones cut at places
    that depend on themselves alone."""
    end = np.append(np.flatnonzero(doc[1:] != doc[:-1]) + 1, len(doc))
    out, first = [0], 0
    for e in end.tolist():
        if e - out[-1] > PART and first > out[-1]:
            out.append(first)
        while e - out[-1] > PART:
            out.append(out[-1] + PART)
        first = e
    return [*out, len(doc)]


def learn_words(texts: DataFrame, model: TextModel) -> None:
    """Fit the words' gate to whole texts (t), as `learn` does."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m, total = shared.value, np.zeros(2 * GATES * BINS ** 3)
        for own in grouped(batches, "t", HASHED):
            w = Words([t for b in own for t in b.column("t").to_pylist()])
            number, before = m.words.numbers(w.hash), w.before()
            for node, bit, slots in m.words.sliced(number, before):
                count_cells(total, *m.inputs(node, taken(m.table, _WORD_BASE, slots)), bit)
        yield cell_rows(total)

    model.weights = fitted(texts.select("t").mapInArrow(run, "k int, x double"), model.weights)
    shared.destroy()


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    out = []
    for x in (0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)):
        p = np.full(n, x, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def hashes_of(data, first, last) -> np.ndarray:
    """64-bit hashes of words in order; the end mark (an empty one) has its own.

    Each is the difference of two running sums, scaled back to the word's start.
    """
    out = np.empty(len(first), np.uint64)
    edge = np.searchsorted(first, np.arange(0, len(data) + HASHED, HASHED))
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        if a == b:
            continue
        f, t = first[a:b] - first[a], last[a:b] - first[a]
        n = int(t.max())
        power, inverse = _powers(max(1 << (n - 1).bit_length(), HASHED) if n else HASHED)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data[first[a]:first[a] + n] + np.uint64(1)) * power[:n], out=total[1:])
        h = (total[t] - total[f]) * inverse[f] + (t - f).astype(np.uint64)
        h = (h ^ (h >> np.uint64(30))) * _M[1]
        h = (h ^ (h >> np.uint64(27))) * _M[2]
        out[a:b] = h ^ (h >> np.uint64(31))
    out[last == first] = 1
    return out


class Lanes:
    """Texts side by side: each has weights and a refining table of its own."""

    def __init__(self, lanes: int, inputs: int, first=None):
        f = np.float32
        self.w = np.zeros((inputs + 1, lanes, 1), f)
        self.w[0] = 1
        centre = np.arange(BUCKETS + 1, dtype=f) * f(16 / (BUCKETS - 1)) - 8
        self.table = np.tile((1 / (1 + np.exp(-centre))).astype(f), (lanes, 1))
        if first is not None:
            self.w[:, 0], self.table[0] = first

    def last(self):
        """What the last lane has learned, for the rest of its text."""
        return self.w[:, -1].copy(), self.table[-1].copy()

    def run(self, xs, bit, begin, size) -> np.ndarray:
        """log2 of the probability of each lane's bits, mixed and refined as they come.

        ``xs`` are the logits (the first is the gate's sum) or a table's entries, a lane's
        from ``begin`` on, in whole steps; the bits beyond ``size`` of them count for nothing.
        """
        f = np.float32
        # What stands for all steps stays as small as it came.
        xs = [x.reshape(-1, STEP) for x in xs]
        bit = bit.reshape(-1, STEP)
        order = np.argsort(-size, kind="stable")
        begin, size = begin[order] // STEP, size[order]
        w, table = self.w[:, order], self.table[order].ravel()
        row = (np.arange(len(order)) * (BUCKETS + 1))[:, None]
        scale = f((BUCKETS - 1) / 16)
        shift = f(8) * scale + f(0.5)
        total, one = np.zeros(len(order)), np.ones(STEP, f)
        t = np.arange(-(-int(size[0]) // STEP)) * STEP
        live = np.searchsorted(-size, -t, "left")
        whole = np.searchsorted(-size, -(t + STEP), "right")
        for t, (k, full) in enumerate(zip(live.tolist(), whole.tolist())):
            at = begin[:k] + t
            own = [as_logits(x.take(at, 0)) if x.dtype == np.int16
                   else x.take(at, 0).astype(f, copy=False) for x in xs]
            np.clip(own[0], -8, 8, out=own[0])
            y = bit.take(at, 0).astype(f)
            q = own[0] * w[0, :k]
            for j in range(1, len(own)):
                q += own[j] * w[j, :k]
            q += w[-1, :k]
            np.clip(q, f(-7.99), f(7.99), out=q)
            p = np.exp(-q)
            p += 1
            np.reciprocal(p, out=p)
            q *= scale
            q += shift
            spot = q.astype(np.int64)
            spot += row[:k]
            r = table.take(spot)
            # The refined probability is the mean of the mix and the table's.
            c = p + r
            c *= f(0.5)
            np.subtract(f(1) - y, c, out=c)
            np.abs(c, out=c)
            np.subtract(y, p, out=p)
            np.subtract(y, r, out=r)
            if full < k:
                over = np.arange(STEP) >= (size[full:k] - t * STEP)[:, None]
                c[full:][over], p[full:][over], r[full:][over] = 1, 0, 0
            total[:k] += np.log(c, out=c) @ one
            r *= f(REFINE)
            np.add.at(table, spot.ravel(), r.ravel())
            p *= f(RATE)
            w[-1, :k, 0] += p @ one
            for j, x in enumerate(own):
                w[j, :k, 0] += np.einsum("ij,ij->i", x, p)
        self.w[:, order] = w
        self.table[order] = table.reshape(-1, BUCKETS + 1)
        out = np.zeros(len(order))
        out[order] = total / np.log(2)
        return out


def mixed(dot, longest, bit, places, owner, length, n) -> np.ndarray:
    """log2 of the probability of each text's bits, which stand at the first ``length`` of
    the column of ``places`` that it owns."""
    whole = -(-len(places) // STEP) * STEP
    at = np.zeros((places.shape[1], whole), np.int64)
    at[:, :len(places)] = places.T
    at = at.ravel()
    lanes = Lanes(len(owner), 2)
    got = lanes.run([dot[at], longest[at]], bit[at], np.arange(len(owner)) * whole, length)
    return np.bincount(owner, got, minlength=n)


def grouped(batches, name: str, least: int):
    """Rows in groups that end where a column's bytes reach so many, but for the last."""
    import pyarrow.compute as pc

    group, size = [], 0
    for b in batches:
        first = 0
        for end, n in enumerate(pc.binary_length(b.column(name)).to_pylist(), 1):
            size += n
            if size >= least:
                yield [*group, b.slice(first, end - first)]
                group, size, first = [], 0, end
        if first < b.num_rows:
            group.append(b.slice(first))
    if group:
        yield group


def count_words(batches):
    """w, its count c and that in tuning texts t, of a task's texts (t, tune)."""
    import pyarrow as pa

    for own in grouped(batches, "t", GROUP):
        b = pa.Table.from_batches(own)
        w = Words(b.column("t").to_pylist())
        _, at, same = np.unique(w.hash, return_index=True, return_inverse=True)
        tune = b.column("tune").to_numpy()[w.doc]
        yield pa.RecordBatch.from_pydict({
            "w": binaries(w.data, w.first[at], w.last[at]),
            "c": pa.array(np.bincount(same, minlength=len(at)), pa.int64()),
            "t": pa.array(np.bincount(same[tune], minlength=len(at)), pa.int64())})


def score(docs: DataFrame, folds: int = 5, held: int = 1) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte.

    Learns from the rows whose id is not in fold ``held``; scores every whole text.  Null
    is the empty text, which is its end mark alone; rows with a null id hash as the empty
    string; repeated rows are repeated.  With an empty training part the predictors have
    seen nothing.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", (id_fold(folds=folds) == held).alias("held_out"),
                        (F.pmod(F.xxhash64(F.lit("tune"), "doc_id"), F.lit(TUNING)) == 0)
                        .alias("tune"),
                        F.coalesce("text", F.lit("")).cast("binary").alias("t"))
    train = texts.where(~F.col("held_out")).select("t", "tune")
    counts = written(train.mapInArrow(count_words, "w binary, c bigint, t bigint")
                     .groupBy("w").agg(F.sum("c").alias("c"), F.sum("t").alias("t")), "lm-words")
    total, distinct, tuned = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)),
        F.coalesce(F.sum("t"), F.lit(0))).first()
    # The commonest words: as many classes of about the same count as there is room for.
    grade, room, least = F.floor(F.log2("c") * 16), COMMON_WORDS, 1 << 20
    for r in counts.where("c > 1").groupBy(grade.alias("g")).count().orderBy(F.desc("g")).collect():
        room -= r[1]
        if room < 0:
            break
        least = r[0]
    common = counts.withColumn("common", (F.col("c") > 1) & (grade >= least))
    known = common.where("common").select("w", "c", "t").toArrow()
    words = Vocabulary(hashes_of(*_joined_words(known.column("w").to_pylist())),
                       known.column("c").to_numpy(), known.column("t").to_numpy(), total, tuned)
    other = common.where("not common").select("w", F.col("c").alias("n"), "t")
    code = Code(byte_counts(other))
    spelling, tables = spelling_tables(other, code), word_tables(train, words)

    def model(k: int) -> TextModel:
        return TextModel(words, words.code.logits[k], tables[k],
                         Model(code, *unpacked(spelling[k])))

    weights = None
    if tuned:
        rest = model(0)
        learn(other.where("t > 0").select("w", F.col("t").alias("n")), rest.speller)
        learn_words(train.where("tune"), rest)
        weights = rest.weights, rest.speller.weights
        del rest
    full = model(1)
    if weights:
        full.weights, full.speller.weights = weights
    del spelling, tables
    shared = spark.sparkContext.broadcast(full)

    def run(batches):
        import pyarrow as pa

        m = shared.value
        gain = np.append(np.log10(m.words.counts + 0.5), 0)
        # Steps of the longest texts cost the same however many lanes go with them.
        for own in grouped(batches, "t", GROUP):
            ids, held_out = (pa.concat_arrays([b.column(c) for b in own])
                             for c in ("doc_id", "held_out"))
            n = len(ids)
            w = Words([t for b in own for t in b.column("t").to_pylist()])
            del own
            number = m.words.numbers(w.hash)
            bits = m.log2(w, number, n)
            hit = number < len(m.words.keys)
            rare = np.flatnonzero(~hit)
            _, at, k = np.unique(w.hash[rare] + w.doc[rare].astype(np.uint64) * _M[0],
                                 return_index=True, return_counts=True)
            order = np.argsort(at)
            rare, k = rare[at[order]], k[order]
            rest = pa.array(np.concatenate(
                [[0], np.cumsum(np.bincount(w.doc[rare], minlength=n))]), pa.int32())
            # Bytes of the normalised text and one more.
            size = np.maximum(np.bincount(w.doc, w.last - w.first + 1, minlength=n) - 1, 1)
            yield pa.RecordBatch.from_pydict({
                "doc_id": ids, "held_out": held_out,
                "n_tokens": pa.array(np.bincount(w.doc, minlength=n), pa.int64()),
                "known": pa.array(np.bincount(w.doc[hit], minlength=n), pa.int64()),
                "base": pa.array(np.bincount(w.doc, gain[number], minlength=n), pa.float64()),
                "score": pa.array(bits * np.log10(2), pa.float64()),
                "bits_per_byte": pa.array(-bits / size, pa.float64()),
                "rest": pa.ListArray.from_arrays(
                    rest, binaries(w.data, w.first[rare], w.last[rare])),
                "times": pa.ListArray.from_arrays(rest, pa.array(k, pa.int64()))})
            # The next group comes in without this one beside it.
            del w, number, bits, hit, rare, at, k, order, rest

    id_type = dict(docs.dtypes)["doc_id"]
    passed = written(
        texts.select("doc_id", "held_out", "t")
        .mapInArrow(run, f"doc_id {id_type}, held_out boolean, n_tokens bigint, known bigint, "
                         "base double, score double, bits_per_byte double, rest array<binary>, "
                         "times array<bigint>")
        .withColumn("row", F.monotonically_increasing_id()), "lm-passed")
    shared.destroy()
    # Words that are not among the commonest: their counts come by a join.
    rare = (passed.select("row", F.inline(F.arrays_zip(F.col("rest").alias("w"),
                                                       F.col("times").alias("k"))))
            .join(counts.select("w", "c"), "w", "left")
            .groupBy("row").agg(
                F.sum(F.when(F.col("c").isNotNull(), F.col("k")).otherwise(0)).alias("more"),
                F.sum(F.col("k") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("gain")))
    out = passed.drop("rest", "times").join(rare, "row", "left")
    norm = F.log10(F.lit(float(total)) + 0.5 * (distinct + 1))
    return out.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("gain", F.lit(0.0)) - F.col("n_tokens") * norm)
        .alias("base_score"), "score", "bits_per_byte")
