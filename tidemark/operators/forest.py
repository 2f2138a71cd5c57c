"""A random forest grown in tasks, for trees that the driver can't hold (#117, #128).

Spark's trainer sends a dense histogram of every node and keeps all nodes on the driver; a
tree without a limit of depth has about as many leaves as rows.  Here the rows are binned
once and kept in chunks.  Nodes that hold many rows are split level by level: partial sums
per (node, feature, bin) of all trees in one job.  The rows of a smaller node go to one
task, which grows its subtree to the end.  Trees stay a table of such subtrees, and rows are
scored where the trees are.

As in Spark's trainer: bins at quantiles, Poisson(1) bags, features drawn per node, the
largest gain in variance, leaves of weighted means.  The draws are others than Spark's.
"""

from __future__ import annotations

import math
import sys
from typing import NamedTuple

import numpy as np
from pyspark import cloudpickle
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.util import (DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader,
                             MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.files import delete_tree
from tidemark.sources.io import shared_dir

#: Rows in all bags of a forest up to which Spark's own trainer takes it, whose nodes the
#: driver holds.
BAGGED_ROWS = 1_500_000
#: Rows of a bag up to which a node's subtree is grown in one task.
ROWS_PER_SUBTREE = 200_000
ROWS_PER_CHUNK = 4_096
#: (row, feature) pairs that a task looks at together.
PAIRS = 1 << 20
#: Points of a partition that describe a feature's distribution.
POINTS = 512
LEAF = 255

CHUNKS = "chunk long, n int, bins binary, y binary, w binary"
BAGS = "slot int, tree int, node int, chunk long, n int, bins binary, y binary, w binary, c binary"
SUBTREES = ("tree int, node int, feature binary, bin binary, left binary, value binary, "
            "gain binary")


# Task functions bring what they use of this module, so executors needn't have it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Rule(NamedTuple):
    """How trees grow; ``subset`` features of ``features`` are looked at in a node."""

    features: int
    subset: int
    depth: int
    least: int
    gain: float
    bootstrap: bool
    seed: int
    bins: int

    def rng(self, *of: int) -> np.random.Generator:
        return np.random.default_rng([self.seed & 0xFFFFFFFF, *of])

    def bag(self, tree: int, chunk: int, n: int) -> np.ndarray:
        """How often each row of a chunk is in a tree's bag."""
        if not self.bootstrap:
            return np.ones(n, np.int64)
        return self.rng(0, tree, chunk).poisson(1.0, n)

    def draw(self, rng: np.random.Generator, nodes: int) -> np.ndarray:
        """(nodes, subset): the features each node looks at."""
        if self.subset >= self.features:
            return np.broadcast_to(np.arange(self.features), (nodes, self.features))
        x = rng.random((nodes, self.features), dtype=np.float32)
        return np.argpartition(x, self.subset - 1, axis=1)[:, :self.subset]

    def drawn(self, tree: int, nodes) -> np.ndarray:
        """`draw` of single nodes, the same wherever it is asked for."""
        return np.concatenate([self.draw(self.rng(1, tree, int(v)), 1) for v in nodes])


def subset_size(strategy: str, features: int, trees: int) -> int:
    """``featureSubsetStrategy`` as Spark reads it for regression."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "onethird"
    named = {"all": features, "onethird": math.ceil(features / 3),
             "sqrt": math.ceil(math.sqrt(features)),
             "log2": max(1, math.ceil(math.log2(features)))}
    if strategy in named:
        return named[strategy]
    x = float(strategy)
    whole = strategy.strip().lstrip("+").isdigit()
    return max(1, min(features, int(x) if whole else math.ceil(x * features)))


# ---------------------------------------------------------------- splits of nodes
def cells(rule: Rule, of: np.ndarray, bins: np.ndarray, w, s, c) -> tuple:
    """Sums by key (node * subset + drawn) * rule.bins + bin: the keys that occur, ascending,
    and the sums of the rows' w, s and c.  ``of`` is the node of each row, ``bins`` are its
    (subset, rows) bins.  Few keys are counted, many are sorted."""
    nodes, own = int(of[-1]) + 1, [s, c] if w is c else [s, c, w]
    if nodes * rule.bins <= 2 * len(of):
        total = np.empty((len(own), nodes, len(bins), rule.bins))
        base = of * rule.bins
        for j, row in enumerate(bins):
            key = base + row
            for k, x in enumerate(own):
                total[k, :, j] = np.bincount(key, x, nodes * rule.bins).reshape(nodes, -1)
        total = total.reshape(len(own), -1)
        at = np.flatnonzero(total[1])
        total = total[:, at]
    else:
        key = (of * len(bins) + np.arange(len(bins))[:, None]) * rule.bins + bins
        bits = max(1, (len(of) - 1).bit_length())
        packed = np.sort(((key << bits) | np.arange(len(of))).ravel())
        row, key = packed & ((1 << bits) - 1), packed >> bits
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        at, total = key[first], [np.add.reduceat(x[row], first) for x in own]
    return at, total[-1], total[0], total[1]


def best(rule: Rule, found: tuple, sse: np.ndarray, weight, count) -> tuple:
    """Of each node the best (drawn feature, bin, gain, left's weight, sum and count).

    ``found`` are `cells` with key (node * subset + drawn) * bins + bin, of sums around the
    node's mean, so the right side's sum is the left's with its sign changed.  A gain of 0
    or less is no split; what rounding leaves of it is cut at 1e-12 of the node's variance.
    """
    key, w, s, c = found
    segment = key // rule.bins
    start = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
    length = np.diff(np.append(start, len(key)))

    def left(x):
        total = np.cumsum(x)
        return total - np.repeat(total[start] - x[start], length)

    w, s, c = left(w), left(s), left(c)
    node = segment // rule.subset
    other = weight[node] - w
    ok = (c >= rule.least) & (count[node] - c >= rule.least) & (w > 0) & (other > 0)
    gain = np.full(len(key), -1.0)
    gain[ok] = (s * s)[ok] * weight[node[ok]] / (w[ok] * other[ok])
    at = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
    top = np.repeat(np.maximum.reduceat(gain, at), np.diff(np.append(at, len(key))))
    hit = np.flatnonzero(gain == top)
    hit = hit[np.concatenate(([True], node[hit[1:]] != node[hit[:-1]]))]
    bound = np.maximum(1e-12 * sse, rule.gain * weight)
    hit = hit[(gain[hit] > 1e-12 * sse[node[hit]]) & (gain[hit] >= bound[node[hit]])]
    return (node[hit], segment[hit] % rule.subset, key[hit] % rule.bins, gain[hit], w[hit],
            s[hit], c[hit])


def grow(rule: Rule, rng, x: np.ndarray, y, w, c, level: int = 0) -> tuple:
    """The tree over the rows (x: bins; y, w, c: target, weight, times in the bag) from a node
    at ``level`` to its end: feature, bin, left child (the right one follows) and value of
    every node, and the gain by feature."""
    rows = np.arange(len(y))
    size = np.array([len(y)])
    gains, out, nodes = np.zeros(rule.features), [], 0
    flat, n, plain = np.ascontiguousarray(x.T).ravel(), len(y), w is c
    while len(size):
        start = np.concatenate(([0], np.cumsum(size)[:-1]))
        weight, count = np.add.reduceat(w, start), np.add.reduceat(c, start)
        low, high = np.minimum.reduceat(y, start), np.maximum.reduceat(y, start)
        value = np.clip(np.add.reduceat(w * y, start) / weight, low, high)
        off = y - np.repeat(value, size)
        sums = w * off
        sse = np.add.reduceat(sums * off, start)
        feature = np.full(len(size), LEAF, np.uint8)
        cut = np.zeros(len(size), np.uint8)
        live = np.flatnonzero((level < rule.depth) & (count >= 2 * rule.least) & (high > low))
        # Nodes in blocks of about so many pairs.
        block = np.cumsum(size[live]) * rule.subset // PAIRS
        for part in np.split(live, np.flatnonzero(np.diff(block)) + 1 if len(live) else []):
            if not len(part):
                continue
            own = size[part]
            at = np.repeat(start[part] - np.concatenate(([0], np.cumsum(own)[:-1])), own)
            at += np.arange(len(at))
            of = np.repeat(np.arange(len(part)), own)
            drawn = rule.draw(rng, len(part))
            times = c[at]
            found = cells(rule, of, flat[drawn.T[:, of] * n + rows[at]],
                          times if plain else w[at], sums[at], times)
            node, j, bins, gain, *_ = best(rule, found, sse[part], weight[part], count[part])
            feature[part[node]] = drawn[node, j]
            cut[part[node]] = bins
            np.add.at(gains, drawn[node, j], gain)
        split = np.flatnonzero(feature != LEAF)
        left = np.zeros(len(size), np.int32)
        nodes += len(size)
        left[split] = nodes + 2 * np.arange(len(split))
        out.append((feature, cut, left, value))
        # The rows of split nodes: those that go left first, in order.
        keep = np.repeat(feature != LEAF, size)
        of = np.repeat(np.cumsum(feature != LEAF) - 1, size)[keep]
        rows, y, c = rows[keep], y[keep], c[keep]
        w = c if plain else w[keep]
        side = flat[feature[split].astype(np.int64)[of] * n + rows] > cut[split][of]
        child = 2 * of + side
        size = np.bincount(child, minlength=2 * len(split))
        order = np.argsort(child, kind="stable")
        rows, y, c = rows[order], y[order], c[order]
        w = c if plain else w[order]
        level += 1
    return *(np.concatenate(a) for a in zip(*out)), gains


def walk(feature: np.ndarray, bins: np.ndarray, left: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The node at which each row of bins ends."""
    node = np.zeros(len(x), np.int64)
    going = np.arange(len(x)) if len(feature) and feature[0] != LEAF else np.zeros(0, np.int64)
    while len(going):
        at = node[going]
        at = left[at] + (x[going, feature[at]] > bins[at])
        node[going] = at
        going = going[feature[at] != LEAF]
    return node


class Top:
    """The first levels of a tree.  ``rest`` are nodes whose subtree a task grows, ``wide``
    those that are split over all partitions: {node: (level, value, weight, sse, count)}."""

    def __init__(self, facts: tuple, depth: int):
        self.feature, self.bin, self.left, self.value = [LEAF], [0], [0], [facts[1]]
        self.rest, self.wide, self.depth = {}, {}, depth
        self.place(0, facts)

    def place(self, node: int, facts: tuple) -> None:
        """A large node that may not be split is a leaf."""
        if facts[-1] <= ROWS_PER_SUBTREE:
            self.rest[node] = facts
        elif facts[0] < self.depth:
            self.wide[node] = facts

    def split(self, node: int, feature: int, cut: int, sides: list) -> None:
        self.feature[node], self.bin[node], self.left[node] = feature, cut, len(self.feature)
        for facts in sides:
            self.feature.append(LEAF), self.bin.append(0), self.left.append(0)
            self.value.append(facts[1])
            self.place(len(self.feature) - 1, facts)

    def arrays(self) -> tuple:
        return (np.array(self.feature, np.uint8), np.array(self.bin, np.uint8),
                np.array(self.left, np.int32))


# ---------------------------------------------------------------- rows as bins
def matrix(column) -> np.ndarray:
    """(rows, features) of an Arrow column of equally long lists."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def described(data: DataFrame, bins: int) -> tuple[list, int]:
    """Of every feature its thresholds, at most ``bins`` - 1, and the number of rows.

    A partition sends each feature's values and counts, or `POINTS` of its quantiles.
    Thresholds lie between neighbouring values, at equal shares of the rows."""
    def run(batches):
        import pyarrow as pa

        x = [matrix(b.column("x")) for b in batches]
        x = np.concatenate([a for a in x if len(a)] or [np.zeros((0, 0))])
        for f in range(x.shape[1]):
            value, count = np.unique(x[:, f], return_counts=True)
            if len(value) > POINTS:
                upto = np.cumsum(count)
                at = np.unique(np.searchsorted(upto, np.linspace(0, len(x), POINTS + 1)[1:]))
                value, count = value[at], np.diff(upto[at], prepend=0)
            yield pa.RecordBatch.from_pydict({
                "f": pa.array([f], pa.int32()), "value": pa.array([value.tobytes()]),
                "n": pa.array([count.astype(np.int64).tobytes()])})

    parts: dict = {}
    for r in data.mapInArrow(run, "f int, value binary, n binary").collect():
        parts.setdefault(r[0], []).append((np.frombuffer(r[1]), np.frombuffer(r[2], np.int64)))
    return [thresholds(*map(np.concatenate, zip(*parts[f])), bins) for f in sorted(parts)], \
        sum(int(n.sum()) for _, n in parts.get(0, []))


def thresholds(value: np.ndarray, n: np.ndarray, bins: int) -> np.ndarray:
    value, at = np.unique(value, return_inverse=True)
    upto = np.cumsum(np.bincount(at, n))
    middle = (value[1:] + value[:-1]) / 2
    if len(value) <= bins:
        return middle
    want = upto[-1] * np.arange(1, bins) / bins
    i = np.clip(np.searchsorted(upto, want), 1, len(middle) - 1)
    nearer = np.abs(upto[i - 1] - want) <= np.abs(upto[i] - want)
    return middle[np.unique(i - nearer)]


def binned(x: np.ndarray, cuts: list) -> np.ndarray:
    """A value equal to a threshold belongs to the bin below."""
    out = np.empty((len(x), len(cuts)), np.uint8)
    for f, cut in enumerate(cuts):
        out[:, f] = np.searchsorted(cut, x[:, f])
    return out


def chunked(data: DataFrame, cuts: list, folder: str) -> DataFrame:
    """The rows (x, y, w) as chunks, written once: bags are drawn by chunk and place in it."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 32
        for b in batches:
            x = binned(matrix(b.column("x")), cuts)
            y, w = (b.column(c).to_numpy(zero_copy_only=False) for c in "yw")
            for i in range(0, len(x), ROWS_PER_CHUNK):
                part = slice(i, i + ROWS_PER_CHUNK)
                yield pa.RecordBatch.from_pydict({
                    "chunk": pa.array([at], pa.int64()),
                    "n": pa.array([len(x[part])], pa.int32()),
                    **{k: pa.array([v[part].tobytes()], pa.binary())
                       for k, v in (("bins", x), ("y", y), ("w", w))}})
                at += 1

    spark = data.sparkSession
    data.mapInArrow(run, CHUNKS).write.parquet(folder)
    chunks = spark.read.schema(CHUNKS).parquet(folder)
    number = chunks.count()
    cores = spark.sparkContext.defaultParallelism
    return chunks.repartition(max(1, min(number, max(cores, number // 16))))


def rows_of(batches, features: int):
    """(chunk, bins, y, w) of each chunk."""
    for b in batches:
        for chunk, x, y, w in zip(*(b.column(c) for c in ("chunk", "bins", "y", "w"))):
            x = np.frombuffer(x.as_buffer(), np.uint8).reshape(-1, features)
            yield chunk.as_py(), x, np.frombuffer(y.as_buffer()), np.frombuffer(w.as_buffer())


# ---------------------------------------------------------------- growing a forest
def root_facts(chunks: DataFrame, rule: Rule, trees: int) -> list[tuple]:
    """(level, mean, weight, sum of squares around it, count) of every tree's bag."""
    def run(batches):
        import pyarrow as pa

        for chunk, _, y, w in rows_of(batches, rule.features):
            out = np.empty((trees, 4))
            for t in range(trees):
                c = rule.bag(t, chunk, len(y)) * (w > 0)
                out[t] = (c * w).sum(), (c * w * y).sum(), (c * w * y * y).sum(), c.sum()
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array([chunk], pa.int64()), "x": pa.array([out.tobytes()])})

    total = sum(np.frombuffer(r[1]).reshape(trees, 4) for r in
                sorted(chunks.mapInArrow(run, "chunk long, x binary").collect()))
    w, s, q, c = total.T
    mean = s / np.maximum(w, 1e-300)
    return [(0, *map(float, f)) for f in zip(mean, w, np.maximum(q - s * mean, 0), c)]


def widened(chunks: DataFrame, rule: Rule, tops: list[Top]) -> np.ndarray:
    """Splits the ``wide`` nodes of all trees by one job; the gain by (tree, feature)."""
    todo = {t: sorted(top.wide) for t, top in enumerate(tops) if top.wide}
    state = {t: (tops[t].arrays(), np.array([tops[t].wide[v] for v in todo[t]])) for t in todo}
    keys = {t: len(todo[t]) * rule.subset * rule.bins for t in todo}

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        total: dict = {}
        for chunk, x, y, w in rows_of(batches, rule.features):
            for t, (top, facts) in state.items():
                number = np.full(len(top[0]), -1)
                number[todo[t]] = np.arange(len(todo[t]))
                of = number[walk(*top, x)]
                c = rule.bag(t, chunk, len(y))
                at = np.flatnonzero((of >= 0) & (c * w > 0))
                if not len(at):
                    continue
                of, c = of[at], c[at].astype(np.float64)
                drawn = rule.drawn(t, todo[t])
                off = y[at] - facts[of, 1]
                sums = total.setdefault(t, np.zeros((3, len(facts), rule.subset, rule.bins)))
                for j in range(rule.subset):
                    key = of * rule.bins + x[at, drawn[of, j]]
                    for k, z in enumerate((c * w[at], c * w[at] * off, c)):
                        sums[k, :, j] += np.bincount(key, z, len(facts) * rule.bins).reshape(
                            len(facts), -1)
        for t, sums in total.items():
            yield pa.RecordBatch.from_pydict({
                "tree": pa.array([t], pa.int32()), "part": pa.array([part], pa.int32()),
                "sums": pa.array([sums.tobytes()], pa.binary())})

    def merge(batches):
        import pyarrow as pa

        tree, sums = None, None

        def chosen():
            _, facts = state[tree]
            at = np.flatnonzero(sums[2])
            node, j, cut, gain, w, s, c = best(rule, (at, *sums[:, at]), facts[:, 3],
                                               facts[:, 2], facts[:, 4])
            nodes = np.array(todo[tree])[node]
            feature = rule.drawn(tree, nodes)[np.arange(len(nodes)), j] if len(nodes) else j
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(nodes), tree), pa.int32()), pa.array(nodes, pa.int32()),
                 pa.array(feature, pa.int32()), pa.array(cut, pa.int32()),
                 *(pa.array(z, pa.float64()) for z in (gain, w, s, c))],
                ["tree", "node", "feature", "bin", "gain", "w", "s", "c"])

        for b in batches:
            for t, body in zip(b.column("tree").to_pylist(), b.column("sums")):
                if tree is not None and t != tree:
                    yield chosen()
                if t != tree:
                    tree, sums = t, np.zeros((3, keys[t]))
                sums += np.frombuffer(body.as_buffer()).reshape(3, -1)
        if tree is not None:
            yield chosen()

    found = (chunks.mapInArrow(run, "tree int, part int, sums binary")
             .repartition(len(todo), "tree").sortWithinPartitions("tree", "part")
             .mapInArrow(merge, "tree int, node int, feature int, bin int, gain double, "
                                "w double, s double, c double").collect())
    gains = np.zeros((len(tops), rule.features))
    for t in todo:
        waiting, tops[t].wide = tops[t].wide, {}
        for _, node, feature, cut, gain, w, s, c in sorted(r for r in found if r[0] == t):
            level, mean, weight, sse, count = waiting.pop(node)
            gains[t, feature] += gain
            deeper = [(level + 1, mean + s / w, w, sse, c),
                      (level + 1, mean - s / (weight - w), weight - w, sse, count - c)]
            tops[t].split(node, feature, cut, deeper)
    return gains


def subtrees(chunks: DataFrame, rule: Rule, tops: list[Top]) -> DataFrame:
    """The rows of every node in ``rest`` brought together, and its subtree grown."""
    state = [(top.arrays(), {v: f[0] for v, f in top.rest.items()}) for top in tops]
    largest = sorted(((f[-1], t, v) for t, top in enumerate(tops) for v, f in top.rest.items()),
                     reverse=True)
    tasks = min(len(largest), 2_000)
    slots = {(t, v): i % tasks for i, (_, t, v) in enumerate(largest)}

    def send(batches):
        import pyarrow as pa

        for chunk, x, y, w in rows_of(batches, rule.features):
            for t, (top, rest) in enumerate(state):
                c = rule.bag(t, chunk, len(y)).astype(np.float64)
                node = np.where(c * w > 0, walk(*top, x), -1)
                order = np.argsort(node, kind="stable")
                ends = np.flatnonzero(np.diff(node[order])) + 1
                for at in np.split(order, ends):
                    v = int(node[at[0]])
                    if v not in rest:
                        continue
                    # By feature: neighbouring bytes are alike.
                    body = (np.ascontiguousarray(x[at].T), y[at], c[at] * w[at],
                            c[at].astype(np.uint8))
                    yield pa.RecordBatch.from_pydict({
                        "slot": pa.array([slots[t, v]], pa.int32()),
                        "tree": pa.array([t], pa.int32()), "node": pa.array([v], pa.int32()),
                        "chunk": pa.array([chunk], pa.int64()),
                        "n": pa.array([len(at)], pa.int32()),
                        **{k: pa.array([z.tobytes()], pa.binary())
                           for k, z in zip(("bins", "y", "w", "c"), body)}})

    def finish(batches):
        import pyarrow as pa

        def grown(of, parts):
            x, y, w, c = (np.concatenate(z, axis=-1) for z in zip(*parts))
            c = c.astype(np.float64)
            w = c if np.array_equal(w, c) else w
            tree = grow(rule, rule.rng(2, *of), x.T, y, w, c, state[of[0]][1][of[1]])
            return pa.RecordBatch.from_pydict({
                "tree": pa.array([of[0]], pa.int32()), "node": pa.array([of[1]], pa.int32()),
                **{k: pa.array([z.tobytes()], pa.binary()) for k, z in
                   zip(("feature", "bin", "left", "value", "gain"), tree)}})

        last, parts = None, []
        for b in batches:
            for t, v, n, *body in zip(b.column("tree").to_pylist(), b.column("node").to_pylist(),
                                      b.column("n").to_pylist(),
                                      *(b.column(c) for c in ("bins", "y", "w", "c"))):
                if (t, v) != last:
                    if parts:
                        yield grown(last, parts)
                    last, parts = (t, v), []
                x, y, w, c = (np.frombuffer(z.as_buffer(), k) for z, k in
                              zip(body, (np.uint8, np.float64, np.float64, np.uint8)))
                parts.append((x.reshape(-1, n).copy(), y.copy(), w.copy(), c.copy()))
        if parts:
            yield grown(last, parts)

    return (chunks.mapInArrow(send, BAGS).repartitionById(tasks, F.col("slot"))
            .sortWithinPartitions("tree", "node", "chunk").mapInArrow(finish, SUBTREES))


class DeepForestRegressor(RandomForestRegressor):
    """Spark's forest, grown in tasks where its bags hold more than `BAGGED_ROWS` rows."""

    def _fit(self, dataset: DataFrame):
        small = dataset.count() * self.getNumTrees() <= BAGGED_ROWS
        return super()._fit(dataset) if small else self.grown(dataset)

    def grown(self, dataset: DataFrame) -> GrownForest:
        spark, trees = dataset.sparkSession, self.getNumTrees()
        weight = F.col(self.getWeightCol()) if self.isDefined("weightCol") else F.lit(1.0)
        data = dataset.select(vector_to_array(F.col(self.getFeaturesCol())).alias("x"),
                              F.col(self.getLabelCol()).cast("double").alias("y"),
                              weight.cast("double").alias("w"))
        folder = shared_dir(spark, "forest")
        cuts, _ = described(data, self.getMaxBins())
        rule = Rule(len(cuts), subset_size(self.getFeatureSubsetStrategy(), len(cuts), trees),
                    self.getMaxDepth(), self.getMinInstancesPerNode(), self.getMinInfoGain(),
                    self.getBootstrap() and trees > 1, self.getSeed(), self.getMaxBins())
        chunks = chunked(data, cuts, f"{folder}/chunks")
        tops = [Top(f, rule.depth) for f in root_facts(chunks, rule, trees)]
        gains = np.zeros((trees, rule.features))
        while any(top.wide for top in tops):
            gains += widened(chunks, rule, tops)
        subtrees(chunks, rule, tops).write.parquet(f"{folder}/trees")
        delete_tree(spark, f"{folder}/chunks")
        model = GrownForest()
        model._resetUid(self.uid)
        model._set(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol())
        model.folder = f"{folder}/trees"
        model.content = {
            "cuts": [[float(v) for v in c] for c in cuts], "gains": gains.tolist(),
            "tops": [[[int(v) for v in a] for a in top.arrays()] + [top.value] for top in tops]}
        return model


class GrownForest(Model, HasFeaturesCol, HasPredictionCol, MLWritable, MLReadable):
    """Trees as a table (`SUBTREES`), with thresholds and each tree's first levels beside it.

    A prediction depends on a row's bins alone: each combination of bins that occurs is
    sent to all groups of trees once, and their sums are joined to the rows."""

    folder: str
    content: dict

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cuts = [np.array(c) for c in self.content["cuts"]]
        tops = [(np.array(f, np.uint8), np.array(b, np.uint8), np.array(left, np.int32),
                 np.array(v)) for f, b, left, v in self.content["tops"]]
        spark, features = dataset.sparkSession, len(cuts)
        groups = min(len(tops), max(8, spark.sparkContext.defaultParallelism))

        def bins_of(x):
            return packed(binned(matrix(x), cuts))

        def score(batches):
            import pyarrow as pa

            trees = {}
            for b in batches:
                if not b.num_rows:
                    continue
                group = b.column("_group")[0].as_py()
                is_tree = b.column("tree").is_valid().to_numpy(zero_copy_only=False)
                for r in b.filter(pa.array(is_tree)).to_pylist():
                    trees[r["tree"], r["node"]] = [np.frombuffer(r[k], t) for k, t in (
                        ("feature", np.uint8), ("bin", np.uint8), ("left", np.int32),
                        ("value", np.float64))]
                b = b.filter(pa.array(~is_tree))
                if not b.num_rows:
                    continue
                x = np.frombuffer(b"".join(b.column("_bins").to_pylist()), np.uint8)
                x = x.reshape(-1, features)
                total = np.zeros(len(x))
                for t in range(group, len(tops), groups):
                    feature, cut, left, value = tops[t]
                    end = walk(feature, cut, left, x)
                    scores = value[end]
                    for v in np.unique(end).tolist():
                        if (t, v) in trees:
                            at = np.flatnonzero(end == v)
                            *tree, value_of = trees[t, v]
                            scores[at] = value_of[walk(*tree, x[at])]
                    total += scores
                yield pa.RecordBatch.from_arrays(
                    [b.column("_bins"), pa.array(np.full(len(x), group), pa.int32()),
                     pa.array(total, pa.float64())], ["_bins", "_group", "_total"])

        rows = dataset.withColumn("_bins", F.arrow_udf(bins_of, "binary")(
            vector_to_array(F.col(self.getFeaturesCol()))))
        kinds = rows.select("_bins").distinct().withColumn(
            "_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        trees = spark.read.schema(SUBTREES).parquet(self.folder).drop("gain").withColumn(
            "_group", F.col("tree") % groups)
        scored = (trees.unionByName(kinds, allowMissingColumns=True)
                  .repartitionById(groups, F.col("_group"))
                  .sortWithinPartitions(F.col("tree").asc_nulls_last(), "node")
                  .mapInArrow(score, "_bins binary, _group int, _total double"))
        # Added in the groups' order, so reruns agree to the last bit.
        parts = F.array_sort(F.collect_list(F.struct("_group", "_total")))
        mean = F.aggregate(parts, F.lit(0.0), lambda a, p: a + p["_total"]) / len(tops)
        return (rows.join(scored.groupBy("_bins").agg(mean.alias(self.getPredictionCol())),
                          "_bins", "left").drop("_bins"))

    @property
    def featureImportances(self):
        """Gains by feature: shares of a tree's, averaged over trees and scaled to one."""
        total = np.array(self.content["gains"])
        rows = self._trees().select("tree", "node", "gain").sort("tree", "node")
        for r in rows.toLocalIterator():
            total[r["tree"]] += np.frombuffer(r["gain"])
        of = total.sum(axis=1, keepdims=True)
        shares = np.divide(total, of, out=np.zeros_like(total), where=of > 0).sum(axis=0)
        return Vectors.dense(shares / shares.sum() if shares.sum() > 0 else shares)

    def _trees(self) -> DataFrame:
        from pyspark.sql import SparkSession

        return SparkSession.active().read.schema(SUBTREES).parquet(self.folder)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: GrownForest):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession,
                                         extraMetadata={"content": self.model.content})
        self.model._trees().write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def load(self, path: str) -> GrownForest:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = GrownForest()
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        model.folder, model.content = f"{path}/trees", meta["content"]
        return model


def packed(x: np.ndarray):
    """Rows of bytes as an Arrow column."""
    import pyarrow as pa

    ends = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(x), [
        None, pa.py_buffer(ends.tobytes()), pa.py_buffer(np.ascontiguousarray(x).tobytes())])
