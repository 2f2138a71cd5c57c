"""Exact top-k inner products by dual-tree cover-tree search.

Every vector becomes integers, floor(scale * x).  Queries and candidates are each spread
over blocks by nearness to the corners of a top cover (a few vectors far apart), so that
a block is a compact region, and cut to BLOCK rows.  A first pass takes every query block
to one candidate block of its own region; the kth scores found there bound the real ones
from below.  The second pass takes every query block to every candidate block of its
dimension with these bounds.  A candidate is sent once a pass and its block's cover tree is
built once, for all query blocks that follow it.  In a task both sides have a cover tree,
and a pair of nodes is dropped when its bound is below the worst kth score that the query
node has, from the first pass or from this pair of blocks.

For a node pair with points q, c and covering radii r_q, r_c no pair below it scores more
than q.c + r_q |c| + r_c |q| + r_q r_c.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import list_parts, written

SCALE, TOP = 256, 5
#: Rows of a block; queries of a block; points below which a node is a leaf.
BLOCK, QUERY_BLOCK, LEAF = 4096, 512, 32
#: Points of a node's parts on average at least.
PART = 8
#: Corners of the top cover, and rows they are chosen from (any choice gives the same
#: result; it decides only how compact the blocks are).
CORNERS, CORNER_SAMPLE = 16, 4000


def integers(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, v) of the rows that take part: no null vector, component or id, all finite."""
    x = F.col(vec_col)
    fine = x.isNotNull() & F.col(id_col).isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return vectors.where(fine).select(
        F.col(id_col).cast("bigint").alias("id"),
        F.transform(x, lambda e: F.floor(e.cast("double") * scale)).alias("v"))


def far_apart(x: np.ndarray, n: int) -> np.ndarray:
    """Rows of ``x``, each the farthest from those before it."""
    if not len(x):
        return x
    chosen, near = [0], np.full(len(x), np.inf)
    while len(chosen) < min(n, len(x)):
        near = np.minimum(near, ((x - x[chosen[-1]]) ** 2).sum(1))
        if near.max() == 0:
            break
        chosen.append(int(near.argmax()))
    return x[chosen]


class CoverTree:
    """Nodes with a point, a covering radius and children; leaves hold at most LEAF points,
    copies of one, or points so scattered that the parts would hold under PART each.
    Each level's centres are at least half a radius apart."""

    def __init__(self, points: np.ndarray):
        #: Whole numbers for the scores, floats for distances and bounds.
        self.points, self.x = points, points.astype(float)
        x = self.x
        self.largest = float(np.abs(x).max(initial=0))
        self.point, self.radius, self.kids, self.rows = [], [], [], []
        self._grow(np.arange(len(x)), 0)
        self.norm = np.sqrt((x[np.array(self.point)] ** 2).sum(1)) if len(x) else None

    def _grow(self, rows: np.ndarray, centre: int) -> int:
        me = len(self.point)
        p = rows[centre]
        d = np.sqrt(((self.x[rows] - self.x[p]) ** 2).sum(1))
        r = float(d.max()) if len(rows) else 0.0
        self.point.append(p)
        self.radius.append(r)
        self.kids.append([])
        self.rows.append(rows)
        if len(rows) <= LEAF or r == 0:
            return me
        # Centres more than half the radius apart cover the node with radius r / 2.
        near, owner, centres = d.copy(), np.zeros(len(rows), int), [centre]
        while near.max() > r / 2 and len(centres) < 64:
            c = int(near.argmax())
            e = np.sqrt(((self.x[rows] - self.x[rows[c]]) ** 2).sum(1))
            owner[e < near] = len(centres)
            near = np.minimum(near, e)
            centres.append(c)
        if len(centres) * PART > len(rows):
            return me
        for k, c in enumerate(centres):
            own = np.flatnonzero(owner == k)
            if len(own):
                self.kids[me].append(self._grow(rows[own], int(np.flatnonzero(own == c)[0])
                                                if c in own else 0))
        return me


def dual_search(queries: CoverTree, data: CoverTree, ids: np.ndarray, own: np.ndarray,
                best: np.ndarray, best_id: np.ndarray) -> None:
    """Improve ``best`` (scores, high to low) and ``best_id`` of every query in place.

    ``ids`` are the data's, ``own`` the queries' ids; a query doesn't meet its own id.
    Ties go to the smaller id, so a pair is dropped only when its bound is below the
    worst kth score.
    """
    k = best.shape[1]
    # Products and sums below 2^53 are exact in floats, which are faster; else in integers.
    exact = queries.largest * data.largest * max(queries.x.shape[-1], 1) < 2.0 ** 53
    norms = (queries.norm.max() + max(queries.radius)) * (data.norm.max() + max(data.radius)) \
        if len(queries.x) and len(data.x) else 0.0
    slack = 1e-6 + 1e-12 * norms
    q_point, d_point = np.array(queries.point), np.array(data.point)
    q_r, d_r = np.array(queries.radius), np.array(data.radius)

    def bound(q, ds):
        dots = data.x[d_point[ds]] @ queries.x[q_point[q]]
        return dots + q_r[q] * data.norm[ds] + d_r[ds] * queries.norm[q] + q_r[q] * d_r[ds]

    def visit(q, ds):
        worst = best[queries.rows[q], k - 1].min()
        b = bound(q, ds)
        ds, b = ds[b >= worst - slack], b[b >= worst - slack]
        if not len(ds):
            return
        ds = ds[np.argsort(-b, kind="stable")]
        if not queries.kids[q]:
            meet(q, ds)
            return
        wide = [d for d in ds if data.kids[d] and d_r[d] >= q_r[q]]
        if wide:
            split = set(wide)
            ds = np.array([x for d in ds for x in (data.kids[d] if d in split else [d])])
        for kid in queries.kids[q]:
            visit(kid, ds)

    def meet(q, ds):
        """A query leaf against a list of data nodes, best bound first."""
        rows = queries.rows[q]
        heap = list(ds)
        while heap:
            heap = np.array(heap)
            worst = best[rows, k - 1].min()
            b = bound(q, heap)
            heap = heap[b >= worst - slack][np.argsort(-b[b >= worst - slack], kind="stable")]
            leaves = [d for d in heap[:16] if not data.kids[d]]
            if leaves:
                take(rows, np.concatenate([data.rows[d] for d in leaves]))
            inner = [x for d in heap[:16] if data.kids[d] for x in data.kids[d]]
            heap = inner + heap[16:].tolist()

    def take(rows, cand):
        s = (queries.x[rows] @ data.x[cand].T).astype(np.int64) if exact else \
            queries.points[rows] @ data.points[cand].T
        s[own[rows][:, None] == ids[cand][None, :]] = np.iinfo(np.int64).min
        # Few rows have a candidate that reaches their kth score, few candidates reach any.
        reach = s >= best[rows, k - 1][:, None]
        some, few = np.flatnonzero(reach.any(1)), np.flatnonzero(reach.any(0))
        if not len(some):
            return
        rows, cand, s = rows[some], cand[few], s[some][:, few]
        s = np.concatenate([best[rows], s], axis=1)
        i = np.concatenate([best_id[rows], np.broadcast_to(ids[cand], (len(rows), len(cand)))],
                           axis=1)
        order = np.lexsort((i, -s.clip(-(1 << 62))), axis=1)[:, :k]
        best[rows] = np.take_along_axis(s, order, 1)
        best_id[rows] = np.take_along_axis(i, order, 1)

    if len(queries.x) and len(data.x):
        visit(0, np.array([0]))


def search(vectors: DataFrame, every: int = 50, top: int = TOP, scale: int = SCALE,
           id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the ``top`` candidates of each query.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but the
    query's own id.  Null or empty vectors, null or non-finite components and null ids
    take no part; vectors of another length than the query's don't meet it; of repeated
    ids the largest vector takes part.  Scores are exact as long as they fit 64 bits.
    Ties go to the smaller id; a query with fewer candidates has fewer rows, and an empty
    table gives none.
    """
    rows = written(integers(vectors, id_col, vec_col, scale).groupBy("id")
                   .agg(F.max("v").alias("v")).withColumn("dim", F.size("v")), "search-rows")
    spark = rows.sparkSession
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(CORNER_SAMPLE).collect()
    corners = {d: far_apart(np.array([r["v"] for r in sample if r["dim"] == d], float), CORNERS)
               for d in {r["dim"] for r in sample}}
    shared = spark.sparkContext.broadcast(corners)

    def near(batches):
        import pyarrow as pa

        for b in batches:
            region = np.zeros(b.num_rows, np.int32)
            flat, at = list_parts(b.column("v"))
            dims = np.diff(at)
            for d in np.unique(dims):
                c = shared.value.get(int(d))
                if c is not None and len(c):
                    i = np.flatnonzero(dims == d)
                    x = flat[at[i][:, None] + np.arange(d)].astype(float)
                    region[i] = ((c ** 2).sum(1)[None] - 2 * x @ c.T).argmin(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(region, pa.int32())],
                                             [*b.schema.names, "region"])

    placed = rows.mapInArrow(near, "id bigint, v array<bigint>, dim int, region int")
    # Regions are cut to blocks by a hash, so no block grows with its region.
    sizes = placed.groupBy("dim", "region").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).alias("cuts"),
        F.ceil(F.count_if(F.col("id") % every == 0) / QUERY_BLOCK).alias("q_cuts"))
    placed = placed.join(F.broadcast(sizes), ["dim", "region"])  # CORNERS rows a dimension
    cut = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    data = placed.select("id", "v", "dim", "region", cut("cuts").alias("cut"))
    asked = placed.where(F.col("id") % every == 0).select(
        "id", "v", "dim", F.col("region").alias("q_region"), cut("q_cuts").alias("q_cut"))
    blocks = data.groupBy("dim", "region", "cut").agg(F.lit(1).alias("one")).drop("one")
    q_blocks = asked.groupBy("dim", "q_region", "q_cut").agg(F.lit(1).alias("one")).drop("one")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def against(pairs: DataFrame, queries: DataFrame) -> DataFrame:
        """Query blocks against the candidate blocks they are paired with; a candidate is
        sent once, before the query blocks that meet its block."""
        left = queries.join(pairs, ["dim", "q_region", "q_cut"]).select(
            *key, "q_region", "q_cut", "id", "v", "least")
        some = data.join(pairs.select(*key).distinct(), key, "left_semi")
        right = some.select(*key, F.lit(-1).alias("q_region"),
                            F.lit(-1).cast("bigint").alias("q_cut"), "id", "v",
                            F.lit(None).cast("bigint").alias("least"))
        # By a hash of the key: partitioning by the key itself is dropped where both sides
        # seem to be partitioned by it, and then their partitions don't meet.
        return (left.unionByName(right).repartition(tasks, F.xxhash64(*key))
                .sortWithinPartitions(*key, "q_region", "q_cut")
                .mapInArrow(lambda bs: _meet(bs, top),
                            "query_id bigint, vec_id bigint, score bigint"))

    key = ["dim", "region", "cut"]
    every_pair = q_blocks.join(blocks, "dim")
    none = F.lit(None).cast("bigint").alias("least")
    # First one block of the query's own region: its kth score bounds the real one from
    # below, so that in all other blocks most nodes fall at once.
    first = against(every_pair.where("region = q_region AND cut = 0"), asked.select("*", none))
    nth = F.sort_array(F.collect_list("score"), asc=False)
    bounds = (first.groupBy("query_id").agg(nth.alias("s")).where(F.size("s") >= top)
              .select(F.col("query_id").alias("id"), F.get("s", F.lit(top - 1)).alias("least")))
    bounded = written(asked.join(bounds, "id", "left"), "search-queries")
    # Pairs of blocks, not of rows: a stated query set against all rows, in blocks.
    met = against(every_pair, bounded)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (met.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _meet(batches, top):
    """Streams candidate blocks, each followed by the query blocks that meet it; holds one of
    either at a time.  ``least`` is a score that a query's kth best is known to reach."""
    import pyarrow as pa

    block, part, data, ids, group = None, None, None, None, []

    def done():
        nonlocal data, ids
        if not group:
            return None
        own = np.concatenate([i for i, _, _ in group])
        order = np.argsort(own, kind="stable")
        own = own[order]
        points = np.concatenate([v for _, v, _ in group])[order]
        if part[0] < 0:
            ids, data = own, CoverTree(points)
            return None
        # One below what is known to be reached: its rows are found again.
        known = np.concatenate([x for _, _, x in group])[order]
        best = np.repeat(known[:, None], top, axis=1)
        best_id = np.full((len(own), top), np.iinfo(np.int64).max)
        if data is not None:
            dual_search(CoverTree(points), data, ids, own, best, best_id)
        found = (best_id < np.iinfo(np.int64).max) & (best > -(1 << 62))
        return pa.RecordBatch.from_pydict({
            "query_id": pa.array(np.repeat(own, found.sum(1)), pa.int64()),
            "vec_id": pa.array(best_id[found], pa.int64()),
            "score": pa.array(best[found], pa.int64())})

    for b in batches:
        names = [b.column(c).to_numpy(zero_copy_only=False)
                 for c in ("dim", "region", "cut", "q_region", "q_cut")]
        own = b.column("id").to_numpy(zero_copy_only=False)
        flat, at = list_parts(b.column("v"))
        least = b.column("least")
        known = np.where(least.is_null().to_numpy(zero_copy_only=False),
                         np.iinfo(np.int64).min, least.fill_null(1).to_numpy() - 1)
        edge = np.any([np.diff(x) != 0 for x in names], axis=0)
        starts = np.concatenate([[0], np.flatnonzero(edge) + 1]) if b.num_rows else []
        for x, y in zip(starts, [*starts[1:], b.num_rows]):
            name = tuple(int(n[x]) for n in names)
            if name != (*(block or ()), *(part or ())):
                out = done()
                if out is not None:
                    yield out
                if name[:3] != block:
                    data = None
                block, part, group = name[:3], name[3:], []
            group.append((own[x:y], flat[at[x]:at[y]].reshape(y - x, -1), known[x:y]))
    out = done()
    if out is not None:
        yield out
