"""N-gram Jaccard self-join with adaptive multi-match prefixes.

Texts are sets of three-word shingles.  Two sets of sizes a and b that link share at least
``least(a)`` shingles, so in any global order of shingles their prefixes of
``a - least(a) + k`` and ``b - least(b) + k`` shingles share k at least, for every k up to
that.  A longer prefix costs more shingles and asks for more shared ones.

1. Every text gives the prefix of its k = n/16 in order of hashes.  A text that shares
   fewer of these with other texts than the smallest set it may link to asks for has no
   link; most go here.
2. Of the texts left, all shingles are counted exactly, those that occur in one text are
   set aside and texts with too few others go.  Then shingles are ordered by rising
   frequency, and each text chooses the k at which reading its posting lists and verifying
   the candidates that k matches leave is estimated to cost least.
3. A text is first compared with the one it shares most prefix shingles with, which joins
   groups of copies into classes.  Whoever is not in the class that a posting list belongs
   to is then compared with all texts of such lists, in blocks: k shared prefix shingles
   (k the smaller of both) first, then the exact Jaccard similarity.  So every candidate
   pair is decided unless both are in one class already, and no list of pairs is made.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import list_parts, text_of, written
from tidemark.llm.icws_dedup import _labelled, _relabelled, classes, counted, mixed
from tidemark.llm.text_arrays import blanks, codes_of, hashes, runs

SHINGLE = 3
#: Links have NUMBER * |intersection| >= SHARE * |union|.
SHARE, NUMBER = 90, 100
#: The first prefixes ask for n / FIRST shared shingles; later ones for n / LAST at most.
FIRST, LAST = 16, 4
#: Texts on each side of a block comparison, and members that meet one copy of a pivot.
BLOCK = 128
TEXTS = 256


def least(n):
    """Shingles that a set of n shares with any set it links to."""
    return (SHARE * n + NUMBER - 1) // NUMBER


def base(n):
    """Length of the prefix less the shared shingles asked for."""
    return n - least(n)


def first_matches(n):
    return np.minimum(np.maximum(n // FIRST, 1), least(n))


def sets_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each of at most 256 texts in order of their hashes: values, offsets.

    Words are runs without blanks, A-Z in lower case; a text of one or two words is one
    shingle, one without words has none.
    """
    codes, start = codes_of(texts)
    codes = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
    first, last = runs(~blanks(codes))
    words = hashes(codes, first, last)
    offsets = np.searchsorted(first, start)
    n = np.diff(offsets)
    m = np.where(n == 0, 0, np.maximum(n - SHINGLE + 1, 1))
    doc = np.repeat(np.arange(len(m)), m)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(m) - m, m) + np.repeat(offsets[:-1], m)
    end = np.repeat(offsets[1:], m)
    h = np.zeros(len(doc), np.uint64)
    for k in range(SHINGLE):
        i = at + k
        h = mixed(h ^ np.where(i < end, words[np.minimum(i, len(words) - 1)], np.uint64(k))
                  if len(words) else h)
    values, doc, _ = counted(h, doc)
    return values.astype(np.int64), np.searchsorted(doc, np.arange(len(texts) + 1))


def digest(values: np.ndarray) -> int:
    """A 64-bit name of a set: equal sets are one node."""
    return int.from_bytes(hashlib.blake2b(values.tobytes(), digest_size=8).digest(), "big",
                          signed=True)


def _set_batches(batches, *columns):
    for b in batches:
        for at in range(0, b.num_rows, TEXTS):
            part = b.slice(at, TEXTS)
            values, offsets = sets_of(part.column("text").to_pylist())
            names = [digest(values[a:e]) if e > a else None
                     for a, e in zip(offsets[:-1], offsets[1:])]
            yield [part.column(c) for c in columns], values, offsets, names


def _list_array(values, lengths, pa):
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))


def _first_prefixes(batches):
    """(row, body, text) -> (row, body, node, n, asked, prefix).

    ``asked`` is what the smallest set that may link to this one asks for.
    """
    import pyarrow as pa

    for (row, body), values, offsets, names in _set_batches(batches, "row", "body"):
        n = np.diff(offsets)
        size = np.where(n > 0, base(n) + first_matches(n), 0)
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        yield pa.RecordBatch.from_arrays(
            [row, body, pa.array(names, pa.int64()), pa.array(n, pa.int64()),
             pa.array(first_matches(least(n)), pa.int64()),
             _list_array(values[at + np.repeat(offsets[:-1], size)], size, pa)],
            ["row", "body", "node", "n", "asked", "prefix"])


def _whole_sets(batches):
    """(text) -> (node, n, shingles)."""
    import pyarrow as pa

    for _, values, offsets, names in _set_batches(batches):
        n = np.diff(offsets)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), pa.array(n, pa.int64()), _list_array(values, n, pa)],
            ["node", "n", "shingles"])


def choose_matches(n: int, counts: np.ndarray) -> int:
    """How many shared prefix shingles to ask for, by estimated cost.

    ``counts`` are the frequencies of the text's shared shingles, rising; the others come
    before them.  With k matches a text reads the lists of its prefix, S entries in all;
    a candidate takes k of these at least, so at most S / k are verified, at n steps each.
    """
    most = int(min(least(n), max(n // LAST, 1)))
    k = np.arange(1, most + 1)
    read = np.concatenate([[0], np.cumsum(counts - 1)])
    inside = np.clip(base(n) + k - (n - len(counts)), 0, len(counts))
    s = read[inside]
    return int(k[np.argmin(s + n * s / k)])


def _choose(batches):
    """(node, n, shingles, counts) -> with ``matches`` and how many shingles are in the prefix."""
    import pyarrow as pa

    for b in batches:
        counts, offsets = list_parts(b.column("counts"))
        n = b.column("n").to_numpy()
        k = [choose_matches(int(n[i]), counts[offsets[i]:offsets[i + 1]].astype(np.int64))
             for i in range(b.num_rows)]
        length = np.maximum(base(n) + np.array(k, np.int64) - (n - np.diff(offsets)), 0)
        yield pa.RecordBatch.from_arrays(
            [b.column("node"), b.column("n"), b.column("shingles"), pa.array(k, pa.int64()),
             pa.array(np.minimum(length, np.diff(offsets)), pa.int64())],
            ["node", "n", "shingles", "matches", "prefix"])


def shared_sets(docs: DataFrame, firsts: DataFrame, parts: int) -> DataFrame:
    """Sets that may link: node, n, shingles (those of two sets or more, rare first),
    matches, prefix (how many of these the prefix holds)."""
    nodes = firsts.where("node IS NOT NULL")
    # Dealt out by shingle once; the counts and the look back share that exchange.
    dealt = nodes.select("node", F.explode("prefix").alias("s")).repartition(parts, "s")
    twice = (dealt.groupBy("s").agg(F.min("node").alias("a"), F.max("node").alias("b"))
             .where("a < b").select("s"))
    met = dealt.join(twice, "s", "left_semi").groupBy("node").agg(F.count(F.lit(1)).alias("m"))
    # Every copy of a set gave its prefix and asks, so both count once a copy.
    alive = written(
        nodes.groupBy("node").agg(F.sum("asked").alias("asked"), F.min("body").alias("body"))
        .join(met, "node").where("m >= asked").select("body"),
        "join-alive")
    texts = (docs.groupBy(F.md5(F.col("text").cast("binary")).alias("body"))
             .agg(F.any_value("text").alias("text")))
    whole = (texts.join(alive, "body", "left_semi").select("text")
             .mapInArrow(_whole_sets, "node bigint, n bigint, shingles array<bigint>"))
    dealt = whole.select("node", "n", F.explode("shingles").alias("s")).repartition(parts, "s")
    counts = dealt.groupBy("s").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    sets = (dealt.join(counts, "s").groupBy("node", "n")
            .agg(F.array_sort(F.collect_list(F.struct("c", "s"))).alias("x"))
            .where(F.size("x") >= F.ceil(F.col("n") * SHARE / NUMBER))
            .select("node", "n", F.col("x.s").alias("shingles"), F.col("x.c").alias("counts")))
    return written(sets.mapInArrow(
        _choose, "node bigint, n bigint, shingles array<bigint>, matches bigint, prefix bigint"),
        "join-sets")


class Set:
    """One text in a comparison; shingles come rare first."""

    __slots__ = ("node", "label", "n", "matches", "prefix", "values")

    def __init__(self, node, label, n, matches, prefix, values):
        self.node, self.label, self.n, self.matches = node, label, n, matches
        #: By value, with the number of matches at which each enters the prefix.
        enters = np.maximum(np.arange(prefix) + 1 + n - len(values) - base(n), 1)
        order = np.argsort(values[:prefix])
        self.prefix = values[:prefix][order], enters[order]
        self.values = np.sort(values)


def linked(n, m, both) -> np.ndarray:
    return NUMBER * both >= SHARE * (n + m - both)


def pair_linked(a: Set, b: Set) -> bool:
    """Sizes, shared prefix shingles, then the exact similarity."""
    if NUMBER * min(a.n, b.n) < SHARE * max(a.n, b.n):
        return False
    k = min(a.matches, b.matches)
    (pa, ea), (pb, eb) = a.prefix, b.prefix
    if len(np.intersect1d(pa[ea <= k], pb[eb <= k], assume_unique=True)) < k:
        return False
    both = len(np.intersect1d(a.values, b.values, assume_unique=True))
    return bool(linked(a.n, b.n, both))


def block_links(left: list[Set], right: list[Set]) -> np.ndarray:
    """Which of all pairs link, [left, right]."""
    n = np.array([x.n for x in left])[:, None]
    m = np.array([x.n for x in right])[None, :]
    k = np.minimum(np.array([x.matches for x in left])[:, None],
                   np.array([x.matches for x in right])[None, :])
    far = np.array([x.label for x in left])[:, None] != np.array([x.label for x in right])
    maybe = far & (NUMBER * np.minimum(n, m) >= SHARE * np.maximum(n, m))
    if not maybe.any():
        return maybe
    maybe &= _common([x.prefix for x in left], [x.prefix for x in right], k) >= k
    rows, cols = np.nonzero(maybe.any(1))[0], np.nonzero(maybe.any(0))[0]
    if len(rows):
        whole = lambda x: (x.values, np.zeros(len(x.values), np.int64))
        both = _common([whole(left[i]) for i in rows], [whole(right[j]) for j in cols], None)
        at = np.ix_(rows, cols)
        maybe[at] &= linked(n[rows], m[:, cols], both)
    return maybe


def _common(left, right, k) -> np.ndarray:
    """Values both have, of all pairs; with k only those that enter both at k or before."""
    def flat(side):
        v = np.concatenate([x[0] for x in side])
        d = np.repeat(np.arange(len(side)), [len(x[0]) for x in side])
        e = np.concatenate([x[1] for x in side])
        o = np.argsort(v, kind="stable")
        return v[o], d[o], e[o]

    out = np.zeros((len(left), len(right)), np.int64)
    (v1, d1, e1), (v2, d2, e2) = flat(left), flat(right)
    both = np.intersect1d(v1, v2)
    a0, a1 = np.searchsorted(v1, both), np.searchsorted(v1, both, "right")
    b0, b1 = np.searchsorted(v2, both), np.searchsorted(v2, both, "right")
    for p, q, x, y in zip(a0, a1, b0, b1):
        i, j = d1[p:q, None], d2[None, x:y]
        out[i, j] += 1 if k is None else np.maximum(e1[p:q, None], e2[None, x:y]) <= k[i, j]
    return out


def _sets_in(b, *columns):
    """Rows of a batch: the named columns, then the text's Set."""
    values, offsets = list_parts(b.column("shingles"))
    cols = [b.column(c).to_pylist() for c in (*columns, "node", "label", "n", "matches", "prefix")]
    for i, r in enumerate(zip(*cols)):
        yield r[:len(columns)], (r[len(columns):], values[offsets[i]:offsets[i + 1]])


_EDGES = "u bigint, v bigint"


def _edge_batch(pairs, pa):
    pairs = list(pairs)
    return pa.RecordBatch.from_pydict({"u": pa.array([p[0] for p in pairs], pa.int64()),
                                       "v": pa.array([p[1] for p in pairs], pa.int64())})


def _with_pivot(batches):
    """Rows sorted by pivot and share, the pivot's own first: links with it."""
    import pyarrow as pa

    key, pivot = None, None
    for b in batches:
        out = []
        for (v, share, own), (r, values) in _sets_in(b, "v", "share", "own"):
            if own:
                key, pivot = (v, share), Set(*r, values)
            elif pivot is not None and (v, share) == key and pair_linked(
                    Set(*r, values), pivot):
                out.append((r[0], v))
        yield _edge_batch(out, pa)


def _in_blocks(batches):
    """Rows sorted by block pair: one link for each two classes that meet."""
    import pyarrow as pa

    now, left, right = None, [], []

    def found():
        if not left or not right:
            return []
        links = {}
        for i, j in zip(*np.nonzero(block_links(left, right))):
            links.setdefault((left[i].label, right[j].label), (left[i].node, right[j].node))
        return links.values()

    for b in batches:
        out = []
        for (main, i, j, odd), (r, values) in _sets_in(b, "main", "i", "j", "odd"):
            if (main, i, j) != now:
                out += found()
                now, left, right = (main, i, j), [], []
            (left if odd else right).append(Set(*r, values))
        yield _edge_batch(out, pa)
    yield _edge_batch(found(), pa)


def components(sets: DataFrame, parts: int) -> DataFrame:
    """(row, label) of the nodes of ``sets`` that link to another; label is the least node."""
    lists = sets.select("node", F.explode(F.slice("shingles", 1, F.col("prefix").cast("int")))
                        .alias("s"))
    size = lists.groupBy("s").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    met = written(lists.join(size, "s"), "join-met")
    score = met.groupBy("node").agg(F.sum("c").alias("score"))
    met = written(met.select("node", "s").join(score, "node"), "join-met")
    rank = F.struct(F.col("score"), F.col("node"))
    pivots = written(met.groupBy("s").agg(F.max(rank)["node"].alias("v")), "join-pivots")
    # Each text against the pivot it shares most prefix shingles with.
    most = F.max(F.struct(F.col("c"), F.col("v")))["v"]
    pairs = written(
        met.join(pivots, "s").where("node <> v").groupBy("node", "v")
        .agg(F.count(F.lit(1)).alias("c")).groupBy("node").agg(most.alias("v")), "join-pairs")
    label = F.lit(0).cast("bigint").alias("label")
    body = ["node", "label", "n", "matches", "prefix", "shingles"]
    shares = pairs.groupBy("v").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("shares"))
    members = (pairs.join(shares, "v").join(sets, "node").select(
        "v", F.pmod(F.xxhash64("node"), F.col("shares")).alias("share"),
        F.lit(False).alias("own"), "node", label, "n", "matches", "prefix", "shingles"))
    own = (shares.join(sets, shares["v"] == sets["node"]).select(
        "v", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1)).alias("share"),
        F.lit(True).alias("own"), "node", label, "n", "matches", "prefix", "shingles"))
    star = written(own.unionByName(members).repartition(parts, "v", "share")
                   .sortWithinPartitions("v", "share", F.col("own").desc())
                   .mapInArrow(_with_pivot, _EDGES), "join-star")
    labels = classes(star)
    # The rest: whoever is not in the class of a list's pivot, with all texts of the lists
    # of that class.
    member = _labelled(met.select("s", F.col("node").alias("row")), labels)
    main = _labelled(pivots.select("s", F.col("v").alias("row")), labels).select(
        "s", F.col("label").alias("main"))
    member = member.join(main, "s").withColumn("odd", F.col("label") != F.col("main"))
    mixed_lists = member.where("odd").select("s").distinct()
    member = written(member.join(mixed_lists, "s", "left_semi")
                     .select("main", F.col("row").alias("node"), "label", "odd").distinct(),
                     "join-member")
    sizes = member.groupBy("main").agg(
        F.ceil(F.count_if("odd") / BLOCK).alias("odd_blocks"),
        F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    sized = member.join(sizes, "main")
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"),
                                           F.col(n) - 1))
    side = ["main", "node", "label"]
    jobs = (sized.where("odd").select(*side, block("odd_blocks").alias("i"),
                                      every("blocks").alias("j"), F.lit(True).alias("odd"))
            .unionByName(sized.select(*side, every("odd_blocks").alias("i"),
                                      block("blocks").alias("j"), F.lit(False).alias("odd"))))
    key = ["main", "i", "j"]
    more = written(jobs.join(sets, "node").select(*key, "odd", *body)
                   .repartition(parts, *key).sortWithinPartitions(*key)
                   .mapInArrow(_in_blocks, _EDGES).distinct(), "join-rest")
    return _relabelled(labels, more) if more.limit(1).count() else labels


def linked_components(docs: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Every row with ``id_col``, n_shingles (size of its set) and component_id.

    component_id is the smallest id reachable by links, itself included (null ids come
    last).  Rows are told apart even where ids repeat; equal sets always link.  A null or
    empty text and one without words has an empty set and no links: its component is its
    own id.  An empty table gives no rows; other columns take no part.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(F.col(id_col).alias("row"), text_of(text_col).alias("text"))
    kind = dict(docs.dtypes)[id_col]
    firsts = written(
        own.select("row", F.md5(F.col("text").cast("binary")).alias("body"), "text")
        .mapInArrow(_first_prefixes, f"row {kind}, body string, node bigint, n bigint, "
                                     "asked bigint, prefix array<bigint>"), "join-firsts")
    sets = shared_sets(own.select("text"), firsts, parts)
    labels = written(components(sets, parts), "join-labels")
    rows = written(firsts.where("node IS NOT NULL").select("row", "n", "node")
                   .join(labels.withColumnRenamed("row", "node"), "node", "left")
                   .select("row", "n", F.coalesce("label", "node").alias("label")), "join-rows")
    least_id = written(rows.groupBy("label").agg(F.min("row").alias("component_id")),
                       "join-least")
    return (rows.join(least_id, "label").select("row", "n", "component_id")
            .unionByName(firsts.where("node IS NULL").select(
                "row", "n", F.col("row").alias("component_id")))
            .select(F.col("row").alias(id_col), F.col("n").alias("n_shingles"),
                    "component_id"))
