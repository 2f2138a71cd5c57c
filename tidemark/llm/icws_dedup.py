"""Near-duplicates by improved consistent weighted sampling over TF-IDF word shingles.

Weights: a shingle of five words weighs its count in the text times a damped inverse
document frequency, 1 + IDF_SHARE * ln(N / df) / ln(N).  Document frequencies come from
one counter table of fixed size that covers all documents (a counting sketch less its
mean load, so that it fades to plain counts as it fills); the table is the only thing
broadcast.  Damping keeps large groups of copies, whose shared shingles are common, from
falling apart.

Steps: sample every text (150 samples, 25 bands of 6: two texts of similarity 0.8 meet
with probability 0.9995); collapse equal texts; compare every member of a band bucket
with the bucket's pivot by exact weighted Jaccard and join what is 0.8 or more into
classes.  In buckets that then hold several classes, whoever is not in the pivot's class
is compared with all members, in blocks of fixed size.  So every pair that meets and is
not in one class is decided, and no list of pairs is made.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, fresh_name, text_of, written
from tidemark.llm.text_arrays import blanks, codes_of, hashes, runs

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 6
#: Texts on each side of a block comparison.
BLOCK = 128
#: Counters of the document-frequency table (fixed: it bounds the broadcast to 4 MB).
DF_BITS = 20
DF_BLOCK = 1 << 12
IDF_SHARE = 0.25
#: Random variates are drawn from pools of so many rows, two independent rows a shingle.
POOL = 1 << 12
#: Shingles sampled at a time, which bounds a worker's memory.
CHUNK = 1 << 13

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x.astype(np.uint64) + _STEP
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def words_of(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of lower-cased texts in order (null is empty): values, offsets."""
    codes, start = codes_of([(t or "").lower() for t in texts])
    first, last = runs(~blanks(codes))
    return hashes(codes, first, last).view(np.int64), np.searchsorted(first, start)


def shingles(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of five words and the text of each; a shorter text is one run."""
    words = words.astype(np.int64).view(np.uint64)
    lengths = np.diff(offsets)
    n = np.where(lengths == 0, 0, np.maximum(lengths - SHINGLE + 1, 1))
    doc = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(offsets[:-1], n)
    end = np.repeat(offsets[1:], n)
    h = np.zeros(len(doc), np.uint64)
    for k in range(SHINGLE):
        i = at + k
        inside = i < end
        w = np.where(inside, words[np.minimum(i, max(len(words) - 1, 0))], np.uint64(k)) \
            if len(words) else h
        h = mixed(h ^ w)
    return h, doc


def counted(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) in order of both, with counts; at most 256 texts."""
    key = np.sort((doc.astype(np.uint64) << np.uint64(56)) | (h >> np.uint64(8)))
    if not len(key):
        return key, key.astype(np.int64), key.astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    n = np.diff(np.append(first, len(key)))
    key = key[first]
    return key & np.uint64((1 << 56) - 1), (key >> np.uint64(56)).astype(np.int64), n


def counter(s: np.ndarray) -> np.ndarray:
    return (s & np.uint64((1 << DF_BITS) - 1)).astype(np.int64)


def _pieces(batches):
    for b in batches:
        for at in range(0, b.num_rows, 256):
            part = b.slice(at, 256)
            yield part, *words_of(part.column("text").to_pylist())


def _count_df(batches):
    import pyarrow as pa

    table = np.zeros(1 << DF_BITS, np.int64)
    for _, words, offsets in _pieces(batches):
        s, _, _ = counted(*shingles(words, offsets))
        table += np.bincount(counter(s), minlength=len(table))
    yield pa.RecordBatch.from_pydict({
        "block": pa.array(range(len(table) // DF_BLOCK), pa.int32()),
        "counts": pa.array([x.astype("<i8").tobytes() for x in table.reshape(-1, DF_BLOCK)],
                           pa.binary())})


def _add_blocks(batches):
    """Adds up the blocks that come, one array per block, however many tasks sent one."""
    import pyarrow as pa

    total: dict[int, np.ndarray] = {}
    for b in batches:
        for block, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            total[block] = total.get(block, 0) + np.frombuffer(counts, "<i8")
    yield pa.RecordBatch.from_pydict({
        "block": pa.array(total, pa.int32()),
        "counts": pa.array([x.tobytes() for x in total.values()], pa.binary())})


def idf_table(texts: DataFrame) -> np.ndarray:
    """Damped idf by counter, from every row of ``texts``."""
    kind = "block int, counts binary"
    blocks = (texts.select("text").mapInArrow(_count_df, kind)
              .repartition("block").mapInArrow(_add_blocks, kind).collect())
    df = np.zeros(1 << DF_BITS, np.float64)
    for b in blocks:
        df[b["block"] * DF_BLOCK:(b["block"] + 1) * DF_BLOCK] = np.frombuffer(b["counts"], "<i8")
    n = max(texts.count(), 3)
    df = np.clip(df - df.mean(), 1, n)
    return (1 + IDF_SHARE * np.log(n / df) / np.log(n)).astype(np.float32)


def _pools() -> tuple[np.ndarray, ...]:
    """r, 1/r and beta by the first pool row, ln c by the second (r, c: gamma(2, 1))."""
    k = BANDS * ROWS
    u = (mixed(np.arange(5 * POOL * k, dtype=np.uint64)) >> np.uint64(11)).astype(np.float64)
    u = ((u + 0.5) / 2.0 ** 53).reshape(5, POOL, k)
    r, c = -np.log(u[0] * u[1]), -np.log(u[2] * u[3])
    f = np.float32
    return r.astype(f), (1 / r).astype(f), u[4].astype(f), np.log(c).astype(f)


def bands_of(words: np.ndarray, offsets: np.ndarray, idf: np.ndarray, pools) -> np.ndarray:
    """Band hashes of each text, [texts, BANDS]; texts without words have zeros."""
    r_pool, inv_pool, beta_pool, lnc_pool = pools
    k, n_docs = BANDS * ROWS, len(offsets) - 1
    s, doc, n = counted(*shingles(words, offsets))
    best = np.full((n_docs, k), np.iinfo(np.uint64).max, np.uint64)
    lnw = np.log(n * idf[counter(s)]).astype(np.float32)
    m = mixed(s)
    row1 = (m & np.uint64(POOL - 1)).astype(np.int64)
    row2 = ((m >> np.uint64(32)) & np.uint64(POOL - 1)).astype(np.int64)
    for at in range(0, len(s), CHUNK):
        z = slice(at, at + CHUNK)
        r, beta = r_pool[row1[z]], beta_pool[row1[z]]
        t = np.floor(lnw[z, None] * inv_pool[row1[z]] + beta)
        a = lnc_pool[row2[z]] - r * (t - beta + 1) + np.float32(64)
        # Positive floats sort as their bits do; the low half names the shingle.
        code = a.view(np.uint32).astype(np.uint64) << np.uint64(32)
        code |= np.arange(at, at + len(a), dtype=np.uint64)[:, None]
        d = doc[z]
        first = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
        least = np.minimum.reduceat(code, first, axis=0)
        best[d[first]] = np.minimum(best[d[first]], least)
    some = np.diff(offsets) > 0
    out = np.zeros((n_docs, BANDS), np.uint64)
    if some.any():
        e = (best[some] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        cols = np.arange(k)
        t = np.floor(lnw[e] * inv_pool[row1[e], cols] + beta_pool[row1[e], cols])
        sample = mixed(s[e] ^ (t.astype(np.int64).view(np.uint64) << np.uint64(48)))
        h = np.zeros((len(e), BANDS), np.uint64)
        for j in range(ROWS):
            h = mixed(h ^ sample.reshape(-1, BANDS, ROWS)[:, :, j])
        out[some] = h
    return out


def sample(texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """(row, text) -> (row, bands); texts without words have no bands."""
    shared = texts.sparkSession.sparkContext.broadcast(idf)

    def run(batches):
        import pyarrow as pa

        pools = _pools()
        for part, words, offsets in _pieces(batches):
            bands = bands_of(words, offsets, shared.value, pools).view(np.int64)
            some = (np.diff(offsets) > 0).tolist()
            yield pa.RecordBatch.from_pydict({
                "row": part.column("row"),
                "bands": pa.array([b.tolist() if x else [] for b, x in zip(bands, some)],
                                  pa.list_(pa.int64()))})

    return texts.select("row", "text").mapInArrow(run, "row bigint, bands array<bigint>")


def similarity(a: np.ndarray, b: np.ndarray, idf: np.ndarray) -> float:
    """Weighted Jaccard similarity of two texts, given as word hashes."""
    return _jaccard(_weights(a, idf), _weights(b, idf))


def _weights(words: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s, _, n = counted(*shingles(words, np.array([0, len(words)])))
    return s, n * idf[counter(s)].astype(np.float64)


def _jaccard(a, b) -> float:
    (sa, wa), (sb, wb) = a, b
    i = np.minimum(np.searchsorted(sb, sa), max(len(sb) - 1, 0))
    same = sb[i] == sa if len(sb) else np.zeros(len(sa), bool)
    low = np.minimum(wa[same], wb[i[same]]).sum() if len(sb) else 0.0
    high = wa.sum() + wb.sum() - low
    return float(low / high) if high > 0 else 1.0


def compared(pairs: DataFrame, texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """(u, v) with their exact similarity.  ``texts`` has row and text."""
    shared = pairs.sparkSession.sparkContext.broadcast(idf)
    body = texts.select("row", "text")
    both = (pairs.join(body.select(F.col("row").alias("u"), F.col("text").alias("u_text")), "u")
            .join(body.select(F.col("row").alias("v"), F.col("text").alias("v_text")), "v"))
    both = both.select("u", "v", "u_text", "v_text")

    def run(batches):
        import pyarrow as pa

        last, known = None, None
        for p in batches:
            av, ao = words_of(p.column("u_text").to_pylist())
            sims = []
            for i, v in enumerate(p.column("v").to_pylist()):
                if v != last:
                    text = p.column("v_text")[i].as_py()
                    last, known = v, _weights(words_of([text])[0], shared.value)
                sims.append(_jaccard(_weights(av[ao[i]:ao[i + 1]], shared.value), known))
            yield pa.RecordBatch.from_pydict({"u": p.column("u"), "v": p.column("v"),
                                              "sim": pa.array(sims, pa.float64())})

    return both.mapInArrow(run, "u bigint, v bigint, sim double")


def classes(edges: DataFrame) -> DataFrame:
    """Connected components of (u, v): (row, label), label the smallest row.

    Alternates two steps until nothing changes: every node's larger neighbours move to
    its smallest neighbour, then its smaller neighbours and itself do.  Rows stay as many
    as the edges and a node's neighbours are never gathered: only their minimum is.
    """
    both = lambda e: e.select("u", "v").unionByName(
        e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    edges = written(edges.select(F.greatest("u", "v").alias("u"),
                                 F.least("u", "v").alias("v")).where("u <> v").distinct(),
                    "edges")
    while True:
        near = both(edges)
        low = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (near.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").unionByName(low.select("u", F.col("m").alias("v"))))
        new = written(small.distinct(), "edges")
        # A forest of stars that both steps leave alone has no row that is both ends.
        changed = new.join(new.select(F.col("v").alias("u")).distinct(), "u",
                           "left_semi").limit(1).count() or \
            new.groupBy("u").count().where("count > 1").limit(1).count()
        edges = new
        if not changed:
            return edges.select(F.col("u").alias("row"), F.col("v").alias("label"))


def joined(sampled: DataFrame, groups: DataFrame, base: DataFrame, idf: np.ndarray,
           threshold: float) -> DataFrame:
    """(row, label) of the distinct texts that are near another."""
    bands = (sampled.join(groups.select(F.col("t").alias("row")), "row", "left_semi")
             .select("row", F.posexplode("bands").alias("band", "hash")))
    buckets = (bands.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("n"))
               .where("n > 1"))
    met = written(bands.join(buckets, ["band", "hash"]), "near-met")
    # The text that meets the most others is a bucket's pivot: of a group of edited
    # copies, the one they were edited from.
    score = met.groupBy("row").agg(F.sum("n").alias("score"))
    texts = written(base.select("row", "text").join(score, "row"), "near-met-texts")
    met = written(met.select("band", "hash", "row").join(score, "row"), "near-met")
    rank = F.struct(F.col("score"), (-F.col("row")).alias("back"))
    pivot = written(met.groupBy("band", "hash").agg((-F.max(rank)["back"]).alias("f")),
                    "near-pivots")
    pairs = (met.join(pivot, ["band", "hash"]).where("row <> f")
             .select(F.col("row").alias("u"), F.col("f").alias("v")).distinct())
    star = written(compared(pairs, texts, idf).where(F.col("sim") >= threshold), "near-star")
    label = classes(star)
    # The rest: in buckets of several classes, whoever is not in the pivot's class
    # against all members, in blocks.
    members = _labelled(met.select("band", "hash", "row"), label)
    main = _labelled(pivot.select("band", "hash", F.col("f").alias("row")), label).select(
        "band", "hash", F.col("label").alias("main"))
    members = written(members.join(main, ["band", "hash"]).withColumn(
        "odd", F.col("label") != F.col("main")).drop("main"), "near-members")
    sizes = members.groupBy("band", "hash").agg(
        F.ceil(F.count_if("odd") / BLOCK).alias("odd_blocks"),
        F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")).where("odd_blocks > 0")
    sized = members.join(sizes, ["band", "hash"])
    own = F.xxhash64("row")
    block = lambda n: F.pmod(own, F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"),
                                           F.col(n) - 1))
    side = ["band", "hash", "row", "label"]
    jobs = (sized.where("odd").select(*side, block("odd_blocks").alias("i"),
                                      every("blocks").alias("j"), F.lit(True).alias("left"))
            .unionByName(sized.select(*side, every("odd_blocks").alias("i"),
                                      block("blocks").alias("j"), F.lit(False).alias("left"))))
    more = written(_in_blocks(jobs.join(texts, "row"), idf, threshold).distinct(),
                   "near-rest")
    return _relabelled(label, more) if more.limit(1).count() else label


def _in_blocks(jobs: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame:
    """Classes with near members in a block pair: (u, v), one pair of rows for each two.

    A block pair (band, hash, i, j) has about 2 * BLOCK texts, whatever its bucket's size.
    """
    shared = jobs.sparkSession.sparkContext.broadcast(idf)
    key = ["band", "hash", "i", "j"]
    rows = jobs.select(*key, "left", "row", "label", "text")

    def near(group):
        left = [x for x in group if x[0]]
        right = [x for x in group if not x[0]]
        sims = block_similarity([x[3] for x in left], [x[3] for x in right])
        found = {}
        for a, b in zip(*np.nonzero(sims >= threshold)):
            if left[a][2] != right[b][2]:
                found.setdefault((left[a][2], right[b][2]), (left[a][1], right[b][1]))
        return found.values()

    def run(batches):
        import pyarrow as pa

        now, group = None, []
        for b in batches:
            words, offsets = words_of(b.column("text").to_pylist())
            keys = list(zip(*(b.column(k).to_pylist() for k in key)))
            cols = list(zip(*(b.column(k).to_pylist() for k in ("left", "row", "label"))))
            out = []
            for i, (k, c) in enumerate(zip(keys, cols)):
                if k != now:
                    out += near(group)
                    now, group = k, []
                group.append((*c, _weights(words[offsets[i]:offsets[i + 1]], shared.value)))
            yield _pair_batch(out, pa)
        yield _pair_batch(near(group), pa)

    # A fixed number of tasks: the work grows with the comparisons, not with the bytes.
    tasks = int(jobs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(tasks, *key).sortWithinPartitions(*key)
            .mapInArrow(run, "u bigint, v bigint"))


def _pair_batch(pairs, pa):
    pairs = list(pairs)
    return pa.RecordBatch.from_pydict({"u": pa.array([p[0] for p in pairs], pa.int64()),
                                       "v": pa.array([p[1] for p in pairs], pa.int64())})


def block_similarity(left: list, right: list) -> np.ndarray:
    """Weighted Jaccard of all texts of two blocks, each given by its sorted weights."""
    low = np.zeros((len(left), len(right)))
    if low.size == 0:
        return low
    if low.size <= 64:
        return np.array([[_jaccard(a, b) for b in right] for a in left])

    def flat(side):
        s = np.concatenate([x[0] for x in side])
        d = np.repeat(np.arange(len(side)), [len(x[0]) for x in side])
        w = np.concatenate([x[1] for x in side])
        o = np.argsort(s, kind="stable")
        return s[o], d[o], w[o]

    (s1, d1, w1), (s2, d2, w2) = flat(left), flat(right)
    both = np.intersect1d(s1, s2)
    a0, a1 = np.searchsorted(s1, both), np.searchsorted(s1, both, "right")
    b0, b1 = np.searchsorted(s2, both), np.searchsorted(s2, both, "right")
    for p, q, x, y in zip(a0, a1, b0, b1):
        low[d1[p:q, None], d2[None, x:y]] += np.minimum(w1[p:q, None], w2[None, x:y])
    high = (np.array([x[1].sum() for x in left])[:, None]
            + np.array([x[1].sum() for x in right])[None, :] - low)
    return low / np.where(high > 0, high, 1)


def _labelled(rows: DataFrame, label: DataFrame) -> DataFrame:
    """Rows with their class; a row that is near none is its own."""
    return rows.join(label.withColumnRenamed("label", "of"), "row", "left").withColumn(
        "label", F.coalesce("of", "row")).drop("of")


def _relabelled(label: DataFrame | None, edges: DataFrame) -> DataFrame:
    edges = edges.select("u", "v")
    if label is not None:
        edges = edges.unionByName(label.select(F.col("row").alias("u"),
                                               F.col("label").alias("v")))
    return classes(edges)


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD, carry: bool = False) -> DataFrame:
    """Every row with its class: ``id_col``, class_id, kept; with ``carry`` all columns.

    class_id is the smallest id of the class (null ids last) and ``kept`` marks its row;
    of repeated rows with that id one is marked.  Texts equal up to case and white space
    are one text, null is the empty text, and texts without words are one class.  A text
    of fewer than five words has its whole word sequence as its only shingle.  An empty
    table gives no rows.  Names that clash get trailing underscores.
    """
    others = [c for c in docs.columns if c not in (id_col, text_col)] if carry else []
    norm = F.lower(F.trim(F.regexp_replace(text_of(text_col), SPACE, " ")))
    base = written(docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"),
        F.struct(*[F.col(c) for c in others], F.lit(0).alias("_")).alias("rest"),
        F.md5(norm.cast("binary")).alias("same"),
        F.monotonically_increasing_id().alias("row")), "near-base")
    idf = idf_table(base)
    groups = written(base.groupBy("same").agg(F.min("row").alias("t")), "near-texts")
    sampled = written(sample(base, idf), "near-bands")
    label = written(joined(sampled, groups, base, idf, threshold), "near-label")
    # Rows -> texts -> classes; written, so that the last join can be split where one
    # text holds a large share of the rows.
    of_text = written(
        groups.join(label.select(F.col("row").alias("t"), "label"), "t", "left")
        .select("same", F.coalesce("label", "t").alias("label")), "near-of-text")
    rows = written(base.select("row", "id", "same").join(of_text, "same")
                   .select("row", "id", "label"), "near-rows")
    keep = (rows.groupBy("label").agg(F.min(F.struct(
        F.col("id").isNull().alias("no_id"), F.col("id").alias("id"),
        F.col("row").alias("row"))).alias("k"))
        .select("label", F.col("k.id").alias("class_id"), F.col("k.row").alias("keep_row")))
    decided = rows.join(written(keep, "near-keep"), "label").select(
        "row", "id", "class_id", (F.col("row") == F.col("keep_row")).alias("kept"))
    if not carry:
        return decided.select(F.col("id").alias(id_col), "class_id", "kept")
    names = {n: fresh_name(n, docs.columns) for n in ("class_id", "kept")}
    return base.join(decided.drop("id"), "row").select(
        F.col("id").alias(id_col), F.col("text").alias(text_col),
        *[F.col("rest").getField(c).alias(c) for c in others],
        F.col("class_id").alias(names["class_id"]), F.col("kept").alias(names["kept"]))


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each class, with the columns that ``docs`` has."""
    kept = fresh_name("kept", docs.columns)
    return near_classes(docs, carry=True).where(F.col(kept)).select(*docs.columns)
