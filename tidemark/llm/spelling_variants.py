"""Spelling variants: words one edit apart, by search schemes over a bidirectional FM-index.

A word near another agrees with one of its halves exactly.  Two searches cover all cases:
match the left half from the word's start and go on to the right with one error, and match
the right half from the word's end and go on to the left with one error.  The first runs
on the index of the reversed delimited vocabulary, the second on the index of the
vocabulary itself; both are the same backward search over suffix-rank intervals, for
thousands of queries at a time.

The vocabulary is dealt into buckets by the two letters at the exact end, which both words
share, so a query meets only the index of its own bucket.  A bucket that is too large for
one index is cut into blocks; every block's queries meet every block's index, as jobs of
their own.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: Letters at a word's ends that decide its buckets; a half has as many at least.
ENDS = 2
SHORTEST = 2 * ENDS
#: Words of a bucket on average, and at most in one index.
BUCKET, BLOCK = 1 << 13, 1 << 16
#: Queries searched at a time, and the width from which an interval is read by letter.
CHUNK, WIDE = 1 << 12, 256


class Index:
    """FM-index of delimited strings, given as rows of letter numbers (0 fills up).

    Delimiters are smaller than letters and differ by place, so suffixes are compared
    within their own string only.
    """

    def __init__(self, z: np.ndarray, lengths: np.ndarray):
        n_words, width = z.shape
        inside = np.arange(width + 1) <= lengths[:, None]
        text = np.zeros((n_words, width + 1), np.uint16)
        text[:, :width] = z
        text = text[inside]
        m = len(text)
        owner = np.repeat(np.arange(n_words), lengths + 1)
        rank = np.where(text == 0, owner, n_words + text.astype(np.int64))
        order, reach = np.argsort(rank, kind="stable"), 1
        while reach <= width:
            later = np.zeros(m, np.int64)
            later[:-reach] = rank[reach:]
            key = rank * (m + n_words + (1 << 16)) + later
            order = np.argsort(key, kind="stable")
            key = key[order]
            rank = np.empty(m, np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
            reach *= 2
        self.n_words, self.m, self.letters = n_words, m, int(z.max(initial=0))
        self.bwt = text[order - 1]
        self.bwt[order == 0] = 0
        rows = np.argsort(self.bwt, kind="stable")
        #: Row by (letter before it, row): its place there is where that letter leads.
        self.by_letter = self.bwt[rows].astype(np.int64) * (m + 1) + rows
        self.step = np.empty(m, np.int64)
        self.step[rows] = np.arange(m)
        self.start_of = owner[order]

    def left(self, c, lo, hi):
        """Intervals of c + the strings of [lo, hi); empty ones too."""
        one = hi - lo == 1
        a, b = np.empty(len(lo), np.int64), np.empty(len(lo), np.int64)
        r = lo[one]
        a[one] = self.step[r]
        b[one] = a[one] + (self.bwt[r] == c[one])
        more = ~one
        base = c[more] * (self.m + 1)
        a[more] = np.searchsorted(self.by_letter, base + lo[more])
        b[more] = np.searchsorted(self.by_letter, base + hi[more])
        return a, b

    def children(self, lo, hi):
        """Every letter before each interval: (which, letter, interval)."""
        wide = hi - lo > WIDE
        s = np.flatnonzero(~wide)
        n = hi[s] - lo[s]
        which = np.repeat(s, n)
        row = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[s], n)
        c = self.bwt[row].astype(np.int64)
        some = c > 0
        which, row, c = which[some], row[some], c[some]
        order = np.argsort(which * (self.letters + 1) + c, kind="stable")
        which, row, c = which[order], row[order], c[order]
        first = np.flatnonzero((np.diff(which, prepend=-1) != 0) | (np.diff(c, prepend=-1) != 0))
        count = np.diff(np.append(first, len(which)))
        a = self.step[row[first]]
        which, c, b = which[first], c[first], a + count
        w = np.flatnonzero(wide)
        if len(w):
            ww = np.repeat(w, self.letters)
            cc = np.tile(np.arange(1, self.letters + 1), len(w))
            x, y = self.left(cc, lo[ww], hi[ww])
            some = y > x
            which, c = np.append(which, ww[some]), np.append(c, cc[some])
            a, b = np.append(a, x[some]), np.append(b, y[some])
        return which, c, a, b

    def whole(self, lo, hi):
        """The strings that start where [lo, hi) do: (which interval, string)."""
        a = np.searchsorted(self.by_letter, lo)
        b = np.searchsorted(self.by_letter, hi)
        a, b = np.minimum(a, self.n_words), np.minimum(b, self.n_words)
        n = b - a
        which = np.repeat(np.arange(len(lo)), n)
        at = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)
        return which, self.start_of[self.by_letter[at]]

    def near(self, z: np.ndarray, lengths: np.ndarray, exact: np.ndarray):
        """(query, string) where the string ends in the query's last ``exact`` letters and
        the rest is one edit apart; each pair once."""
        border = lengths - exact
        lo = np.zeros(len(z), np.int64)
        hi = np.full(len(z), self.n_words, np.int64)
        for k in range(int(exact.max(initial=0))):
            q = np.flatnonzero((k < exact) & (hi > lo))
            lo[q], hi[q] = self.left(z[q, lengths[q] - 1 - k].astype(np.int64), lo[q], hi[q])
        q = np.flatnonzero(hi > lo)
        i, lo, hi = border[q], lo[q], hi[q]
        none = np.zeros(0, np.int64)
        fq, fi, flo, fhi = none, none, none, none
        out_q, out_x = [none], [none]
        letter = lambda q, i: z[q, np.maximum(i, 0)].astype(np.int64)
        while len(q) or len(fq):
            if len(q):
                # The letter matched last, unless it is in the exact half: an edit next to
                # an equal letter is the same as one a place further, made before.
                last = np.where(i < border[q], letter(q, i), 0)
                s, c, a, b = self.children(lo, hi)
                sub = (i[s] > 0) & (c != letter(q[s], i[s] - 1))
                ins = c != last[s]
                gone = (i > 0) & (letter(q, i - 1) != last)
                fq = np.concatenate([fq, q[s[sub]], q[s[ins]], q[gone]])
                fi = np.concatenate([fi, i[s[sub]] - 1, i[s[ins]], i[gone] - 1])
                flo = np.concatenate([flo, a[sub], a[ins], lo[gone]])
                fhi = np.concatenate([fhi, b[sub], b[ins], hi[gone]])
                on = i > 0
                q, i, lo, hi = q[on], i[on] - 1, lo[on], hi[on]
                lo, hi = self.left(letter(q, i), lo, hi)
                on = hi > lo
                q, i, lo, hi = q[on], i[on], lo[on], hi[on]
            end = fi == 0
            which, x = self.whole(flo[end], fhi[end])
            out_q.append(fq[end][which])
            out_x.append(x)
            fq, fi, flo, fhi = fq[~end], fi[~end] - 1, flo[~end], fhi[~end]
            flo, fhi = self.left(letter(fq, fi), flo, fhi)
            on = fhi > flo
            fq, fi, flo, fhi = fq[on], fi[on], flo[on], fhi[on]
        pair = np.unique(np.concatenate(out_q) * max(self.n_words, 1) + np.concatenate(out_x))
        return pair // max(self.n_words, 1), pair % max(self.n_words, 1)


def letters_of(words: list[str], alphabet: np.ndarray | None = None):
    """Rows of letter numbers from 1, the words' lengths and the alphabet."""
    lengths = np.array([len(w) for w in words], np.int64)
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    if alphabet is None:
        alphabet = np.unique(flat)
    z = np.zeros((len(words), int(lengths.max(initial=1))), np.uint16)
    z[np.arange(z.shape[1]) < lengths[:, None]] = np.searchsorted(alphabet, flat) + 1
    return z, lengths, alphabet


def reversed_rows(z: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    at = lengths[:, None] - 1 - np.arange(z.shape[1])
    return np.where(at >= 0, np.take_along_axis(z, np.maximum(at, 0), 1), 0).astype(np.uint16)


def near_pairs(indexed: list[str], queries: list[str], side: int):
    """(query, indexed) numbers of words one edit apart that the search of ``side`` finds.

    Side 0 keeps the query's left half, side 1 the right half; side 1 leaves out what
    side 0 finds too.  Given in chunks of queries.
    """
    _, _, alphabet = letters_of(indexed + queries)
    x, x_len, _ = letters_of(indexed, alphabet)
    w, w_len, _ = letters_of(queries, alphabet)
    index = Index(reversed_rows(x, x_len) if side == 0 else x, x_len)
    for at in range(0, len(queries), CHUNK):
        z, n = w[at:at + CHUNK], w_len[at:at + CHUNK]
        half = n // 2
        if side == 0:
            q, found = index.near(reversed_rows(z, n), n, half)
        else:
            q, found = index.near(z, n, n - half)
            other = np.zeros(len(q), bool)
            for k in range(min(int(half.max(initial=0)), x.shape[1])):
                other |= (k < half[q]) & (z[q, k] != x[found, k])
            q, found = q[other], found[other]
        yield q + at, found


_FOUND = "word string, n_near bigint, form_n bigint, form string"


def _search(batches):
    """Jobs sorted by bucket and blocks in; per query word how many are near and the best."""
    import pyarrow as pa

    now, rows = None, []

    def done():
        if not rows:
            return
        side = now[0] & 1
        indexed = sorted(((-n, w) for kind, w, n in rows if kind != 1))
        queries = [w for kind, w, _ in rows if kind != 0]
        names = [w for _, w in indexed]  # by falling count, then by code point
        for q, found in near_pairs(names, queries, side):
            if not len(q):
                continue
            first = np.flatnonzero(np.diff(q, prepend=-1) != 0)
            best = np.minimum.reduceat(found, first)
            yield pa.RecordBatch.from_pydict({
                "word": pa.array([queries[k] for k in q[first].tolist()], pa.string()),
                "n_near": pa.array(np.diff(np.append(first, len(q))), pa.int64()),
                "form_n": pa.array([-indexed[k][0] for k in best.tolist()], pa.int64()),
                "form": pa.array([names[k] for k in best.tolist()], pa.string())})

    for b in batches:
        cols = [b.column(k).to_pylist() for k in ("bucket", "i", "j", "kind", "word", "n")]
        for bucket, i, j, kind, word, n in zip(*cols):
            if (bucket, i, j) != now:
                yield from done()
                now, rows = (bucket, i, j), []
            rows.append((kind, word, n))
    yield from done()


def near_words(words: DataFrame, bucket_words: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """Of distinct words (word, n): word, n_near, form_n, form; words with none are left out.

    Near words differ by exactly one inserted, deleted or replaced code point; form is the
    near word of largest n, the smallest by code points of several.  Words need four code
    points (``SHORTEST``); null and shorter ones take no part.
    """
    words = words.where(F.length("word") >= SHORTEST)
    buckets = max(1, -(-words.count() // bucket_words))
    sided = words.select("word", "n", F.posexplode(F.array(
        F.left("word", F.lit(ENDS)), F.right("word", F.lit(ENDS)))).alias("side", "end"))
    sided = sided.select("word", "n", (F.pmod(F.xxhash64("side", "end"), F.lit(buckets)) * 2
                                       + F.col("side")).alias("bucket"))
    sizes = sided.groupBy("bucket").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(block)).alias("blocks"))
    own = F.pmod(F.xxhash64("word"), F.col("blocks"))
    dealt = sided.join(sizes, "bucket").select(
        "bucket", "word", "n", own.alias("own"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other"))
    same = F.col("own") == F.col("other")
    # Kind 0 is indexed, 1 asks, 2 does both.
    jobs = dealt.select("bucket", "word", "n", F.inline(F.when(same, F.array(
        F.struct(F.col("own").alias("i"), F.col("own").alias("j"), F.lit(2).alias("kind"))))
        .otherwise(F.array(
            F.struct(F.col("own").alias("i"), F.col("other").alias("j"), F.lit(0).alias("kind")),
            F.struct(F.col("other").alias("i"), F.col("own").alias("j"),
                     F.lit(1).alias("kind"))))))
    key = ["bucket", "i", "j"]
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (jobs.repartition(tasks, *key).sortWithinPartitions(*key)
             .mapInArrow(_search, _FOUND))
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
            .select("word", "n_near", (-F.col("best.less")).alias("form_n"),
                    F.col("best.form").alias("form")))


def followed(forms: DataFrame) -> DataFrame:
    """(word, form) -> (word, root): the last word that following forms reaches.

    A form's count is at least twice its word's, so chains are short; each round doubles
    the steps taken.
    """
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = written(now.join(ahead, "root", "left")
                      .select("word", F.coalesce("next", "root").alias("root"),
                              F.col("next").isNotNull().alias("moved")), "roots")
        now = new.select("word", "root")
        if not new.where("moved").limit(1).count():
            return now


def variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """Every row of (word, n), distinct words: word, form, root, n, n_near, form_n.

    form is the near word of largest n if that n is at least ``ratio`` times the word's,
    else null with form_n; root follows forms to the end.  Null words are left out; an
    empty table gives no rows; other columns take no part.
    """
    words = written(words.select("word", F.col("n").cast("bigint").alias("n"))
                    .where(F.col("word").isNotNull()), "words")
    near = words.join(near_words(words), "word", "left")
    strong = F.col("form_n") >= ratio * F.col("n")
    out = written(near.select(
        "word", F.when(strong, F.col("form")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(strong, F.col("form_n")).alias("form_n")), "words-near")
    roots = followed(out.where("form IS NOT NULL"))
    return out.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: Fixed values of the contract's words.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(word: Column) -> Column:
    """Only A-Z in lower case."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(
        F.translate(word, UPPER, LOWER))


def vocabulary(docs: DataFrame, least_length: int = 5, least_count: int = 3,
               damage: int | None = None, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(word, n): the runs of letters of all whole texts, A-Z in lower case, and how often.

    With ``damage`` a run loses its code point h % length where ``damage`` divides h, the
    crc32 of ``id:run`` (a null id is empty).  Null and empty texts have no runs; repeated
    rows count each.
    """
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(text_col), F.lit(RUN), F.lit(0))).alias("run"))
    if damage is None:
        words = runs.select(lower_ascii(F.col("run")).alias("word"))
    else:
        low = runs.select("id", lower_ascii(F.col("run")).alias("run")).select(
            "run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
        at = (F.col("h") % F.length("run")).cast("int")
        words = low.select(F.when(F.col("h") % damage == 0, F.concat(
            F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run"))))
            .otherwise(F.col("run")).alias("word"))
    return (words.where(F.length("word") >= least_length).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count))
