"""SentencePiece encoding and decoding by max-plus algebra over a piece vocabulary.

A text is encoded as the sequence of pieces of the highest total score (Viterbi).  Scores
are whole numbers, so sums are exact and may be combined in any order.  A vocabulary
file of ranks (merge order) is read as ``-round(64 * ln(rank + 2))``, Zipf's law for
pieces in order of frequency; log probabilities are read as ``round(64 * score)``.
Ties go to the longer last piece.  Characters without a piece, and a literal lower block
(U+2581, which stands for the space), become byte pieces, so decoding gives every text
back exactly.

Ordinary texts are cut before each space (no piece of the vocabulary has a space after
another character, so every path passes there) and a batch's distinct words are solved
together, one position of all words at a time.

Giant texts are split into chunks of CHUNK characters, which are rows of their own.  A
piece may cross a chunk's border, so the state there is how far the next piece boundary
lies behind it, 0 to L - 1 characters.  Each chunk gives the L x L matrix of best scores
from entry to exit state; matrices combine associatively under (max, +); the best states
at all borders follow, and each chunk is traced back on its own between its two states.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tidemark.llm.common import fresh_name, list_parts, text_of, written

#: Characters of a chunk; longer texts are split.
CHUNK = 1 << 15
SPACE = "▁"
NONE = np.int64(-(1 << 60))
LOW = -(1 << 30)  # no piece
_UNIT = re.compile(f"{SPACE}+[^{SPACE}]*|^[^{SPACE}]+")
#: Stands for a literal lower block while a text is encoded; no valid text holds it.
_LITERAL = "\ud800"


class Vocabulary:
    """Pieces, whole-number scores and a trie as sorted arrays; small and picklable."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: dict[int, int],
                 control: set[int]):
        usable = [i for i in range(len(pieces)) if i not in control
                  and i not in set(byte_ids.values()) and pieces[i]]
        raw = np.array([scores[i] for i in usable], np.float64)
        ranks = np.all(raw <= 0) and np.all(raw == np.round(raw)) and raw.min() < -100
        whole = -np.round(64 * np.log(2 - raw)) if ranks else np.round(64 * raw)
        self.pieces, self.bytes = pieces, np.array([byte_ids[b] for b in range(256)], np.int32)
        self.byte_of = {i: b for b, i in byte_ids.items()}
        self.control = control
        self.longest = max(len(pieces[i]) for i in usable)
        self.unknown = int(whole.min()) - 10
        self.cut = not any(SPACE in pieces[i].lstrip(SPACE) for i in usable)
        shown = [p.replace(SPACE, " ") for p in pieces]
        for i in control:
            shown[i] = ""
        for b, i in byte_ids.items():
            shown[i] = chr(b) if b < 128 else ""
        self.shown = np.array(shown, object)
        self.high = np.zeros(len(pieces), bool)  # bytes of characters of several bytes
        self.high[[i for b, i in byte_ids.items() if b >= 128]] = True
        nodes, keys, ids = {"": 0}, {}, {}
        for i, s in zip(usable, whole):
            for k in range(1, len(pieces[i]) + 1):
                p = pieces[i][:k]
                if p not in nodes:
                    nodes[p] = len(nodes)
                    keys[(nodes[p[:-1]] << 21) | ord(p[-1])] = nodes[p]
            ids[nodes[pieces[i]]] = (i, int(s))
        order = sorted(keys)
        self.keys = np.array(order, np.int64)
        self.next = np.array([keys[k] for k in order], np.int64)
        self.piece_at = np.full(len(nodes), -1, np.int32)
        self.score_at = np.full(len(nodes), NONE, np.int64)
        for n, (i, s) in ids.items():
            self.piece_at[n], self.score_at[n] = i, s

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read a model file (bounded: a vocabulary) on the driver."""
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = range(sp.get_piece_size())
        control = {i for i in n if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
        return cls([sp.id_to_piece(i) for i in n], [sp.get_score(i) for i in n],
                   {int(sp.id_to_piece(i)[1:-1], 16): i for i in n if sp.is_byte(i)}, control)

    def edges(self, codes: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and pieces by end position and length: column 0 the longest.

        ``codes`` are characters, ``end`` the end of each one's word.  Row p has the
        pieces that end before position p.
        """
        n, longest = len(codes), self.longest
        score = np.full((n + 1, longest), LOW, np.int32)
        piece = np.full((n + 1, longest), -1, np.int32)
        at, node = np.arange(n), np.zeros(n, np.int64)
        for k in range(longest):
            inside = at + k < end[at]
            at, node = at[inside], node[inside]
            key = (node << 21) | codes[at + k]
            i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[i] == key
            at, node = at[found], self.next[i[found]]
            last = self.piece_at[node] >= 0
            score[at[last] + k + 1, longest - 1 - k] = self.score_at[node[last]]
            piece[at[last] + k + 1, longest - 1 - k] = self.piece_at[node[last]]
        alone = np.flatnonzero(piece[1:, -1] < 0) + 1
        score[alone, -1] = self.unknown
        return score, piece


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


def marked(text: str) -> str:
    """Spaces as lower blocks; literal lower blocks as a character without a piece."""
    return text.replace(SPACE, _LITERAL).replace(" ", SPACE)


def _spelled(v: Vocabulary, code: int) -> list[int]:
    ch = chr(code) if code != ord(_LITERAL) else SPACE
    return [int(v.bytes[b]) for b in ch.encode()]


def _solved(v: Vocabulary, words: list[str]):
    """Words by falling length: their order, best scores, numbers of pieces and all pieces
    in a row.  All words are solved a position at a time."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    codes = _codes("".join([words[i] for i in order.tolist()]))
    start = np.cumsum(lengths) - lengths
    score, piece = v.edges(codes, np.repeat(start + lengths, lengths))
    # Nodes of word w are start[w] + w + (0 .. length).
    base, longest = start + np.arange(len(words)), v.longest
    best = np.full(len(codes) + len(words) + longest, NONE, np.int64)
    took = np.zeros(len(best), np.int8)
    best[base + longest] = 0
    back = np.arange(longest)  # column c is the piece of length longest - c
    lives = np.searchsorted(-lengths, -np.arange(1, int(lengths[0]) + 1), "right").tolist()
    for j, live in enumerate(lives, 1):
        node, first = base[:live] + j, max(longest - j, 0)
        total = best[node[:, None] + back[first:]]
        total += score[start[:live] + j, first:]
        c = np.argmax(total, axis=1)
        best[node + longest] = total[np.arange(live), c]
        took[node + longest] = longest - first - c
    # Back from each word's end; the pieces are put down where they end.
    put = np.full(len(codes) + len(words), LOW, np.int32)
    at, owner = lengths.copy(), np.arange(len(words))
    while len(at):
        n = took[base[owner] + at + longest].astype(np.int64)
        put[base[owner] + at] = piece[start[owner] + at, longest - n]
        at = at - n
        owner, at = owner[at > 0], at[at > 0]
    ends = np.flatnonzero(put > LOW)
    flat = put[ends]
    owner = np.searchsorted(base, ends, "right") - 1
    size = np.ones(len(flat), np.int64)
    rough = np.flatnonzero(flat < 0)
    if len(rough):
        # Node ends[i] of word w is behind the character ends[i] - w - 1.
        spelled = [_spelled(v, int(c)) for c in codes[ends[rough] - owner[rough] - 1]]
        size[rough] = [len(x) for x in spelled]
        to = np.cumsum(size) - size
        flat = np.repeat(flat, size)
        for i, x in zip(to[rough].tolist(), spelled):
            flat[i:i + len(x)] = x
    sizes = np.bincount(owner, size, minlength=len(words)).astype(np.int64)
    return order, best[base + lengths + longest], sizes, flat


#: Words, and eight times as many pieces, that a worker keeps (it starts anew beyond them).
REMEMBERED = 1 << 18
#: Characters of words that are solved together (their tables take 300 bytes each).
TOGETHER = 1 << 17


class _Numbers(dict):
    """Words by number; one that is asked for the first time gets the next."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


def _grown(a: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``a`` with ``more`` behind its first ``used`` entries; doubled when it is too short."""
    if used + len(more) > len(a):
        a = np.concatenate([a[:used], np.empty(used + 2 * len(more), a.dtype)])
    a[used:used + len(more)] = more
    return a


class Solutions:
    """Best scores and pieces of the words met so far, by number, in flat arrays."""

    def __init__(self, v: Vocabulary):
        self.v, self.number, self.solved, self.used = v, _Numbers(), 0, 0
        self.totals, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.starts, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def usable(self, v: Vocabulary) -> bool:
        """Not too large, and not left half done by a task that failed."""
        return (self.v is v and self.solved == len(self.number) <= REMEMBERED
                and self.used <= 8 * REMEMBERED)

    def numbers(self, words: list[str]) -> np.ndarray:
        """The number of each word; those not met before are solved together."""
        got = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        new, self.number.new = self.number.new, []
        ends = np.cumsum(np.fromiter(map(len, new), np.int64, len(new)))
        at = 0
        while at < len(new):
            upto = max(at + 1, int(np.searchsorted(
                ends, (ends[at - 1] if at else 0) + TOGETHER, "right")))
            order, totals, sizes, flat = _solved(self.v, new[at:upto])
            back = np.argsort(order)
            starts = self.used + np.cumsum(sizes) - sizes
            for name, x in (("totals", totals), ("sizes", sizes), ("starts", starts)):
                setattr(self, name, _grown(getattr(self, name), self.solved, x[back]))
            self.flat = _grown(self.flat, self.used, flat)
            self.used += len(flat)
            self.solved += upto - at
            at = upto
        return got

    def strung(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of a sequence of words given by number, and each word's length."""
        n = self.sizes[numbers]
        at = np.arange(int(n.sum())) + np.repeat(self.starts[numbers] - (np.cumsum(n) - n), n)
        return self.flat[at], n


_kept: list[Solutions] = []


def solutions(v: Vocabulary) -> Solutions:
    """The worker's own, kept from batch to batch."""
    if not _kept or not _kept[0].usable(v):
        _kept[:] = [Solutions(v)]
    return _kept[0]


def words_best(v: Vocabulary, words: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Best score and pieces of each word."""
    known = solutions(v)
    numbers = known.numbers(words)
    flat, n = known.strung(numbers)
    return known.totals[numbers], np.split(flat, np.cumsum(n)[:-1])


def encode_batch(v: Vocabulary, texts: list[str]) -> list[np.ndarray]:
    """Piece ids of each text; an empty text has none."""
    lists = [(_UNIT.findall(m) if v.cut else [m]) if t else []
             for t in texts for m in [SPACE + marked(t)]]
    known = solutions(v)
    flat, n = known.strung(known.numbers([w for ws in lists for w in ws]))
    ends = np.cumsum([len(ws) for ws in lists])
    cuts = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], ends]).astype(np.int64)]
    return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def _paths(v: Vocabulary, codes: np.ndarray, starts: list[int], last: int):
    """Best scores [start, position] of paths from each start whose pieces begin before
    ``last``, and the length and piece of their last steps."""
    n, longest = len(codes), v.longest
    score, piece = v.edges(codes, np.full(n, n))
    best = np.full((len(starts), n + 1 + longest), NONE, np.int64)
    took = np.zeros((len(starts), n + 1), np.int64)
    best[np.arange(len(starts)), np.array(starts) + longest] = 0
    back = np.arange(longest)
    for p in range(1, n + 1):
        ok = (p - (longest - back) < last) & (p - (longest - back) >= 0)
        total = np.where(ok & (score[p] > LOW), best[:, p:p + longest] + score[p], NONE)
        c = np.argmax(total, axis=1)
        value = total[np.arange(len(starts)), c]
        better = value > best[:, p + longest]
        best[better, p + longest] = value[better]
        took[better, p] = longest - c[better]
    return best[:, longest:], took, piece


def _parts(v: Vocabulary, chunk: str, core: int) -> tuple[int | None, int | None]:
    """First and last place in the chunk's core that every path passes."""
    if not v.cut:
        return None, None
    cuts = [m.start() + 1 for m in re.finditer(f"[^{SPACE}]{SPACE}", chunk[:core])]
    return (cuts[0], cuts[-1]) if cuts else (None, None)


def transfer(v: Vocabulary, chunk: str, core: int) -> np.ndarray:
    """The chunk's matrix: best score from entry state k to exit state m.

    ``chunk`` is marked text of ``core`` characters and up to L - 1 after them.
    """
    n, size = v.longest, min(v.longest, core)
    out = np.full((n, n), NONE, np.int64)
    first, final = _parts(v, chunk, core)
    if first is None:
        best, _, _ = _paths(v, _codes(chunk), list(range(size)), core)
        out[:size, :len(chunk) - core + 1] = best[:, core:]
        return np.maximum(out, NONE)
    head, _, _ = _paths(v, _codes(chunk[:first]), list(range(min(size, first + 1))), first)
    known = solutions(v)
    numbers = known.numbers(_UNIT.findall(chunk[first:final]))
    middle = known.totals[numbers]
    tail, _, _ = _paths(v, _codes(chunk[final:]), [0], core - final)
    out[:len(head), :len(chunk) - core + 1] = (head[:, first, None] + int(middle.sum())
                                               + tail[:1, core - final:])
    return np.where(out < NONE // 2, NONE, out)


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The (max, +) product; associative."""
    out = (a[:, :, None] + b[None, :, :]).max(axis=1)
    return np.where(out < NONE // 2, NONE, out)


def border_states(matrices: list[np.ndarray]) -> list[int]:
    """The best path's state at every border, first and last included (both 0).

    Products of the chunks after each border by the associative rule, then one step per
    border from the left.
    """
    after = [None] * len(matrices)
    for k in range(len(matrices) - 1, -1, -1):
        after[k] = matrices[k][:, :1] if k == len(matrices) - 1 else \
            combine(matrices[k], after[k + 1])
    states = [0]
    for k, m in enumerate(matrices[:-1]):
        states.append(int(np.argmax(m[states[-1]] + after[k + 1][:, 0])))
    return states + [0]


def traced(v: Vocabulary, chunk: str, core: int, entry: int, leave: int) -> np.ndarray:
    """The pieces of a chunk between its two states."""
    first, final = _parts(v, chunk, core)

    def trace(text, start, last, end):
        codes = _codes(text)
        _, took, piece = _paths(v, codes, [start], last)
        ids, p = [], end
        while p > start:
            n = int(took[0, p])
            own = int(piece[p, v.longest - n])
            ids.append([own] if own >= 0 else _spelled(v, int(codes[p - 1])))
            p -= n
        return [x for part in reversed(ids) for x in part]

    if first is None:
        return np.array(trace(chunk, entry, core, core + leave), np.int32)
    middle = encode_units(v, _UNIT.findall(chunk[first:final]))
    return np.concatenate([
        np.array(trace(chunk[:first], entry, first, first), np.int32), middle,
        np.array(trace(chunk[final:], 0, core - final, core - final + leave), np.int32)])


def encode_units(v: Vocabulary, units: list[str]) -> np.ndarray:
    known = solutions(v)
    return known.strung(known.numbers(units))[0]


def decode_one(v: Vocabulary, ids) -> str:
    ids = np.asarray(ids, np.int64)
    high = v.high[ids]
    parts = v.shown[ids]
    if high.any():
        # A run of high bytes is decoded together, at its first byte.
        edge = np.flatnonzero(np.diff(np.concatenate([[0], high.view(np.int8), [0]])))
        for a, b in zip(edge[::2], edge[1::2]):
            parts[a] = bytes(v.byte_of[int(i)] for i in ids[a:b]).decode("utf-8", "replace")
    text = "".join(parts.tolist())
    return text[1:] if text.startswith(" ") else text


def _list_column(arrays, pa):
    values = np.concatenate([*arrays, np.zeros(0, np.int32)]).astype(np.int32)
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text",
           out_col: str = "piece_ids", chunk: int = CHUNK) -> DataFrame:
    """``docs`` with the piece ids of every whole text (a clashing name gets underscores).

    Null and empty texts have an empty list; repeated rows are repeated; an empty table
    gives no rows.  No cap on lengths: texts over ``chunk`` characters are split.
    """
    out = fresh_name(out_col, docs.columns)
    row = fresh_name("row_", docs.columns)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    longest = vocabulary.longest

    def run(batches):
        import pyarrow as pa

        v = shared.value
        for b in batches:
            for at in range(0, b.num_rows, 128):
                part = b.slice(at, 128)
                ids = encode_batch(v, part.column("_text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], _list_column(ids, pa)], [*part.schema.names[:-1], out])

    schema = StructType([*docs.schema.fields, StructField(out, ArrayType(IntegerType()))])
    size = F.length(text_of(text_col))
    short = docs.where(size <= chunk).withColumn("_text", text_of(text_col)).mapInArrow(
        run, schema)
    giant = written(docs.where(size > chunk).withColumn(
        row, F.monotonically_increasing_id()), "giant-texts")

    body = F.concat(F.lit(" "), F.col(text_col))
    chunks = giant.select(
        F.col(row).alias("row"), body.alias("body"),
        F.posexplode(F.sequence(F.lit(0), F.ceil((F.length(body)) / chunk).cast("int") - 1))
        .alias("i", "c")).select(
        "row", "i", F.least(F.lit(chunk), F.length("body") - F.col("i") * chunk).alias("core"),
        F.substring("body", F.col("i") * chunk + 1, F.lit(chunk + longest - 1)).alias("part"))

    def matrices(batches):
        import pyarrow as pa

        for b in batches:
            rows = zip(b.column("part").to_pylist(), b.column("core").to_pylist())
            yield pa.RecordBatch.from_pydict({
                "row": b.column("row"), "i": b.column("i"), "matrix": pa.array(
                    [transfer(shared.value, marked(t), n).astype("<i8").tobytes()
                     for t, n in rows], pa.binary())})

    def states(batches):
        import pyarrow as pa

        for b in batches:
            for r, ms in zip(b.column("row").to_pylist(), b.column("ms").to_pylist()):
                m = [np.frombuffer(x["matrix"], "<i8").reshape(longest, longest) for x in ms]
                s = border_states(m)
                yield pa.RecordBatch.from_pydict({
                    "row": pa.array([r] * len(m), pa.int64()),
                    "i": pa.array(range(len(m)), pa.int32()),
                    "entry": pa.array(s[:-1], pa.int32()), "leave": pa.array(s[1:], pa.int32())})

    def pieces(batches):
        import pyarrow as pa

        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("part", "core", "entry", "leave")]
            yield pa.RecordBatch.from_pydict({
                "row": b.column("row"), "i": b.column("i"), "ids": _list_column(
                    [traced(shared.value, marked(t), n, e, x) for t, n, e, x in zip(*cols)],
                    pa)})

    # One small matrix per chunk meets its text's others; texts of chunks never do.
    borders = (chunks.mapInArrow(matrices, "row bigint, i int, matrix binary")
               .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("i", "matrix")))
                                   .alias("ms"))
               .mapInArrow(states, "row bigint, i int, entry int, leave int"))
    done = (chunks.join(borders, ["row", "i"])
            .mapInArrow(pieces, "row bigint, i int, ids array<int>")
            .groupBy(F.col("row").alias(row))
            .agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("i", "ids"))),
                                       lambda x: x["ids"])).alias(out)))
    return short.unionByName(giant.join(done, row).select(*docs.columns, out))


def decode(ids: DataFrame, vocabulary: Vocabulary, ids_col: str = "piece_ids",
           out_col: str = "decoded") -> DataFrame:
    """``ids`` with the text of each list of pieces; null and empty lists are empty texts."""
    out = fresh_name(out_col, ids.columns)
    shared = ids.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            flat, at = list_parts(b.column(ids_col))
            texts = [decode_one(shared.value, flat[x:y]) for x, y in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())],
                                             [*b.schema.names, out])

    return ids.mapInArrow(run, StructType([*ids.schema.fields, StructField(out, StringType())]))


def default_path(spark: SparkSession, name: str = "piece_bpe_32k.model") -> str:
    """The vocabulary file; the setting ``tidemark.pieces`` names another."""
    import public_tokenizers

    return spark.conf.get("tidemark.pieces", public_tokenizers.path(name))
