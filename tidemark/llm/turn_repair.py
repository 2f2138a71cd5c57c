"""Conversation structure repair by a survivor-coalescence Viterbi.

A conversation's turns are edited at least cost until their role initials read
``(s?(ua)+)?``.  A path's state is what it wrote last: nothing, a system turn, a user
turn, an assistant turn.  Per state one survivor is kept, as a leaf of a tree of
backpointers with reference counts; as soon as all survivors descend from one node, the
edits up to it are certain, leave the tree and are given out.  Ties in cost go to the
ASCII-least string of edits; they are settled by comparing the whole part of both paths
that isn't certain yet.  (Paths of equal cost to one state have used up the same rows, so
neither string of edits begins with the other: that would need an insertion more, which
costs.)

Rows are sorted by range over all tasks, so a conversation that holds a large share of
the rows lies in many parts.  A part that may continue a conversation is solved from
every state it may be entered in, and a second Viterbi of the same kind, over parts
instead of rows, picks the entries.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_of, written

BLANKS = " \t\n\x0b\x0c\r"
NONE, SYSTEM, USER, ASSISTANT = range(4)
KEEP = {(NONE, "s"): SYSTEM, (NONE, "u"): USER, (SYSTEM, "u"): USER,
        (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: What a user or assistant turn may follow; a rerole or insertion leads there.
TURN_AFTER = {NONE: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
ROLE = {USER: "user", ASSISTANT: "assistant"}
COST_REROLE, COST_DELETE, COST_INSERT, COST_TRUNCATED = 1, 2, 5, 5
LEGAL = {"su", "ua", "au"}
#: What a path in state y needs at most to do as well as one in state x, by (y, x): turns to
#: insert, or a system turn to delete that x could still keep.  Whoever costs more than
#: that above another is on no cheapest path.
CATCH_UP = {(ASSISTANT, NONE): 2, (USER, NONE): 7, (SYSTEM, NONE): 12,
            (NONE, SYSTEM): 0, (ASSISTANT, SYSTEM): 0, (USER, SYSTEM): 5,
            (NONE, USER): 5, (ASSISTANT, USER): 5, (SYSTEM, USER): 5,
            (NONE, ASSISTANT): 0, (USER, ASSISTANT): 5, (SYSTEM, ASSISTANT): 10}


class Node:
    """A piece of a path; ``refs`` counts its children and the survivors that end in it."""

    __slots__ = ("parent", "piece", "refs", "depth", "tag")

    def __init__(self, parent, piece, tag=None):
        self.parent, self.piece, self.tag, self.refs = parent, piece, tag, 0
        self.depth = parent.depth + 1 if parent else 0
        if parent:
            parent.refs += 1


class Survivors:
    """The cheapest path to each state; ``settled`` takes the certain nodes as they come."""

    def __init__(self, entry: int, settled):
        self.root, self.settled = Node(None, ""), settled
        self.root.refs = 1
        self.best = {entry: (0, self.root)}

    @staticmethod
    def less(a: Node, a_piece: str, b: Node, b_piece: str) -> bool:
        """Whether path a comes first: both complete, back to where they part."""
        x, y = [a_piece], [b_piece]
        while a is not b:
            if a.depth >= b.depth:
                x.append(a.piece)
                a = a.parent
            else:
                y.append(b.piece)
                b = b.parent
        return "".join(reversed(x)) < "".join(reversed(y))

    def step(self, edges) -> None:
        """Move all survivors along ``edges``: (from, to, cost, piece, tag)."""
        chosen = {}
        for s, to, cost, piece, tag in edges:
            if s not in self.best:
                continue
            total, node = self.best[s][0] + cost, self.best[s][1]
            old = chosen.get(to)
            if old is None or total < old[0] or total == old[0] and self.less(
                    node, piece, old[1], old[2]):
                chosen[to] = (total, node, piece, tag)
        self._replace({to: (c, Node(n, p, t)) for to, (c, n, p, t) in chosen.items()})

    def insert(self) -> None:
        """Where inserting a turn gives a cheaper path to a state, take it."""
        for _ in range(2):
            better = {}
            for s, (cost, node) in self.best.items():
                to, cost = TURN_AFTER[s], cost + COST_INSERT
                for old in (better.get(to), self.best.get(to)):
                    if old and (old[0] < cost or old[0] == cost and not self.less(
                            node, "I", *((old[1], "") if len(old) == 2 else (old[1], "I")))):
                        break
                else:
                    better[to] = (cost, node, "I")
            if not better:
                return
            self._replace(self.best | {to: (c, Node(n, p)) for to, (c, n, p) in better.items()})

    def _replace(self, new: dict) -> None:
        old = self.best
        self.best = {x: (c, n) for x, (c, n) in new.items() if not any(
            d + CATCH_UP[y, x] < c for y, (d, _) in new.items() if y != x)}
        for _, n in new.values():
            n.refs += 1
        gone = [n for x, (_, n) in new.items() if x not in self.best]
        for n in [*gone, *(n for _, n in old.values())]:
            n.refs -= 1
            while n.refs == 0 and n.parent is not None:
                n.parent.refs -= 1
                n = n.parent
        self._settle()

    def _settle(self) -> None:
        if self.root.refs != 1:
            return
        ends = {id(n) for _, n in self.best.values()}
        if id(self.root) in ends or not self.best:
            return
        path, n = [], next(iter(self.best.values()))[1]
        while n is not self.root:
            path.append(n)
            n = n.parent
        for n in reversed(path):
            self.settled(n)
            self.root, n.parent = n, None
            if n.refs != 1 or id(n) in ends:
                break

    def open_nodes(self, node: Node) -> list[Node]:
        """The nodes below the certain part, in order."""
        out = []
        while node is not self.root:
            out.append(node)
            node = node.parent
        return out[::-1]


def row_edges(initial: str, fault: str):
    """What may be done with a row: (from, to, cost, edit, tag)."""
    extra = COST_TRUNCATED if fault == "t" else 0
    for s in range(4):
        yield s, s, COST_DELETE, "D", None
        if fault not in ("b", "d"):
            if (s, initial) in KEEP:
                yield s, KEEP[s, initial], extra, "K", None
            yield s, TURN_AFTER[s], COST_REROLE + extra, "R", None


#: All edges by initial and fault: they are few.
EDGES = {(i, f): list(row_edges(i, f)) for i in ("s", "u", "a", "") for f in ("", "b", "d", "t")}


def ordered(turns: DataFrame) -> DataFrame:
    """The rows of (conv_id, turn, role, text) in order, equal ones once with their number.

    Columns: c (conversation as text), conv_id, t0, turn, role, text, n, fault ('b'lank,
    'd'uplicate, 't'runcated or '') of the first of the n, part and idx (their order).
    """
    text = F.col("text")
    bare = F.rtrim(text, F.lit(BLANKS))
    rows = (turns.select(
        F.when(F.col("conv_id").isNull(), "").otherwise(
            F.concat(F.lit("="), F.col("conv_id").cast("string"))).alias("c"),
        "conv_id", "turn", text_of("role").alias("role"), text_of().alias("text"),
        *([F.col("n")] if "n" in turns.columns else [F.lit(1).alias("n")]))
        .groupBy("c", "conv_id", "turn", "role", "text").agg(F.sum("n").alias("n")))
    rows = written(rows.select(
        "*", F.col("turn").isNotNull().alias("t0"), F.sha2(text, 256).alias("h"),
        F.when(bare == "", "b").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "t")
        .otherwise("").alias("own")), "turns")
    said = (rows.where("own <> 'b'").groupBy("c", "role", "h")
            .agg(F.min(F.struct("t0", "turn")).alias("first"), F.count(F.lit(1)).alias("m"))
            .where("m > 1").drop("m"))
    rows = rows.join(said, ["c", "role", "h"], "left").select(
        "c", "conv_id", "t0", "turn", "role", "text", "n",
        F.when(F.col("first").isNotNull()
               & ~F.struct("t0", "turn").eqNullSafe(F.col("first")), "d")
        .otherwise(F.col("own")).alias("fault"))
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A prefix of the text is a range bound of bounded size that keeps its order.
    rows = (rows.repartitionByRange(parts, "c", "t0", "turn", "role", F.left("text", F.lit(64)))
            .sortWithinPartitions("c", "t0", "turn", "role", "text"))
    return written(rows.select("*", F.spark_partition_id().alias("part"),
                               F.monotonically_increasing_id().alias("idx")), "turns-ordered")


_BLOCKS = ("c string, part int, entry int, settled string, exits array<struct<state: int, "
           "cost: bigint, edits: string>>, first string, last string, illegal bigint")


def _solve_parts(batches):
    """Rows sorted by part and place in; one row per conversation, part and entry out."""
    import pyarrow as pa

    key, part, runs, out = None, None, [], []

    def close():
        for entry, (v, edits) in runs:
            exits = [{"state": s, "cost": c,
                      "edits": "".join(x.piece for x in v.open_nodes(n))}
                     for s, (c, n) in v.best.items()]
            out.append((key, part, entry, "".join(edits), exits, first, last, illegal))

    for b in batches:
        cols = [b.column(k).to_pylist() for k in ("c", "part", "initial", "fault", "n")]
        for c, p, initial, fault, n in zip(*cols):
            if (c, p) != (key, part):
                close()
                runs = []
                for entry in range(4) if p != part else (NONE,):
                    edits = []
                    runs.append((entry, (Survivors(
                        entry, lambda x, keep=edits: keep.append(x.piece)), edits)))
                key, part, first, last, illegal = c, p, initial, None, 0
            for k in range(n):
                if last is not None and last + initial not in LEGAL:
                    illegal += 1
                last = initial
                f = fault if k == 0 or fault == "b" else "d"
                edges = EDGES[initial if initial in ("s", "u", "a") else "", f]
                for _, (v, _) in runs:
                    v.insert()
                    v.step(edges)
        yield _block_batch(out, pa)
        out.clear()
    close()
    yield _block_batch(out, pa)


def _block_batch(out, pa):
    cols = list(zip(*out)) or [()] * 8
    exits = pa.list_(pa.struct([("state", pa.int32()), ("cost", pa.int64()),
                                ("edits", pa.string())]))
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), exits, pa.string(),
             pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(cols, kinds)],
        ["c", "part", "entry", "settled", "exits", "first", "last", "illegal"])


_EDITS = "c string, part int, entry int, edits string, cost bigint, illegal bigint"


def _join_parts(batches):
    """Blocks sorted by conversation, part and entry in; the chosen edits of each part out.

    A conversation's cost comes with its last part, its illegal neighbours with their part.
    """
    import pyarrow as pa

    key, at, v, edges, out, between = None, None, None, [], [], 0
    seen = {}

    def give(node):
        if node.tag is None:  # insertions after the last row
            c, p, e, x, cost, ill = out.pop()
            out.append((c, p, e, x + node.piece, cost, ill))
        else:
            out.append((key, *node.tag, node.piece, 0, seen.pop(node.tag[0])))

    def step():
        if edges:
            v.step(edges)
            edges.clear()

    def close():
        if v is None:
            return
        step()
        v.insert()
        ends = [(c, n) for s, (c, n) in v.best.items() if s in (NONE, ASSISTANT)]
        cost, node = ends[0]
        for c, n in ends[1:]:
            if c < cost or c == cost and v.less(n, "", node, ""):
                cost, node = c, n
        for n in v.open_nodes(node):
            give(n)
        c, p, e, x, _, ill = out.pop()
        out.append((c, p, e, x, cost, ill))

    for b in batches:
        for r in b.to_pylist():
            if r["c"] != key:
                close()
                if len(out) > 1 << 10:
                    yield _edit_batch(out, pa)
                    out.clear()
                key, at, before = r["c"], None, None
                v = Survivors(NONE, give)
                seen.clear()
            if r["part"] != at:
                step()
                if at is not None and v.best:
                    # All but the newest settled part may go; it is kept for ``give``.
                    if len(out) > 1 << 10:
                        yield _edit_batch(out[:-1], pa)
                        del out[:-1]
                between = int(before is not None and before + r["first"] not in LEGAL)
                at, before = r["part"], r["last"]
                seen[at] = r["illegal"] + between
            edges.extend((r["entry"], x["state"], x["cost"], r["settled"] + x["edits"],
                          (r["part"], r["entry"])) for x in r["exits"])
    close()
    yield _edit_batch(out, pa)


def _edit_batch(out, pa):
    cols = list(zip(*out)) or [()] * 6
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      ["c", "part", "entry", "edits", "cost", "illegal"])


def edits(rows: DataFrame) -> DataFrame:
    """Of ``ordered`` rows: c, part, entry (state), edits (K, R, D, I), cost, illegal."""
    slim = rows.select("c", "part", "idx", F.left("role", F.lit(1)).alias("initial"),
                       "fault", "n")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = (slim.repartition(parts, "part").sortWithinPartitions("part", "idx")
              .mapInArrow(_solve_parts, _BLOCKS))
    chosen = (blocks.repartition(parts, "c").sortWithinPartitions("c", "part", "entry")
              .mapInArrow(_join_parts, _EDITS))
    return written(chosen, "turn-edits")


_REPAIRED = "c string, part int, pos bigint, role string, text string, edit string"


def _apply(batches):
    """Edits and rows sorted by conversation and place in; the turns that are left out."""
    import pyarrow as pa

    key, state, todo, at, pos, out = None, NONE, "", 0, 0, []

    def turn(edit, role, text):
        nonlocal pos
        pos += 1
        out.append((*key, pos, role, text, edit))

    def insertions():
        nonlocal at, state
        while at < len(todo) and todo[at] == "I":
            at, state = at + 1, TURN_AFTER[state]
            turn("I", ROLE[state], "")

    for b in batches:
        for r in b.to_pylist():
            if r["edits"] is not None:
                insertions()
                key, state, todo, at, pos = (r["c"], r["part"]), r["entry"], r["edits"], 0, 0
                continue
            for _ in range(r["n"]):
                insertions()
                edit, at = todo[at], at + 1
                if edit == "K":
                    state = KEEP[state, r["role"][:1]]
                    turn("K", r["role"], r["text"])
                elif edit == "R":
                    state = TURN_AFTER[state]
                    turn("R", ROLE[state], r["text"])
        yield _turn_batch(out, pa)
        out.clear()
    insertions()
    yield _turn_batch(out, pa)


def _turn_batch(out, pa):
    cols = list(zip(*out)) or [()] * 6
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      ["c", "part", "pos", "role", "text", "edit"])


def repaired(rows: DataFrame, edited: DataFrame, whole: bool = False) -> DataFrame:
    """The turns after the edits: c, part, pos, role, text, edit; part and pos give the order.

    With ``whole`` a conversation lies in one task, in order (it streams, none is held);
    without, its parts are spread.
    """
    both = (rows.select("c", "part", "idx", "role", "text", "n",
                        F.lit(None).cast("string").alias("edits"),
                        F.lit(None).cast("int").alias("entry"))
            .unionByName(edited.select(
                "c", "part", F.lit(-1).cast("bigint").alias("idx"), F.lit("").alias("role"),
                F.lit("").alias("text"), F.lit(0).cast("bigint").alias("n"), "edits", "entry")))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (both.repartition(parts, "c", *([] if whole else ["part"]))
            .sortWithinPartitions("c", "part", "idx").mapInArrow(_apply, _REPAIRED))


def _hash(batches):
    import pyarrow as pa

    key, sha, out = None, None, []
    kind = pa.schema([("c", pa.string()), ("repaired_sha256", pa.string())])

    def batch():
        rows = pa.RecordBatch.from_pylist(out, kind)
        out.clear()
        return rows

    for b in batches:
        for c, role, text in zip(*(b.column(k).to_pylist() for k in ("c", "role", "text"))):
            if c != key:
                if sha:
                    out.append({"c": key, "repaired_sha256": sha.hexdigest()})
                key, sha, mark = c, hashlib.sha256(), ""
            sha.update(f"{mark}{role}:{text}".encode("utf-8", "surrogatepass"))
            mark = "\n"
        yield batch()
    if sha:
        out.append({"c": key, "repaired_sha256": sha.hexdigest()})
        yield batch()


def damaged(turns: DataFrame) -> DataFrame:
    """The contract's faults, by crc32 of ``conv_id:turn``: conv_id, turn, role, text, n.

    Nulls are one space, in the hashed key too; n is 0 for a dropped row, 2 for a repeated.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat_ws(":", space("conv_id"), space("turn")).cast("binary")) % 20
    return turns.select(
        "conv_id", "turn", F.when(k == 4, "user").otherwise(space("role")).alias("role"),
        F.when(k == 1, "").when(k == 2, F.regexp_replace(space("text"), "[.!?]", ""))
        .otherwise(space("text")).alias("text"),
        F.when(k == 0, 0).when(k == 3, 2).otherwise(1).alias("n"))


def digests(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Every conv_id of (conv_id, turn, role, text[, n]) with its faults and repair.

    ``ids`` may name the conversations to report (default: those of ``turns``).

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    Null role or text is empty here.  Turns go by number, null first, then by role and
    text; rows without conv_id are one conversation.  A row counts for its first fault of
    blank, duplicate, truncated.  A role without a letter can't be kept.  A conversation
    that has no rows (n = 0) has zeros, no edits and the digest of the empty text; an
    empty table gives no rows.  Other columns take no part.
    """
    rows = ordered(turns.where("n > 0") if "n" in turns.columns else turns)
    edited = edits(rows)
    n = lambda f: F.sum(f).cast("bigint")
    copies = F.col("n") - 1
    faults = rows.groupBy("c").agg(
        n(F.when(F.col("fault") == "b", F.col("n")).otherwise(0)).alias("blank"),
        n(F.when(F.col("fault") == "d", F.col("n")).when(F.col("fault") == "b", 0)
          .otherwise(copies)).alias("duplicate"),
        n((F.col("fault") == "t").cast("int")).alias("truncated"))
    gaps = (rows.where("t0").groupBy("c", "turn").agg(F.lit(1).alias("one"))
            .groupBy("c").agg((F.max("turn") - F.min("turn") + 1 - F.count("one"))
                              .cast("bigint").alias("gaps")))
    audits = edited.groupBy("c").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "edits"))),
                                 lambda x: x["edits"]), "").alias("audit"),
        F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"))
    shas = repaired(rows, edited, whole=True).mapInArrow(
        _hash, "c string, repaired_sha256 string")
    convs = (turns if ids is None else ids).select(
        F.when(F.col("conv_id").isNull(), "").otherwise(
            F.concat(F.lit("="), F.col("conv_id").cast("string"))).alias("c"),
        "conv_id").distinct()
    out = convs
    for t in (gaps, faults, audits, shas):
        out = out.join(t, "c", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return out.select(
        "conv_id", zero("gaps"), zero("blank"), zero("duplicate"), zero("truncated"),
        zero("illegal"), zero("cost"), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
