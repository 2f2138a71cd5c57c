"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example: all turns before it are its context and only
that reply is trainable.  The examples of a conversation share their prefixes, so the
formatted conversation is stored once, as one piece per turn with its offset, and an
example is a span of it: characters [0, example_end) with the loss mask
[loss_start, loss_end).  That stays linear in the conversation where copied prefixes
would grow with its square; ``texts`` writes the copies out for those who want them.

Template of a turn: ``### role: text</turn>\\n``.  Inside roles and texts a backslash
goes before every backslash and ``#``, into ``</`` (``<\\/``) and, in roles, before
``:``; so no text holds a control string and ``plain`` takes the marks away again.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, SEP, CLOSE = "### ", ": ", "</turn>\n"
#: Turns of a conversation are numbered in runs of so many turn numbers, so that a very
#: long one is spread over tasks.
RUN = 512


def escaped(text: Column, role: bool = False) -> Column:
    out = F.regexp_replace(text, r"[\\#:]" if role else r"[\\#]", r"\\$0")
    return F.replace(out, F.lit("</"), F.lit("<\\/"))


def plain(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\#/:])", "$1")


def formatted(turns: DataFrame) -> DataFrame:
    """One piece per turn of (conv_id, turn, role, text): conv_id, pos, piece, piece_start,
    body_start, body_end, target.

    Offsets count characters of the formatted conversation; pos counts its turns from 1.
    Null text or role is empty.  Turns go by number, null first, then by role and text,
    so repeated rows stay in a fixed order; rows without conv_id are one conversation.
    Only ``assistant`` turns are targets.  An empty table gives no rows.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(OPEN), escaped(role, role=True), F.lit(SEP))
    body = escaped(text)
    t = turns.select(
        "conv_id", "turn", role.alias("r"), text.alias("x"),
        F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / RUN).alias("run"),
        F.concat(head, body, F.lit(CLOSE)).alias("piece"),
        F.length(head).cast("bigint").alias("head_n"), F.length(body).alias("body_n"),
        (role == "assistant").alias("target"))
    in_run = Window.partitionBy("conv_id", "run").orderBy(F.col("turn").asc_nulls_first(),
                                                          "r", "x")
    t = t.select(
        "*", F.row_number().over(in_run).alias("n"),
        (F.sum(F.length("piece").cast("bigint")).over(
            in_run.rowsBetween(Window.unboundedPreceding, Window.currentRow))
         - F.length("piece")).alias("at"))
    runs = turns.select(
        F.col("conv_id").alias("c"),
        F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / RUN).alias("u"),
        (F.length(head) + F.length(body) + F.lit(len(CLOSE))).cast("bigint").alias("len")
    ).groupBy("c", "u").agg(F.count(F.lit(1)).alias("turns"), F.sum("len").alias("len"))
    before = Window.partitionBy("c").orderBy("u").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("c", "u", F.coalesce(F.sum("turns").over(before), F.lit(0)).alias("n0"),
                       F.coalesce(F.sum("len").over(before), F.lit(0)).alias("at0"))
    t = t.join(runs, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("run") == F.col("u")))
    start = F.col("at") + F.col("at0")
    return t.select(
        "conv_id", (F.col("n") + F.col("n0")).alias("pos"), "piece",
        start.alias("piece_start"), (start + F.col("head_n")).alias("body_start"),
        (start + F.col("head_n") + F.col("body_n")).alias("body_end"), "target")


def examples(pieces: DataFrame) -> DataFrame:
    """One example per assistant turn: conv_id, pos, example_end, loss_start, loss_end."""
    return pieces.where("target").select(
        "conv_id", "pos",
        (F.col("piece_start") + F.length("piece")).alias("example_end"),
        F.col("body_start").alias("loss_start"), F.col("body_end").alias("loss_end"))


def texts(pieces: DataFrame) -> DataFrame:
    """The examples written out: conv_id, pos, text, loss_start, loss_end."""
    w = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (pieces.select("*", F.array_join(F.collect_list("piece").over(w), "").alias("text"))
            .where("target")
            .select("conv_id", "pos", "text", F.col("body_start").alias("loss_start"),
                    F.col("body_end").alias("loss_end")))


def read_back(pieces: DataFrame) -> DataFrame:
    """Turns parsed from formatted pieces and what the examples' loss masks cover, unescaped.

    conv_id, pos, role, text, loss (null outside targets), example_chars (0 there).
    Example and mask come from ``examples``; a mask lies in the example's last piece.
    """
    # Possessive, so that Java's matcher loops over a long role instead of recursing.
    p = r"(?s)^### ((?:[^\\:]++|\\.)*+): (.*)</turn>\n$"
    spans = examples(pieces).select(F.col("conv_id").alias("c"), F.col("pos").alias("last"),
                                    "example_end", "loss_start", "loss_end")
    both = pieces.join(spans, F.col("conv_id").eqNullSafe(F.col("c"))
                       & (F.col("pos") == F.col("last")), "left")
    own = F.substring("piece", F.col("loss_start") - F.col("piece_start") + 1,
                      F.col("loss_end") - F.col("loss_start"))
    return both.select(
        "conv_id", "pos", plain(F.regexp_extract("piece", p, 1)).alias("role"),
        plain(F.regexp_extract("piece", p, 2)).alias("text"),
        F.when(F.col("loss_start").isNotNull(), plain(own)).alias("loss"),
        F.coalesce("example_end", F.lit(0)).cast("bigint").alias("example_chars"))


def _hash_conversations(batches):
    """Rows sorted by conversation in; one row per conversation out, holding no texts."""
    import pandas as pd

    key, state, first = None, None, True
    for pdf in batches:
        out = []
        for conv, no, role, text, loss, chars in zip(
                pdf["conv_id"], pdf["null_id"], pdf["role"], pdf["text"], pdf["loss"],
                pdf["example_chars"]):
            if first or (conv, no) != key:
                if not first:
                    out.append(_row(key, state))
                key, first = (conv, no), False
                state = [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode())
            if loss is not None:
                state[2] += len(loss)
                state[3].update(loss.encode())
            state[4] += chars
        yield pd.DataFrame(out, columns=_DIGEST_COLUMNS)
    if not first:
        yield pd.DataFrame([_row(key, state)], columns=_DIGEST_COLUMNS)


_DIGEST_COLUMNS = ["conv_id", "null_id", "n_turns", "turns_sha256", "loss_chars",
                   "loss_sha256", "formatted_chars"]


def _row(key, s):
    return (*key, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4])


def digests(pieces: DataFrame) -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    A digest needs its turns in order; they stream through a task sorted, a row at a
    time, and none is held.  formatted_chars adds up the examples' lengths.
    """
    rows = read_back(pieces).withColumn("null_id", F.col("conv_id").isNull()).withColumn(
        "conv_id", F.coalesce("conv_id", F.lit(0)).cast("bigint"))
    out = (rows.repartition("conv_id", "null_id")
           .sortWithinPartitions("conv_id", "null_id", "pos")
           .mapInPandas(_hash_conversations,
                        "conv_id bigint, null_id boolean, n_turns bigint, "
                        "turns_sha256 string, loss_chars bigint, loss_sha256 string, "
                        "formatted_chars bigint"))
    return out.select(F.when(~F.col("null_id"), F.col("conv_id")).alias("conv_id"),
                      *_DIGEST_COLUMNS[2:])
