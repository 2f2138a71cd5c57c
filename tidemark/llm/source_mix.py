"""Mix sources to target weights by repeating documents.

Words are aggregated per source, each source gets a target, and target / size is its
repetition rate.  A document is taken floor(rate) times, and once more when a hash of
(seed, id), read as a number in [0, 1), is below the fraction.  Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, fresh_name

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEED = "mix-1"


def n_words(text: Column) -> Column:
    """Runs of anything but white space; null: 0."""
    marks = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " "))
    return F.when(marks == "", F.lit(0)).otherwise(
        F.length(marks) - F.length(F.replace(marks, F.lit(" "), F.lit(""))) + 1
    ).cast("bigint")


def chance(id_col: str, seed: str) -> Column:
    """52 hash bits of (seed, id) as a number in [0, 1); exact in a double."""
    key = F.concat(F.lit(seed + "|"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") \
        / F.lit(float(2 ** 52))


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """One row per source with its target; ``sizes`` has source, source_size.

    All sizes together are shared by weight; a target stops at ``most`` times its
    source's size and the excess is shared anew among the rest.  In order of
    ``most * size / weight`` the sources that stop come first, so running sums give the
    end state of that loop without iterating.  ``sizes`` has one row per source, so the
    two windows see the list of sources, never documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.row_number().over(by_name) - 1) % len(weights) + 1)
    s = sizes.select("source", "source_size", weight.cast("double").alias("w"),
                     (F.col("source_size") * most).cast("double").alias("cap"))
    order = [F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    s = s.select("*", (F.sum("source_size").over(everything).cast("double")
                       - F.coalesce(F.sum("cap").over(before), F.lit(0.0))).alias("left"),
                 F.sum("w").over(after).alias("w_left"))
    s = s.withColumn("level", F.col("left") / F.col("w_left"))
    s = s.withColumn("level", F.min(F.when(F.col("cap") >= F.col("w") * F.col("level"),
                                           F.struct((F.col("cap") / F.col("w")).alias("at"),
                                                    "level"))).over(everything))
    return s.select("source", "source_size",
                    F.least("cap", F.col("w") * F.col("level.level")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights=WEIGHTS, most: int = MOST_REPEATS,
        seed: str = SEED) -> DataFrame:
    """``docs`` with size, source_size, target and copies (how often it is taken).

    Names that clash with columns of ``docs`` get trailing underscores.  Null or empty
    texts have size 0; the null source is a source and comes last; a source without
    words has target 0 and its documents are not taken.  Repeated rows draw alike.  An
    empty table gives no rows.
    """
    names = {n: fresh_name(n, docs.columns) for n in ("size", "source_size", "target",
                                                      "copies")}
    sized = docs.select("*", n_words(F.col(text_col)).alias(names["size"]))
    sizes = (docs.select(F.col(source_col).alias("source"),
                         n_words(F.col(text_col)).alias("n"))
             .groupBy("source").agg(F.sum("n").alias("source_size")))
    own = fresh_name("of_source", sized.columns)
    t = source_targets(sizes, weights, most).select(
        F.struct("source", "source_size", "target").alias(own))
    size, target = F.col(f"{own}.source_size"), F.col(f"{own}.target")
    joined = sized.join(t, F.col(f"`{source_col}`").eqNullSafe(F.col(f"{own}.source")))
    rate = F.when(size > 0, target / size).otherwise(0.0)
    whole = F.floor(rate)
    copies = whole + F.when(chance(id_col, seed) < rate - whole, 1).otherwise(0)
    return joined.select(
        *[F.col(f"`{c}`") for c in sized.columns], size.alias(names["source_size"]),
        target.alias(names["target"]),
        copies.cast("bigint").alias(names["copies"]))


def taken(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns it had."""
    n = fresh_name("copies", docs.columns)
    kept = mix(docs).where(F.col(n) > 0)
    one = F.explode(F.sequence(F.lit(1), F.col(n).cast("int")))
    return kept.select(*docs.columns, one.alias(fresh_name("copy_", docs.columns))
                       ).select(*docs.columns)
