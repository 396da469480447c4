"""Mixing sources to target weights.

Sources get weights in order of their names and share a budget of words by them. A target stops at
``MOST`` times its source's size; what is left over goes to the others by weight until none is above
(capped water-filling). In closed form: sources in order of cap over weight are clamped as long as
the level, the budget left over the weight left, lies above their own cap over weight.

Within a source the documents stand in the order of a seeded hash. Each is repeated as often as the
target holds the whole source; the rest of the target is one more repetition of the first documents
of that order, the last of them in part. Running sums are taken in three steps: over the 4,096 buckets
of the hash, within a bucket over its cells (rows of one source, id and size within 8,192 row numbers),
and within a cell, so that neither a source nor an id with a third of all rows has a task to itself.
Everything is a DataFrame expression.

Defined cases: a null or empty text has size 0 and takes nothing; the null source is one of the
sources, last in order; null ids and repeated rows are documents like any other; ties of the hash are
broken by id and size; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import picked, words
from tidemark.session import materialize

#: Weights of the sources in order, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix for each word there is, and how often a source may be repeated.
SHARE, MOST = 1.5, 2
SEED = "42"
#: Rows that tie are counted by runs of 2^13 row numbers.
CELL_BITS = 13


def size(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from ``sizes`` (source, source_size): one row for each source."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    filled = (
        sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
        .withColumn("total", F.sum("source_size").over(everything) * share)
        .withColumn("caps_before", F.sum("cap").over(by_level) - F.col("cap"))
        .withColumn("weights_left", F.sum("weight").over(everything) - F.sum("weight").over(by_level) + F.col("weight"))
        .withColumn("level", (F.col("total") - F.col("caps_before")) / F.col("weights_left"))
        .withColumn("clamped", F.col("cap") <= F.col("weight") * F.col("level"))
    )
    # the first source that is not clamped sets the level of all after it
    level = F.min(F.when(~F.col("clamped"), F.struct(F.col("cap") / F.col("weight"), F.col("caps_before"), "level"))).over(everything)
    return filled.withColumn("final", level["level"]).select(
        "source", "source_size",
        F.when(F.col("clamped"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("final")).alias("target"),
    )


def _order(seed: str) -> Column:
    """A seeded hash of the id; a source's documents stand in its order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))


def mix(docs: DataFrame, seed: str = SEED, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(doc_id, source, size, source_size, target, whole, extra, taken) for every row of ``docs``.

    ``whole`` repetitions of the document, plus its first ``extra`` words.
    """
    marked = materialize(
        picked(docs, "doc_id", "source", "text").select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source"), size(F.col("text")).alias("size"),
            _order(seed).alias("order"), F.monotonically_increasing_id().alias("row"),
        ),
        "sizes",
    )
    return plan(marked, weights, share, most).drop("row")


def plan(
    marked: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, keep_order: bool = False
) -> DataFrame:
    """Adds targets and takings to rows of (doc_id, source, size, order, row); ``row`` breaks ties."""
    bucket = F.substring("order", 1, 3)
    buckets = materialize(
        marked.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("in_bucket")), "bucket-sizes"
    )
    goals = targets(buckets.groupBy("source").agg(F.sum("in_bucket").alias("source_size")), weights, share, most)
    goals = (
        goals.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("more", F.floor("target") - F.col("whole") * F.col("source_size"))
    )
    before = F.sum("in_bucket").over(Window.partitionBy("source").orderBy("bucket")) - F.col("in_bucket")
    starts = buckets.select(F.col("source").alias("s"), F.col("bucket").alias("b"), before.alias("bucket_start"))
    goals = goals.select(F.col("source").alias("s"), "source_size", "target", "whole", "more")
    starts = materialize(
        starts.join(goals.withColumnRenamed("s", "g"), F.col("s").eqNullSafe(F.col("g"))).drop("g"), "bucket-starts"
    )
    cell = ["source", "order", "doc_id", "size", "run"]
    marked = marked.withColumn("run", F.shiftright("row", CELL_BITS))
    in_bucket = Window.partitionBy("source", "bucket").orderBy("order", F.col("doc_id").asc_nulls_first(), "size", "run").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    in_cell = F.col("n") * F.col("size")
    cells = marked.groupBy(*cell).agg(F.count("*").alias("n")).withColumn("bucket", bucket)
    cells = cells.withColumn("cell_start", F.sum(in_cell).over(in_bucket) - in_cell).join(
        starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))
    ).select(
        *[F.col(c).alias(f"cell_{c}") for c in cell], (F.col("bucket_start") + F.col("cell_start")).alias("start"),
        "source_size", "target", "whole", "more",
    )
    place = F.row_number().over(Window.partitionBy(*cell).orderBy("row"))
    same = F.lit(True)
    for c in cell:
        same = same & F.col(c).eqNullSafe(F.col(f"cell_{c}"))
    joined = marked.withColumn("place", place).join(cells, same)
    ends = F.col("start") + F.col("place") * F.col("size")
    extra = F.greatest(F.lit(0), F.least("size", F.col("more") - (F.col("ends") - F.col("size"))))
    return (
        joined.withColumn("ends", ends).withColumn("extra", extra)
        .withColumn("taken", F.col("whole") * F.col("size") + F.col("extra"))
        .drop(*[f"cell_{c}" for c in cell], "run", "place", "start", "more", "ends", *([] if keep_order else ["order"]))
    )


def cuts(marked: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row for each source: how often it is whole, and where in its order one more repetition ends.

    ``marked``: row, doc_id, source, size, order. ``full`` is the last document that is repeated
    entirely, ``part`` the one after it that is repeated up to ``part_words``, as (order, size, row).
    """
    place = F.struct("order", "size", "row")
    planned = plan(marked, weights, share, most, keep_order=True)
    is_part = (F.col("extra") > 0) & (F.col("extra") < F.col("size"))
    return planned.groupBy("source").agg(
        F.max("whole").alias("whole"),
        F.max(F.when((F.col("extra") == F.col("size")) & (F.col("size") > 0), place)).alias("full"),
        F.max(F.when(is_part, F.col("row"))).alias("part"),
        F.max(F.when(is_part, F.col("extra"))).alias("part_words"),
    )


def mixed_documents(docs: DataFrame, seed: str = SEED, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The mix itself: rows of ``docs`` (doc_id, text, lang, source, n_chars), repeated, the last of a source in part.

    A document without words is repeated as often as its source is whole. Texts are not
    shuffled: a document meets its source's one row, and its own place in the order tells the rest.
    """
    kept = ["doc_id", "text", "lang", "source", "n_chars"]
    w = words(F.col("text"))
    marked = picked(docs, *kept).select(
        *kept, F.size(w).cast("long").alias("size"), _order(seed).alias("order"),
        F.monotonically_increasing_id().alias("row"),
    )
    marked = materialize(marked, "marked")
    ends = cuts(marked.select("row", F.col("doc_id").cast("long").alias("doc_id"), "source", "size", "order"), weights, share, most)
    ends = materialize(ends.withColumnRenamed("source", "s"), "cuts")
    is_full = (F.col("size") > 0) & (F.struct("order", "size", "row") <= F.col("full"))
    is_part = F.col("row") == F.col("part")
    again = F.coalesce(is_full | is_part, F.lit(False))
    repeated = marked.join(ends, F.col("source").eqNullSafe(F.col("s"))).select(
        *kept, F.when(is_part, F.col("part_words")).alias("part_words"),
        F.explode(F.concat(
            F.array_repeat(F.lit(False), F.col("whole").cast("int")), F.array_repeat(F.lit(True), F.when(again, 1).otherwise(0))
        )).alias("again"),
    )
    part = F.col("again") & F.col("part_words").isNotNull()
    cut = F.array_join(F.slice(w, F.lit(1), F.coalesce("part_words", F.lit(1)).cast("int")), " ")
    return (
        repeated.withColumn("text", F.when(part, cut).otherwise(F.col("text")))
        .withColumn("n_chars", F.when(part, F.length("text").cast("long")).otherwise(F.col("n_chars")))
        .select(*kept)
    )
