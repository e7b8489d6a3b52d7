"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Every source gets a budget of words from its weight.  A budget above the size of its source is
first filled with complete epochs; what remains of it is filled by a weighted sample without
replacement: each document draws -ln(u) / quality from a hash, documents are sorted by it within
their source, and the words of the documents before decide whether one is still taken.

The order is cut into ranges of (source, key) of nearly equal numbers of rows, so a source with a
third of all rows is in many tasks; words before a range come from the sums of the ranges.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tesela.operators.quantiles import ranges_for
from tesela.operators.ranking import global_row_number

from .common import materialise, text_of, whole_number

#: A word: anything but blanks and the control characters that end lines and columns.
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of the hash that a document draws.
HASH_BITS = 52

GROUP = ["no_source", "source"]


def line_quality(text: Column) -> Column:
    """0.1 to 1: texts of which many lines are repeats of others weigh less."""
    lines = F.split(text, "\n", -1)
    return F.lit(0.1) + F.lit(0.9) * F.size(F.array_distinct(lines)) / F.size(lines)


def draw(key: Column, text: Column) -> Column:
    """A number in (0, 1) that the id and the text of a document decide."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), text))
    number = F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")
    return (number + F.lit(0.5)) / F.lit(float(1 << HASH_BITS))


def cyclic_weights(sources: DataFrame, weights: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """Add `weight`: the sources by code point, null last, take the weights in turn."""
    numbered = global_row_number(sources, "no_source", "source", "_place").drop("__total")
    turn = ((F.col("_place") - 1) % len(weights) + 1).cast("int")
    return numbered.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn)).drop("_place")


def water_level(sources: DataFrame, budget: int) -> float:
    """The words for a weight of one at which the sources together get `budget`.

    `sources` has weight and cap.  Shares above a cap are cut to it and their excess is dealt
    anew by weight, until no share is above.  Each round is one aggregate over the sources.
    """
    level, capped = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > F.col("cap")
        full, free, n = sources.agg(
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
            F.count(F.when(over, 1)),
        ).first()
        if n == capped:
            return level
        if not free:
            return math.inf
        level, capped = (budget - full) / free, n


def targets(rows: DataFrame, weights=cyclic_weights, most: int = 3, budget: int | None = None) -> DataFrame:
    """no_source, source, source_size, target, epochs and rest (words beyond the epochs)."""
    sizes = materialise(rows.groupBy(*GROUP).agg(F.sum("size").alias("source_size")), "sources")
    sources = materialise(weights(sizes).withColumn("cap", F.col("source_size") * most), "weighted")
    if budget is None:
        budget = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    share = F.when(F.col("weight") == 0, 0.0).otherwise(F.col("weight") * F.lit(water_level(sources, budget)))
    target = F.least(share, F.col("cap").cast("double"))
    epochs = F.when(F.col("source_size") > 0, F.floor(target / F.col("source_size"))).otherwise(0)
    return sources.select(
        *GROUP,
        "source_size",
        target.alias("target"),
        epochs.alias("epochs"),
        (target - epochs * F.col("source_size")).alias("rest"),
    )


def mix(
    docs: DataFrame,
    weights=cyclic_weights,
    most: int = 3,
    budget: int | None = None,
    quality=line_quality,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per row of `docs`: doc_id, source, size, source_size, target, copies, taken.

    `weights` adds the column `weight` to a table of sources (no_source, source); `budget` is the
    number of words of the mix, all words if None; no source gets more than `most` times its own.
    `copies` says how often the mix holds a document, `taken` how many words that makes.  Whole
    documents are taken: the last one of a source only if that comes nearer to its target, so a
    source misses its target by half a document at most.

    Null and empty texts have no words and none are taken.  Null is a source of its own, an empty
    source name another.  Equal keys are ordered by id and size; rows with equal id and text are
    rows of their own with equal keys.  A document of any length is one row.  An empty table gives
    no rows.  Other columns of `docs` are not read.
    """
    words = text_of(text)
    rows = docs.select(
        whole_number(key).alias("doc_id"),
        F.col(f"`{source}`").isNull().alias("no_source"),
        F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("source"),
        F.regexp_count(words, F.lit(WORD)).cast("long").alias("size"),
        (-F.log(draw(whole_number(key), words)) / quality(words)).alias("drawn"),
    )
    rows = materialise(rows, "mix-rows")
    wanted = materialise(targets(rows, weights, most, budget), "targets")

    order = ["drawn", "doc_id", "size"]
    ranged = rows.repartitionByRange(ranges_for(rows.count()), *GROUP, *order).withColumn("range", F.spark_partition_id())
    ranged = materialise(ranged, "mix-ranges")
    sums = ranged.groupBy(*GROUP, "range").agg(F.sum("size").alias("range_size"))
    earlier = W.partitionBy(*GROUP).orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    marks = sums.withColumn("before", F.coalesce(F.sum("range_size").over(earlier), F.lit(0))).join(wanted, GROUP)
    placed = ranged.join(materialise(marks, "mix-marks"), [*GROUP, "range"])

    # Only the range in which a budget ends is looked at row by row: one for each source.
    ends = (F.col("before") < F.col("rest")) & (F.col("rest") < F.col("before") + F.col("range_size"))
    inside = W.partitionBy(*GROUP, "range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    middle = 2 * (F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))) + F.col("size")
    judged = placed.where(ends).withColumn("last", middle <= 2 * F.col("rest"))
    judged = judged.unionByName(placed.where(~ends).withColumn("last", F.col("before") + F.col("range_size") <= F.col("rest")))
    copies = F.when(F.col("size") > 0, F.col("epochs") + F.col("last").cast("long")).otherwise(0)
    return judged.select(
        "doc_id",
        F.when(~F.col("no_source"), F.col("source")).alias("source"),
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: doc_id, source and epoch, one row for each copy that is taken."""
    found = mix(docs, **options).where("copies > 0")
    return found.select("doc_id", "source", F.explode(F.sequence(F.lit(1), "copies")).alias("epoch"))
