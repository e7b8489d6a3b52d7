"""Ranks, tiles, top lists and samples without a single-task sort of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise
from .quantiles import null_safe_join, ranges_for


def average_rank_pct(
    df: DataFrame, column: str, out: str, digits: int = 2, by: list[str] | None = None
) -> DataFrame:
    """Percentile rank in (0, 100]; equal values share the mean of their ranks; null stays null.

    Rows are dealt into ranges of (`by`, value) and written once; a value in a third of all rows
    is spread over as many ranges as it fills.  Ranks inside a range count from its first row.
    Only the runs of equal values at the two ends of a range can go on in other ranges, and what
    they hold there follows from one short row for each range.  Nothing is joined by value.
    """
    by = by or []
    value, salt, part = F.col(column).cast("double"), F.monotonically_increasing_id(), F.spark_partition_id()
    keys = [F.col(c).asc_nulls_first() for c in by]
    ranged = df.withColumns({"__value": value, "__salt": salt})
    ranged = ranged.repartitionByRange(ranges_for(df.count()), *keys, F.col("__value").asc_nulls_first(), "__salt")
    ranged = materialise(ranged.withColumn("__range", part).drop("__salt"), "rank-ranges")
    known = ranged.where("__value is not null")
    cell = [*by, "__range"]
    inside = W.partitionBy(*cell).orderBy("__value")
    counted = known.withColumns({
        "__before": F.rank().over(inside) - 1,
        "__n": F.count("*").over(inside.rangeBetween(W.currentRow, W.currentRow)),
    })
    placed = null_safe_join(counted, _range_ends(known, by), cell)
    low, high = F.col("__value") == F.col("__low"), F.col("__value") == F.col("__high")
    before = F.when(low, F.col("__low_before")).when(high, F.col("__high_before")).otherwise(F.col("__start") + F.col("__before"))
    n = F.when(low, F.col("__low_n")).when(high, F.col("__high_n")).otherwise(F.col("__n"))
    share = F.round((before + (n + 1) / F.lit(2.0)) / F.col("__total") * 100, digits)
    kept = [F.col(f"`{c}`") for c in df.columns if c != out]
    unknown = ranged.where("__value is null").select(*kept, F.lit(None).cast("double").alias(out))
    return placed.select(*kept, share.alias(out)).unionByName(unknown)


def _range_ends(known: DataFrame, by: list[str]) -> DataFrame:
    """One row for each range and group: the rows of the group before it and in total, and for
    its least and its greatest value the rows of the group below that value and at it."""
    cell = [*by, "__range"]
    ends = known.groupBy(*cell).agg(F.min("__value").alias("__low"), F.max("__value").alias("__high"), F.count("*").alias("__rows"))
    ends = materialise(ends, "range-ends")
    at = null_safe_join(known.select(*cell, "__value"), ends, cell)
    at = at.groupBy(*cell, "__low", "__high", "__rows").agg(
        F.count_if(F.col("__value") == F.col("__low")).alias("__at_low"),
        F.count_if(F.col("__value") == F.col("__high")).alias("__at_high"),
    )
    # At most MOST_RANGES rows for each group, and one more for each further group of a range.
    group = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    start = F.coalesce(F.sum("__rows").over(group.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    at = at.withColumns({"__start": start, "__total": F.sum("__rows").over(group)})
    one = F.col("__low") == F.col("__high")
    after = F.col("__start") + F.col("__rows") - F.col("__at_high")

    def end(side: str, below: Column, n: Column) -> Column:
        fields = {"side": F.lit(side), "value": F.col(f"__{side}"), "below": below.cast("long"), "n": n.cast("long")}
        return F.struct(*[c.alias(name) for name, c in fields.items()])

    sides = F.array(end("low", F.col("__start"), F.col("__at_low")), end("high", after, F.when(one, 0).otherwise(F.col("__at_high"))))
    sides = at.select(*cell, "__low", "__high", "__start", "__total", F.explode(sides).alias("s"))
    same = W.partitionBy(*by, F.col("s.value"))
    sides = sides.withColumns({"__below": F.min("s.below").over(same), "__at": F.sum("s.n").over(same)})

    def of(side: str, what: str) -> Column:
        return F.max(F.when(F.col("s.side") == side, F.col(what)))

    return sides.groupBy(*cell, "__low", "__high", "__start", "__total").agg(
        of("low", "__below").alias("__low_before"),
        of("low", "__at").alias("__low_n"),
        of("high", "__below").alias("__high_before"),
        of("high", "__at").alias("__high_n"),
    )


def global_row_number(df: DataFrame, order: str, tie: str, out: str) -> DataFrame:
    """Row number over the whole table by (`order`, `tie`), nulls first.

    Spark's range partitioning by both columns, of whatever type, deals the rows into ranges
    whose number follows the number of rows; a value in a third of all rows is cut again by the
    tie column.  The dealt rows are written once, so that a task that runs again finds the same
    ranges; each range is numbered by itself and moved by the rows before it.
    """
    keys = [F.col(order).asc_nulls_first(), F.col(tie).asc_nulls_first()]
    ranged = df.repartitionByRange(ranges_for(df.count()), *keys).withColumn("__range", F.spark_partition_id())
    ranged = materialise(ranged, "ranges")
    # One row per range, MOST_RANGES at most: small enough for one task and to broadcast.
    every = W.partitionBy(F.lit(0))
    before = every.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranged.groupBy("__range").agg(F.count("*").alias("__rows"))
    offsets = offsets.select(
        "__range",
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"),
        F.sum("__rows").over(every).alias("__total"),
    )
    local = W.partitionBy("__range").orderBy(*keys)
    numbered = ranged.join(F.broadcast(offsets), "__range")
    return numbered.withColumn(out, F.col("__before") + F.row_number().over(local)).drop("__range", "__before")


def global_ntile(
    df: DataFrame, n: int, order: str, tie: str, out: str, row_number: str | None = None
) -> DataFrame:
    """`ntile(n)` over the whole table; the first tiles take the remainder."""
    position = row_number or "__rn"
    numbered = global_row_number(df, order, tie, position)
    at = F.col(position) - 1
    size = F.floor(F.col("__total") / n)
    extra = F.col("__total") % n
    wide = extra * (size + 1)
    tile = F.when(at < wide, F.floor(at / (size + 1))).otherwise(
        extra + F.floor((at - wide) / F.greatest(size, F.lit(1)))
    )
    return numbered.withColumn(out, (tile + 1).cast("int")).drop("__rn", "__total")


def top_n_per_group(
    df: DataFrame, by: list[str], n: int, order: list[Column], out: str = "position"
) -> DataFrame:
    """First `n` rows of every group in the given total order, with their position.

    Spark cuts each map task to its own first n rows per group before the shuffle (window group
    limit), so a hot group sends few rows; `spark.sql.optimizer.windowGroupLimitThreshold` says
    up to which n.
    """
    w = W.partitionBy(*by).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= n)


def best_and_worst(df: DataFrame, k: int, value: str, tie: str) -> DataFrame:
    """The `k` smallest and the `k` largest values, each list with its positions.

    Every row is read once and offered to both lists; each task keeps its own first k rows of a
    list, so few rows travel."""
    v, t = F.col(value), F.col(tie)
    known = df.where(v.isNotNull())
    sides = known.select(F.explode(F.array(F.lit("lowest"), F.lit("highest"))).alias("side"), "*")
    low = F.col("side") == "lowest"
    keys = [
        F.when(low, v).asc(),
        F.when(low, t).asc(),
        F.when(~low, v).desc(),
        F.when(~low, t).desc(),
    ]
    return top_n_per_group(sides, ["side"], k, keys).select("side", "position", *df.columns)


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(k)


def arg_max(df: DataFrame, pick: str, value: str, by: list[str] | None = None) -> DataFrame:
    """`pick` at the greatest `value` and the value itself; ties go to the smaller `pick`."""
    return _arg(df, pick, value, by, F.max, -F.col(pick).cast("double"))


def arg_min(df: DataFrame, pick: str, value: str, by: list[str] | None = None) -> DataFrame:
    return _arg(df, pick, value, by, F.min, F.col(pick).cast("double"))


def _arg(df, pick, value, by, choose, tie):
    best = choose(F.struct(F.col(value).alias("v"), tie.alias("t"), F.col(pick).alias("p")))
    rows = df.where(F.col(value).isNotNull()).groupBy(*(by or [])).agg(best.alias("b"))
    return rows.select(*(by or []), F.col("b.p").alias(pick), F.col("b.v").alias(value))
