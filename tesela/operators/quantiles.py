"""Quantiles from mergeable sketches, and exact ones that look at few values.

A KLL sketch (Karnin, Lang, Liberty 2016) of a column is a few kilobytes whatever the number of
rows, is built in one scan and can be stored and merged for any coarser grouping.  Its quantiles
have a rank error; exact ones follow in a second scan: the sketch tells an interval that holds
the wanted rank, the values below it are only counted, and just the values inside, a few in a
hundred, are shuffled as (value, count) pairs.  The exact ranks of the interval are checked; a
miss, which is all but impossible, is answered by ranking all values.

Pairs are cut into value ranges of nearly equal numbers of pairs, and ranks follow from the
counts of the ranges before.  No task holds all values, and a value that occurs in a third of all
rows is still one pair.  Only range bounds (doubles, fewer than MOST_RANGES) come to the driver.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise
from .columns import to_long
from .joins import attach

# Pairs for one range, and how many ranges there are at most: their bounds come to the driver.
PAIRS_PER_RANGE = 20_000
MOST_RANGES = 65_536

# Rank error of the sketches that exact quantiles start from, and how many such errors the
# interval extends to either side.
NARROW, MARGIN = 0.0014, 4
# Groups of so few values are ranked whole; above it the neighbours of a rank are inside too.
FEW = 2000


def ranges_for(rows: int) -> int:
    """How many ranges a table is cut into: as many as its rows ask for."""
    return max(1, min(MOST_RANGES, -(-rows // PAIRS_PER_RANGE)))


def range_bounds(df: DataFrame, value: str, size: int) -> list[float]:
    """Distinct inner bounds of at most `size` value ranges with about equal numbers of rows."""
    cuts = [i / size for i in range(1, size)]
    if not cuts:
        return []
    found = df.agg(F.percentile_approx(F.col(value).cast("double"), cuts, 20 * size)).first()[0]
    return sorted(set(found or []))


def add_range(df: DataFrame, value: str, bounds: list[float], out: str) -> DataFrame:
    """Number of the range that holds the value: how many bounds are at or below it."""
    if not bounds:
        return df.withColumn(out, F.lit(0))
    splits = [float("-inf"), *bounds, float("inf")]
    cut = Bucketizer(splits=splits, inputCol=value, outputCol=out, handleInvalid="keep")
    return cut.transform(df).withColumn(out, F.col(out).cast("int"))


def value_counts(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Distinct non-null values of each group with their number of rows, written once."""
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).cast("double").alias("__value"))
        .agg(F.count("*").alias("__n"))
    )
    return materialise(counts, "counts")


def range_offsets(ranged: DataFrame, by: list[str]) -> DataFrame:
    """Rows in each range, rows before it and rows in total, per group.

    The ranges are shared by all groups, so no group, however large, has more in one range than
    all groups together: about PAIRS_PER_RANGE pairs."""
    per_range = ranged.groupBy(*by, "__range").agg(F.sum("__n").alias("__rows"))
    group = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    before = group.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    return per_range.select(
        *by,
        "__range",
        "__rows",
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"),
        F.sum("__rows").over(group).alias("__total"),
    )


def cumulative_counts(counts: DataFrame, by: list[str], keep_ranges=None, rows: int | None = None) -> DataFrame:
    """Value counts with `__before`, the rows of the group with a smaller value.

    The number of ranges follows the number of pairs, which the file footers tell, or `rows`.
    `keep_ranges` filters the offsets table and with it the ranges that are looked at."""
    bounds = range_bounds(counts, "__value", ranges_for(counts.count() if rows is None else rows))
    if not bounds:
        # One range: no more pairs than a task holds, so no offsets are needed.
        group = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
        earlier = group.orderBy("__value").rowsBetween(W.unboundedPreceding, -1)
        return counts.withColumns({"__total": F.sum("__n").over(group), "__before": F.coalesce(F.sum("__n").over(earlier), F.lit(0))})
    ranged = add_range(counts, "__value", bounds, "__range")
    offsets = range_offsets(ranged, by)
    if keep_ranges is not None:
        offsets = keep_ranges(offsets)
    keys = [*by, "__range"]
    inside = W.partitionBy(*keys).orderBy("__value").rowsBetween(W.unboundedPreceding, -1)
    joined = null_safe_join(ranged, offsets, keys)
    earlier = F.coalesce(F.sum("__n").over(inside), F.lit(0))
    return joined.withColumn("__before", F.col("__before") + earlier)


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join in which a null key equals a null key."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys])
    return left.join(renamed, same, how).drop(*[f"__r_{k}" for k in keys])


def _positions(probs: list[float]) -> list[tuple[Column, Column, Column]]:
    last = F.col("__total") - 1
    out = []
    for p in probs:
        at = last * F.lit(float(p))
        out.append((at, F.floor(at).cast("long"), F.ceil(at).cast("long")))
    return out


def exact_from_counts(counts: DataFrame, by: list[str], probs: list[float]) -> DataFrame:
    """Linearly interpolated quantiles, one row per group: `by`, n, q (array by `probs`)."""
    places = _positions(probs)
    needed = F.array(*[x for _, lo, hi in places for x in (lo, hi)])

    def holds(at: Column) -> Column:
        return (at >= F.col("__before")) & (at < F.col("__before") + F.col("__rows"))

    # Only the ranges that hold a wanted rank go on; the rest of the pairs is dropped here.
    pairs = cumulative_counts(counts, by, lambda o: o.where(F.exists(needed, holds)))

    def at_rank(rank: Column) -> Column:
        here = (rank >= F.col("__before")) & (rank < F.col("__before") + F.col("__n"))
        return F.max(F.when(here, F.col("__value")))

    bounds = [at_rank(r) for _, lo, hi in places for r in (lo, hi)]
    picked = pairs.groupBy(*by, "__total").agg(F.array(*bounds).alias("__at"))
    q = []
    for i, (at, lo, _) in enumerate(places):
        low, high = F.col("__at")[2 * i], F.col("__at")[2 * i + 1]
        q.append(low + (high - low) * (at - lo))
    return picked.select(*by, F.col("__total").alias("n"), F.array(*q).alias("q"))


def sketch_size(error: float) -> int:
    """The parameter k of a sketch whose ranks are within `error` of the exact ones (as a share
    of all rows) with 99 % confidence."""
    return int(min(65_535, max(8, math.ceil((2.296 / error) ** (1 / 0.9723)))))


def _sketch(column: str, error: float) -> Column:
    return F.kll_sketch_agg_double(F.col(column).cast("double"), F.lit(sketch_size(error)))


def quantile_sketches(df: DataFrame, columns: list[str], by: list[str] | None = None, error: float = 0.01) -> DataFrame:
    """`by`, column, n, sketch: one scan for all columns.  To be stored and merged."""
    by = by or []
    named = [F.struct(F.lit(c).alias("column"), F.col(f"__s{i}").alias("sketch")) for i, c in enumerate(columns)]
    wide = df.groupBy(*by).agg(*[_sketch(c, error).alias(f"__s{i}") for i, c in enumerate(columns)])
    rows = wide.select(*by, F.explode(F.array(*named)).alias("s")).select(*by, "s.column", "s.sketch")
    return rows.select(*by, "column", F.kll_sketch_get_n_double("sketch").alias("n"), "sketch")


def merge_sketches(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The sketches of a coarser grouping, without reading the rows again."""
    merged = sketches.groupBy(*(by or []), "column").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select(*(by or []), "column", F.kll_sketch_get_n_double("sketch").alias("n"), "sketch")


def sketch_quantiles(sketches: DataFrame, probs: list[float]) -> DataFrame:
    """`by`, column, n, q of stored sketches; sketches without values give no row."""
    by = [c for c in sketches.columns if c not in ("column", "n", "sketch")]
    found = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(p)) for p in probs])))
    return sketches.where("n > 0").select(*by, "column", "n", found.alias("q"))


def _intervals(df: DataFrame, columns: list[str], probs: list[float], by: list[str]) -> DataFrame:
    """One row per group: `by`, and for each column its number of values and an interval [low,
    high] for each quantile that should hold the values of the ranks next to it."""
    wide = df.groupBy(*by).agg(*[_sketch(c, NARROW).alias(f"__s{i}") for i, c in enumerate(columns)])
    shares = [F.lit(x) for p in probs for x in (max(p - MARGIN * NARROW, 0.0), min(p + MARGIN * NARROW, 1.0))]
    shares = F.array(*shares, F.lit(0.0), F.lit(1.0))
    out = [F.col(c) for c in by]
    for i in range(len(columns)):
        n = F.kll_sketch_get_n_double(f"__s{i}")
        found = F.when(n > 0, F.kll_sketch_get_quantile_double(f"__s{i}", shares))
        ends = [F.get(found, F.when(n > FEW, 2 * k + e).otherwise(2 * len(probs) + e)) for k in range(len(probs)) for e in (0, 1)]
        out += [n.alias(f"__n{i}"), F.array(*ends).alias(f"__b{i}")]
    return wide.select(*out)


def _at(rank: Column) -> Column:
    """The value whose pair covers the rank, among the pairs of a group."""
    return F.max(F.when((rank >= F.col("__before")) & (rank < F.col("__before") + F.col("__n")), F.col("__value")))


def _picked_by_group(placed: DataFrame, below: DataFrame, columns: list[str], probs: list[float], by: list[str]) -> DataFrame:
    """Quantiles of each group from the pairs inside its intervals and the counts below them."""
    wanted = []
    for i, column in enumerate(columns):
        for k, p in enumerate(probs):
            n = F.col(f"__n{i}")
            at = (n - 1) * F.lit(float(p))
            # The first value of the interval, for ranks that all its copies cover.
            first = F.struct(F.get(f"__b{i}", F.lit(2 * k)).alias("v"), F.col(f"__e{i}_{k}").alias("n"))
            parts = {"__c": F.lit(i), "__k": F.lit(k), "column": F.lit(column), "n": n, "__below": F.col(f"__l{i}_{k}"), "__at": at, "__first": first}
            wanted.append(F.struct(*[c.alias(name) for name, c in parts.items()]))
    wanted = below.select(*by, F.explode(F.array(*wanted)).alias("t")).select(*by, "t.*").where("n > 0")
    joined = null_safe_join(wanted, placed.drop("__total"), [*by, "__c", "__k"], "left")
    lo, hi = (_at(end("__at") - F.col("__below")) for end in (F.floor, F.ceil))
    picked = joined.groupBy(*by, "__k", "column", "n", "__at", "__below", "__first").agg(lo.alias("lo"), hi.alias("hi"))
    alone = (F.floor("__at") >= F.col("__below")) & (F.ceil("__at") < F.col("__below") + F.col("__first.n"))
    picked = picked.withColumns({c: F.coalesce(c, F.when(alone, F.col("__first.v"))) for c in ("lo", "hi")})
    q = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("__at") - F.floor("__at"))
    found = picked.groupBy(*by, "column", "n").agg(F.array(*[F.max(F.when(F.col("__k") == k, q)) for k in range(len(probs))]).alias("q"))
    return materialise(found, "quantiles")


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float], by: list[str] | None = None) -> DataFrame:
    """`by`, column, n, q: linearly interpolated quantiles by narrowing.  Nulls and NaN are no
    values; a group and column without values gives no row."""
    by = by or []
    spark, places = df.sparkSession, [(i, k) for i in range(len(columns)) for k in range(len(probs))]
    values = df.select(*by, *[F.col(c).cast("double").alias(f"__v{i}") for i, c in enumerate(columns)])
    bounds = _intervals(df, columns, probs, by)
    if by:
        bounds = materialise(bounds, "intervals")
        rows, expected = attach(values, bounds, by), None
        ends = {(i, k): (F.col(f"__b{i}")[2 * k], F.col(f"__b{i}")[2 * k + 1]) for i, k in places}
    else:
        # A few numbers for each column: literals keep the second scan free of joins.
        row, rows = bounds.first(), values
        ends = {(i, k): tuple(F.lit(row[f"__b{i}"][2 * k + e]).cast("double") for e in (0, 1)) for i, k in places}
        expected = sum(min(row[f"__n{i}"], FEW + int(row[f"__n{i}"] * 2 * MARGIN * NARROW)) for i, _ in places)

    # Values below an interval are only counted, and so are those of an interval of one value;
    # the others inside are dealt by value.
    entries, touched = [], F.lit(False)
    for i, k in places:
        low, high = ends[i, k]
        inside = (low < high) & (F.col(f"__v{i}") >= low) & (F.col(f"__v{i}") <= high)
        touched = touched | F.coalesce(inside, F.lit(False))
        entries.append(F.when(inside, F.struct(F.lit(i).alias("__c"), F.lit(k).alias("__k"), F.col(f"__v{i}").alias("__value"))))
    met = rows.where(touched).select(*by, F.explode(F.array_compact(F.array(*entries))).alias("t")).select(*by, "t.*")
    keys = [*by, "__c", "__k"]
    pairs = met.groupBy(*keys, "__value").agg(F.count("*").alias("__n"))
    if expected is None or ranges_for(expected) > 1:  # read more than once
        pairs = materialise(pairs, "inside")
    placed = cumulative_counts(pairs, keys, rows=expected)
    counts = [F.count(F.when(F.col(f"__v{i}") < ends[i, k][0], 1)).alias(f"__l{i}_{k}") for i, k in places]
    counts += [F.count(F.when(F.col(f"__v{i}") == ends[i, k][0], 1)).alias(f"__e{i}_{k}") for i, k in places]
    below = rows.groupBy(*by).agg(*counts)
    if by:
        found = _picked_by_group(placed, null_safe_join(below, bounds, by), columns, probs, by)
        missed = not found.where(F.exists("q", lambda x: x.isNull())).isEmpty()
    else:
        counted = below.first()
        at = {(i, k): (row[f"__n{i}"] - 1) * float(probs[k]) for i, k in places}
        ranks = [(i, k, math.floor(at[i, k]) - counted[f"__l{i}_{k}"], math.ceil(at[i, k]) - counted[f"__l{i}_{k}"]) for i, k in places]
        alone = {(i, k): row[f"__b{i}"][2 * k] for i, k, lo, hi in ranks if lo >= 0 and hi < counted[f"__e{i}_{k}"]}
        ranks = spark.createDataFrame([r for r in ranks if r[:2] not in alone], "__c int, __k int, __lo long, __hi long")
        near = placed.join(F.broadcast(ranks), ["__c", "__k"]).where("__before <= __hi and __lo < __before + __n")
        both = near.groupBy("__c", "__k").agg(_at(F.col("__lo")).alias("lo"), _at(F.col("__hi")).alias("hi"))
        picked = {p: (v, v) for p, v in alone.items()}
        if len(alone) < len(places):
            picked |= {(r["__c"], r["__k"]): (r["lo"], r["hi"]) for r in both.collect()}
        known = [i for i in range(len(columns)) if row[f"__n{i}"]]
        missed = any(None in picked.get((i, k), (None,)) for i in known for k in range(len(probs)))
        if not missed:
            between = {p: lo + (hi - lo) * (at[p] - math.floor(at[p])) for p, (lo, hi) in picked.items()}
            found = [(columns[i], row[f"__n{i}"], [between[i, k] for k in range(len(probs))]) for i in known]
            found = spark.createDataFrame(found, "column string, n long, q array<double>")
    if not missed:
        return found
    long = to_long(df, by, columns, "column", "value")
    every = [*by, "column"]
    return exact_from_counts(value_counts(long.where(~F.isnan(F.col("value").cast("double"))), "value", every), every, probs)


def quantiles(
    df: DataFrame,
    columns: list[str],
    probs: list[float],
    by: list[str] | None = None,
    error: float | None = None,
) -> DataFrame:
    """Quantiles of several columns: `by`, column, n, q.

    Exact with linear interpolation (two scans), or with `error` from sketches of that rank
    error (one scan, bounded memory).
    """
    if error is None:
        return exact_quantiles(df, columns, probs, by)
    return sketch_quantiles(quantile_sketches(df, columns, by, error), probs)


def column_quantiles(
    df: DataFrame, column: str, probs: list[float], error: float | None = None
) -> list[float] | None:
    """Quantiles of one column as numbers on the driver, or None without values.

    Numbers keep later plans flat: a subquery would carry the whole plan of `df` with it."""
    row = quantiles(df, [column], probs, error=error).first()
    return None if row is None else list(row["q"])


def fences(q1: float, q3: float, k: float = 1.5) -> tuple[float, float]:
    return q1 - k * (q3 - q1), q3 + k * (q3 - q1)


def tukey_fences(quartiles: DataFrame, k: float = 1.5) -> DataFrame:
    """Add `low` and `high` to a quantile table whose q is [Q1, Q3] or [Q1, median, Q3]."""
    q1, q3 = F.element_at("q", 1), F.element_at("q", -1)
    return quartiles.withColumns({"low": q1 - (q3 - q1) * k, "high": q3 + (q3 - q1) * k})
