"""Group summaries, shares, pivots, correlations and distribution tables."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classes import ordinal
from ..functions.exact import exact_mean, exact_sum, rounded
from ..session import materialise
from .joins import attach
from .quantiles import column_quantiles, quantiles, tukey_fences


def group_count(df: DataFrame, by: list[str], out: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias(out)).orderBy(F.desc(out), *by)


def group_sums(df: DataFrame, by: list[str], sums: dict[str, str], scale=None) -> DataFrame:
    """Sums per group; `sums` maps output name to input column."""
    return df.groupBy(*by).agg(*[exact_sum(c, scale).alias(n) for n, c in sums.items()])


def group_means(
    df: DataFrame, by: list[str], columns: list[str], digits: int | None = 2, scale=None
) -> DataFrame:
    return df.groupBy(*by).agg(*[rounded(exact_mean(c, scale), digits).alias(c) for c in columns])


def score_stats(
    df: DataFrame,
    by: list[str],
    score: str,
    names: Sequence[str] = ("n_estudiantes", "punt_global_prom", "punt_global_std"),
    digits: int | None = 2,
    scale: int | None = None,
) -> DataFrame:
    """Rows, mean and sample standard deviation of a score per group."""
    n, mean, std = names
    return df.groupBy(*by).agg(
        F.count("*").alias(n),
        rounded(exact_mean(score, scale), digits).alias(mean),
        rounded(F.stddev_samp(score), digits).alias(std),
    )


def percent_of_rows(flag: Column | str) -> Column:
    """100 * sum(flag) / rows: a null flag counts in the denominator."""
    flag = F.col(flag) if isinstance(flag, str) else flag
    return F.sum(flag) * 100.0 / F.count("*")


def count_with_share(df: DataFrame, by: list[str], digits: int | None = 2) -> DataFrame:
    """Rows per class and their percentage of all rows."""
    counts = df.groupBy(*by).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", rounded(F.col("n") * 100.0 / total, digits))


def share_with_rest(
    df: DataFrame,
    by: str,
    value: str,
    least: float = 0.02,
    rest: str = "Otros",
    scale: int | None = None,
) -> DataFrame:
    """Sum and share per category; categories below `least` of the total become one row."""
    sums = df.groupBy(by).agg(exact_sum(value, scale).alias("total"))
    grand = sums.agg(exact_sum("total", scale)).scalar()
    named = sums.withColumn(by, F.when(F.col("total") < grand * least, rest).otherwise(F.col(by)))
    merged = named.groupBy(by).agg(exact_sum("total", scale).alias("total"))
    return merged.withColumn("share", F.col("total") / grand).orderBy(F.desc("total"), by)


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Columns that hold nulls, with count and percentage, most nulls first; one scan."""
    columns = columns or df.columns
    one = df.agg(
        F.count("*").alias("__rows"),
        *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in columns],
    )
    long = one.unpivot(["__rows"], columns, "column", "n_null")
    pct = F.round(F.col("n_null") * 100.0 / F.col("__rows"), 2)
    return (
        long.where(F.col("n_null") > 0)
        .select("column", "n_null", pct.alias("pct_null"))
        .orderBy(F.desc("n_null"), "column")
    )


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which all `columns` are known, as number and percentage of all rows."""
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    return df.agg(
        F.count("*").alias("n_total"),
        F.count(F.when(known, 1)).alias("n_known"),
        F.when(F.count("*") > 0, F.count(F.when(known, 1)) * 100.0 / F.count("*")).alias(
            "pct_known"
        ),
    )


def describe(
    df: DataFrame,
    columns: list[str],
    by: list[str] | None = None,
    digits: int | None = 6,
    scale: int | None = None,
    error: float | None = None,
) -> DataFrame:
    """count, mean, std, min, q25, q50, q75, max for every column (and group), long format."""
    by = by or []
    per_column = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            exact_mean(c, scale).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(F.col(c).cast("double")).alias("min"),
            F.max(F.col(c).cast("double")).alias("max"),
        )
        for c in columns
    ]
    moments = df.groupBy(*by).agg(F.array(*per_column).alias("all"))
    moments = moments.select(*by, F.explode("all").alias("m")).select(*by, "m.*")
    q = quantiles(df, columns, [0.25, 0.5, 0.75], by, error).drop("n")
    keys = [*by, "column"]
    renamed = q.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    same = moments["column"] == renamed["__r_column"]
    for k in by:
        same = same & moments[k].eqNullSafe(renamed[f"__r_{k}"])
    both = moments.join(renamed, same, "left")

    def r(c: Column) -> Column:
        return rounded(c, digits)

    return both.select(
        *keys,
        "count",
        r(F.col("mean")).alias("mean"),
        r(F.col("std")).alias("std"),
        "min",
        r(F.col("q")[0]).alias("q25"),
        r(F.col("q")[1]).alias("q50"),
        r(F.col("q")[2]).alias("q75"),
        "max",
    )


def safe_corr(a: str, b: str) -> Column:
    """Pearson correlation over rows where both are known; null when one side is constant."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x = F.when(both, F.col(a).cast("double"))
    y = F.when(both, F.col(b).cast("double"))
    varies = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    # corr() divides by the deviations and fails on a constant side, so the pair formula is
    # written with guarded division.
    spread = F.sqrt(F.var_pop(x) * F.var_pop(y))
    return F.when(varies, F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0)))


def correlation(df: DataFrame, a: str, b: str, digits: int | None = 6) -> DataFrame:
    n = F.count(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), 1))
    return df.agg(n.alias("n"), rounded(safe_corr(a, b), digits).alias("corr"))


def correlation_pairs(
    df: DataFrame, pairs: Sequence[tuple[str, str]], digits: int | None = 6
) -> DataFrame:
    """Correlation of each pair in one scan, one row per pair."""
    entries = [
        F.struct(
            F.lit(a).alias("a"),
            F.lit(b).alias("b"),
            rounded(safe_corr(a, b), digits).alias("corr"),
        )
        for a, b in pairs
    ]
    return df.agg(F.array(*entries).alias("all")).select(F.explode("all").alias("e")).select("e.*")


def correlation_matrix(df: DataFrame, columns: list[str], digits: int | None = 6) -> DataFrame:
    """Lower triangle of the pairwise-complete correlation matrix, long format.

    One scan: every Arrow batch gives the counts, means and centred sums of products of all pairs
    by a few matrix products over values and masks.  A task merges those of its batches and hands
    on one row for each pair, so what is shuffled grows with pairs and tasks, not with rows.
    Null when a side is constant or no row has both; NaN when a complete pair is not finite.
    """
    names = [(b, a) for a, b in combinations(columns, 2)]
    if not names:
        return df.sparkSession.createDataFrame([], "a string, b string, corr double")
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    parts = materialise(values.mapInArrow(_co_moments(len(columns)), _MOMENTS), "co-moments")
    means = parts.groupBy("i", "j").agg(
        (F.sum(F.col("n") * F.col("mi")) / F.sum("n")).alias("all_i"),
        (F.sum(F.col("n") * F.col("mj")) / F.sum("n")).alias("all_j"),
    )
    di, dj, n = F.col("mi") - F.col("all_i"), F.col("mj") - F.col("all_j"), F.col("n")
    merged = parts.join(means, ["i", "j"]).groupBy("i", "j").agg(
        F.sum(F.col("cii") + n * di * di).alias("cii"),
        F.sum(F.col("cjj") + n * dj * dj).alias("cjj"),
        F.sum(F.col("cij") + n * di * dj).alias("cij"),
        ((F.min("low_i") < F.max("high_i")) & (F.min("low_j") < F.max("high_j"))).alias("varies"),
        F.sum("odd").alias("odd"),
    )
    # The product of the roots, since that of the sums may be beyond the range of doubles.
    spread = F.nullif(F.sqrt("cii") * F.sqrt("cjj"), F.lit(0.0))
    corr = F.when(F.col("odd") > 0, F.lit(float("nan"))).when(F.col("varies"), F.col("cij") / spread)
    at = {c: k for k, c in enumerate(columns)}
    pairs = df.sparkSession.createDataFrame([(a, b, at[b], at[a]) for a, b in names], "a string, b string, i int, j int")
    return pairs.join(merged, ["i", "j"], "left").select("a", "b", rounded(corr, digits).alias("corr"))


_MOMENTS = (
    "i int, j int, n bigint, mi double, mj double, cii double, cjj double, cij double, "
    "low_i double, high_i double, low_j double, high_j double, odd bigint"
)


def _co_moments(size: int):
    """Worker function: the moments of all pairs i < j of the columns over one task's rows."""

    def of_batch(batch):
        import numpy as np

        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        known = np.column_stack([np.asarray(c.is_valid()) for c in batch.columns])
        x = np.column_stack(columns).astype(float)
        finite = known & np.isfinite(x)
        odd = (known & ~finite).astype(float)
        m = finite.astype(float)
        shift = np.where(finite, x, 0.0).sum(0) / np.maximum(m.sum(0), 1)
        x = np.where(finite, x - shift, 0.0)
        n = m.T @ m
        some = np.maximum(n, 1)
        mean = x.T @ m / some  # [i, j]: the mean of column i over the rows that know i and j
        own = (x * x).T @ m - some * mean * mean
        both = x.T @ x - some * mean * mean.T
        low, high = np.full((size, size), np.inf), np.full((size, size), -np.inf)
        for j in range(size):
            rows = x[finite[:, j]]
            if len(rows):
                there = finite[finite[:, j]]
                low[:, j] = np.where(there, rows, np.inf).min(0) + shift
                high[:, j] = np.where(there, rows, -np.inf).max(0) + shift
        known = known.astype(float)
        return n, mean + shift[:, None], np.maximum(own, 0), both, low, high, odd.T @ known + known.T @ odd

    def merge(a, b):
        import numpy as np

        n = a[0] + b[0]
        some = np.maximum(n, 1)
        apart = b[1] - a[1]
        weight = a[0] * b[0] / some
        mean = np.where(a[0] > 0, a[1] + apart * b[0] / some, b[1])
        own = a[2] + b[2] + apart * apart * weight
        both = a[3] + b[3] + apart * apart.T * weight
        return n, mean, own, both, np.minimum(a[4], b[4]), np.maximum(a[5], b[5]), a[6] + b[6]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        total = None
        for batch in batches:
            if batch.num_rows:
                part = of_batch(batch)
                total = part if total is None else merge(total, part)
        if total is None:
            return
        n, mean, own, both, low, high, odd = total
        i, j = np.triu_indices(size, 1)
        seen = (n[i, j] > 0) | (odd[i, j] > 0)
        i, j = i[seen], j[seen]
        columns = [i.astype(np.int32), j.astype(np.int32), n[i, j].astype(np.int64), mean[i, j], mean[j, i], own[i, j], own[j, i], both[i, j]]
        columns += [low[i, j], high[i, j], low[j, i], high[j, i], odd[i, j].astype(np.int64)]
        names = "i j n mi mj cii cjj cij low_i high_i low_j high_j odd".split()
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return run


def pivot_means(
    df: DataFrame,
    row: str,
    column: str,
    values: Sequence[str],
    score: str,
    row_order: Sequence[str] | None = None,
    digits: int | None = 2,
    scale: int | None = None,
) -> DataFrame:
    """Mean score by row and column class; declared column values avoid an extra job."""
    means = df.groupBy(row).pivot(column, list(values)).agg(
        rounded(exact_mean(score, scale), digits)
    )
    return means.orderBy(ordinal(row, row_order)) if row_order else means.orderBy(row)


def column_ranges(df: DataFrame, *columns: str) -> list[tuple[float, float]]:
    """Smallest and largest value of each column (two numbers per column)."""
    ends = [f(F.col(c).cast("double")) for c in columns for f in (F.min, F.max)]
    row = df.agg(*ends).first()
    return [(row[2 * i], row[2 * i + 1]) for i in range(len(columns))]


def bin_index(c: Column, lo: float, hi: float, bins: int) -> Column:
    """Equal-width bin from 1 to `bins`; the greatest value belongs to the last bin."""
    if lo is None or lo == hi:
        return F.lit(1)
    at = F.floor((c - F.lit(lo)) * bins / F.lit(hi - lo))
    return (F.least(at, F.lit(bins - 1)) + 1).cast("int")


def histogram(df: DataFrame, column: str, bins: int = 50, by: str | None = None) -> DataFrame:
    """Rows per equal-width bin with bin edges; empty bins are listed too."""
    known = df.where(F.col(column).isNotNull())
    ((low, high),) = column_ranges(known, column)
    index = bin_index(F.col(column).cast("double"), low, high, bins)
    keys = [by] if by else []
    counts = known.groupBy(*keys, index.alias("bin")).agg(F.count("*").alias("n"))
    every_bin = F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin")
    if by:
        grid = counts.select(by).distinct().select(by, every_bin)
        same = grid[by].eqNullSafe(counts[by]) & (grid["bin"] == counts["bin"])
        full = grid.join(counts.select(by, "bin", "n"), same, "left").select(
            grid[by], grid["bin"], "n"
        )
    else:
        grid = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
        full = grid.join(counts, "bin", "left")
    lo = F.lit(low).cast("double")
    width = (F.lit(high).cast("double") - lo) / bins
    return full.select(
        *keys,
        "bin",
        (lo + width * (F.col("bin") - 1)).alias("bin_from"),
        (lo + width * F.col("bin")).alias("bin_to"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def histogram_2d(df: DataFrame, x: str, y: str, bins: int = 50) -> DataFrame:
    """Rows per cell of an equal-width grid; cells without rows are left out."""
    known = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    x_range, y_range = column_ranges(known, x, y)
    return known.groupBy(
        bin_index(F.col(x).cast("double"), *x_range, bins).alias("x_bin"),
        bin_index(F.col(y).cast("double"), *y_range, bins).alias("y_bin"),
    ).agg(F.count("*").alias("n"))


def box_plot(
    df: DataFrame, by: list[str], value: str, k: float = 1.5, error: float | None = None
) -> DataFrame:
    """Quartiles, whisker ends (extreme values inside the fences) and outlier count per group."""
    q = tukey_fences(quantiles(df, [value], [0.25, 0.5, 0.75], by, error), k).select(
        *by, "low", "high", "q"
    )
    stats = q.withColumnsRenamed({"low": "__low", "high": "__high", "q": "__q"})
    v = F.col(value).cast("double")
    known = attach(df.where(v.isNotNull()).select(*by, v.alias("__v")), stats, by, "inner")
    inside = F.col("__v").between(F.col("__low"), F.col("__high"))
    return known.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.first("__q").getItem(0).alias("q1"),
        F.first("__q").getItem(1).alias("median"),
        F.first("__q").getItem(2).alias("q3"),
        F.min(F.when(inside, F.col("__v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("__v"))).alias("whisker_high"),
        F.count(F.when(~inside, 1)).alias("n_outliers"),
    )


def mean_interval(
    df: DataFrame, by: list[str], value: str, z: float = 1.96, digits=6, scale=None
) -> DataFrame:
    """Group mean with its normal confidence interval; one-row groups have no interval."""
    half = F.lit(z) * F.stddev_samp(value) / F.sqrt(F.nullif(F.count(value), F.lit(0)))
    mean = exact_mean(value, scale)
    return df.groupBy(*by).agg(
        F.count(value).alias("n"),
        rounded(mean, digits).alias("mean"),
        rounded(mean - half, digits).alias("ci_low"),
        rounded(mean + half, digits).alias("ci_high"),
    )


def value_summary(
    df: DataFrame, by: list[str], value: str, digits: int | None = 6, scale=None
) -> DataFrame:
    """Sum, mean and count per category, greatest sum first."""
    return (
        df.groupBy(*by)
        .agg(
            exact_sum(value, scale).alias("total"),
            rounded(exact_mean(value, scale), digits).alias("mean"),
            F.count(value).alias("n"),
        )
        .orderBy(F.desc_nulls_last("total"), *by)
    )


def frequent_value(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Most frequent non-null value of each column per group; ties go to the smallest.

    Counting per (group, value) first keeps the state at one row per distinct value instead of
    one map per group."""
    long = df.select(*by, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        by, columns, "__column", "__value"
    )
    counts = (
        long.where(F.col("__value").isNotNull())
        .groupBy(*by, "__column", "__value")
        .agg(F.count("*").alias("__n"))
    )
    best = counts.groupBy(*by, "__column").agg(
        F.min(F.struct((-F.col("__n")).alias("rank"), F.col("__value").alias("v"))).alias("b")
    )
    return best.groupBy(*by).pivot("__column", columns).agg(F.first("b.v"))


def population_stats(
    df: DataFrame, column: str, digits: int | None = 8, error: float | None = None
) -> DataFrame:
    """min, max, mean, population deviation and quartiles of one column, one row."""
    quartiles = column_quantiles(df, column, [0.25, 0.75], error) or [None, None]
    c = F.col(column)
    one = df.agg(
        F.count(c).alias("n"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
        rounded(F.avg(c), digits).alias("mean"),
        rounded(F.stddev_pop(c), digits).alias("std"),
    )
    p25, p75 = (F.lit(q).cast("double") for q in quartiles)
    return one.withColumns({"p25": rounded(p25, digits), "p75": rounded(p75, digits)})

