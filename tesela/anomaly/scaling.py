"""Z-scores with the statistics of a training part."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def train_stats(train: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; a constant column gets deviation 1."""
    aggs = [f(F.col(c).cast("double")) for c in columns for f in (F.avg, F.stddev_pop)]
    row = train.agg(*aggs).first()
    return {c: (row[2 * i] or 0.0, row[2 * i + 1] or 1.0) for i, c in enumerate(columns)}


def zscore(
    df: DataFrame, stats: dict[str, tuple[float, float]], digits: int | None = None
) -> DataFrame:
    def scaled(c: str, mean: float, std: float):
        z = (F.col(c).cast("double") - F.lit(mean)) / F.lit(std)
        return z if digits is None else F.round(z, digits)

    return df.withColumns({c: scaled(c, *s) for c, s in stats.items()})


def array_stats(train: DataFrame, column: str) -> list[tuple[float, float]]:
    """The same for the positions of an array column (a fixed number of positions)."""
    long = train.select(F.posexplode(column).alias("i", "v"))
    rows = long.groupBy("i").agg(F.avg("v"), F.stddev_pop("v")).orderBy("i").collect()
    return [(r[1], r[2] or 1.0) for r in rows]


def zscore_array(df: DataFrame, column: str, stats: list[tuple[float, float]]) -> DataFrame:
    means = F.array(*[F.lit(float(m)) for m, _ in stats])
    stds = F.array(*[F.lit(float(s)) for _, s in stats])
    centred = F.zip_with(column, means, lambda x, m: x.cast("double") - m)
    return df.withColumn(column, F.zip_with(centred, stds, lambda x, s: x / s))
