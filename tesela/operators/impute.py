"""Filling nulls from column statistics (one number per column)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exact import exact_mean
from .quantiles import quantiles


def impute_mean(df: DataFrame, column: str, scale: int | None = None) -> DataFrame:
    """Fill one column with its mean; without any value it stays null."""
    if column not in df.columns:
        return df
    mean = df.agg(exact_mean(column, scale)).first()[0]
    filled = F.coalesce(F.col(column).cast("double"), F.lit(mean).cast("double"))
    return df.withColumn(column, filled)


def impute_median(
    df: DataFrame, columns: list[str], default: float = 0.0, error: float | None = None
) -> DataFrame:
    """Fill every listed column with its median, or with `default` when it has no values.

    All medians come from one grouped pass; its result is one row per column."""
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    found = quantiles(df, columns, [0.5], error=error).collect()
    medians = {row["column"]: row["q"][0] for row in found}
    return df.withColumns(
        {
            c: F.coalesce(F.col(c).cast("double"), F.lit(float(medians.get(c, default))))
            for c in columns
        }
    )
