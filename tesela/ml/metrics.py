"""Regression metrics as plain aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", digits: int | None = 4
) -> DataFrame:
    """rmse, mae, r2 and row count in one pass."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    residual = F.sum((y - p) * (y - p))
    spread = F.var_pop(y) * F.count(y)
    table = df.where(y.isNotNull() & p.isNotNull()).agg(
        F.sqrt(residual / F.nullif(F.count("*"), F.lit(0))).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
        (1 - residual / F.nullif(spread, F.lit(0.0))).alias("r2"),
        F.count("*").alias("n_test"),
    )
    if digits is None:
        return table
    return table.withColumns({c: F.round(c, digits) for c in ("rmse", "mae", "r2")})
