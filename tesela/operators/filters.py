"""Row filters.  The `_or_null` filters let nulls pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import attach
from .quantiles import column_quantiles, fences, quantiles, tukey_fences


def keep_status(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose trimmed, upper-cased text equals `value`; nulls drop."""
    return df.where(F.upper(F.trim(F.col(column).cast("string"))) == value)


def drop_value(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose trimmed, upper-cased text is anything but `value`; nulls stay."""
    return df.where(~F.upper(F.trim(F.col(column).cast("string"))).eqNullSafe(value))


def keep_known(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(how="any", subset=list(columns))


def in_range_or_null(
    df: DataFrame, column: str, low: float | None = None, high: float | None = None
) -> DataFrame:
    c = F.col(column)
    inside = F.lit(True)
    if low is not None:
        inside = inside & (c >= low)
    if high is not None:
        inside = inside & (c <= high)
    return df.where(c.isNull() | inside)


def contains_or_null(df: DataFrame, column: str, *words: str) -> DataFrame:
    """Rows whose text holds one of `words` in any letter case, or no text at all."""
    text = F.lower(F.trim(F.col(column).cast("string")))
    hit = F.lit(False)
    for word in words:
        hit = hit | text.contains(word.lower())
    return df.where(text.isNull() | hit)


def keep_members(df: DataFrame, column: str, *values: object) -> DataFrame:
    return df.where(F.col(column).isin(*values))


def usable_label(column: str, low: float = 0, high: float | None = 500) -> Column:
    """Whether a label is present and inside the range."""
    c = F.col(column)
    return c >= low if high is None else c.between(low, high)


def keep_label(df: DataFrame, column: str, low: float = 0, high: float | None = 500) -> DataFrame:
    """Rows with a usable label."""
    return df.where(usable_label(column, low, high))


def drop_any_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(how="any", subset=columns)


def drop_all_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(how="all", subset=columns)


def iqr_filter(
    df: DataFrame,
    column: str,
    by: list[str] | None = None,
    k: float = 1.5,
    error: float | None = None,
) -> DataFrame:
    """Drop values outside [Q1 - k*IQR, Q3 + k*IQR], over all rows or within each group.

    `error` switches from exact quartiles to sketches with that rank error.  Nulls stay; a
    missing or empty column leaves the table as it is.
    """
    if column not in df.columns:
        return df
    by = by or []
    c = F.col(column)
    if not by:
        quartiles = column_quantiles(df, column, [0.25, 0.75], error)
        if quartiles is None:
            return df
        return in_range_or_null(df, column, *fences(*quartiles, k))
    table = tukey_fences(quantiles(df, [column], [0.25, 0.75], by, error), k)
    per_group = table.select(*by, F.col("low").alias("__low"), F.col("high").alias("__high"))
    tagged = attach(df, per_group, by)
    inside = c.between(F.col("__low"), F.col("__high"))
    return tagged.where(c.isNull() | F.coalesce(inside, F.lit(True))).select(*df.columns)
