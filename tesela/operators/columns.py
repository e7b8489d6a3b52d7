"""Projections that tolerate missing columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_present(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """The wanted columns that exist, each once, in the wanted order."""
    return df.select(*[c for c in dict.fromkeys(wanted) if c in df.columns])


def column_or(df: DataFrame, name: str, type_: str, default: object = None) -> Column:
    """The column when the table has it, else a typed default."""
    return F.col(name) if name in df.columns else F.lit(default).cast(type_)


def with_defaults(df: DataFrame, schema: Mapping[str, tuple[str, object]]) -> DataFrame:
    """Add every missing column of `schema` (name -> (type, default)) in one projection."""
    missing = {n: F.lit(d).cast(t) for n, (t, d) in schema.items() if n not in df.columns}
    return df.withColumns(missing) if missing else df


def feature_presence(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """One row per wanted column, telling whether the table has it."""
    rows = [(c, c in df.columns) for c in dict.fromkeys(wanted)]
    return df.sparkSession.createDataFrame(rows, "feature string, present boolean")


def to_long(
    df: DataFrame,
    ids: list[str],
    values: list[str],
    name: str = "feature",
    value: str = "value",
) -> DataFrame:
    """Wide to long: one row per id and value column, values as double."""
    wide = df.select(*ids, *[F.col(v).cast("double").alias(v) for v in values])
    return wide.unpivot(ids, values, name, value)
