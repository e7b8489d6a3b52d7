"""Joins of large keyed tables with smaller keyed ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(fact: DataFrame, dim: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Equi-join of a large table with a much smaller one that is looked up by `on`.

    A plain join, so filters and column choices above it reach both scans.  Adaptive execution
    measures `dim` and broadcasts it if it is below `spark.sql.autoBroadcastJoinThreshold`; else
    it sorts and merges, and splits the partitions of keys that hold much of `fact`.  It can only
    split what was shuffled for the join itself: rebalancing `dim` first, a small shuffle, keeps
    an aggregate on the same key from being joined where it was made.
    """
    if how not in ("left", "inner"):
        raise ValueError("attach joins left or inner")
    return fact.join(dim.hint("rebalance"), on, how)


def left_with_flag(
    fact: DataFrame, dim: DataFrame, on: list[str], flag: str, witness: str
) -> DataFrame:
    """Left join; `flag` tells whether the row found a dimension row with a `witness` value."""
    return attach(fact, dim, on).withColumn(flag, F.col(witness).isNotNull())


def one_row_per_key(dim: DataFrame, on: list[str], latest: str) -> DataFrame:
    """The row with the greatest `latest` for every key, by one partial aggregate."""
    rest = [c for c in dim.columns if c not in on and c != latest]
    newest = F.max(F.struct(F.col(latest), *rest)).alias("__row")
    kept = dim.where(F.col(latest).isNotNull()).groupBy(*on).agg(newest)
    return kept.select(*on, "__row.*")


def fact_to_yearly(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    fact_year: str,
    dim_year: str,
    policy: str = "fanout",
) -> DataFrame:
    """Inner join of facts with a dimension that has one row per key and year.

    `fanout` joins on the key only, so a fact row repeats for each year of its key; `latest`
    takes the newest year of each key; `same_year` joins on key and year.
    """
    if policy == "fanout":
        return attach(fact, dim, [key], "inner")
    if policy == "latest":
        return attach(fact, one_row_per_key(dim, [key], dim_year), [key], "inner")
    if policy == "same_year":
        renamed = dim.withColumnRenamed(dim_year, fact_year)
        return attach(fact, renamed, [key, fact_year], "inner")
    raise ValueError(f"unknown policy {policy!r}")


def match_rate(df: DataFrame, flag: str, by: list[str] | None = None) -> DataFrame:
    """Rows, matched rows and the percentage matched, overall or per group."""
    hit = F.col(flag).cast("int")
    return df.groupBy(*(by or [])).agg(
        F.count("*").alias("n_rows"),
        F.sum(hit).alias("n_matched"),
        (F.sum(hit) * 100.0 / F.count("*")).alias("pct_matched"),
    )
