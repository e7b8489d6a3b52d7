"""Samples and splits decided by a hash of the row key, so they repeat on any layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_BITS = 32
PREFIX_BITS = 16


def hash_number(key: str, seed: int = 42) -> Column:
    """32-bit integer from a seeded 64-bit hash of the key."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key)), 64 - HASH_BITS)


def md5_number(key: str, seed: str = "") -> Column:
    """The same from MD5, which other engines can reproduce."""
    digest = F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def _cut(counts: DataFrame, n: int) -> tuple[int | None, int]:
    """The first digit at which the counts (digit, c) reach n, and what the digits before hold."""
    before = 0
    for digit, c in sorted(tuple(r) for r in counts.where("p is not null").collect()):  # 65,536 rows at most
        if before + c >= n:
            return digit, before
        before += c
    return None, before


def sample_rows(df: DataFrame, n: int, key: str | None = None, number: Column | None = None) -> DataFrame:
    """`n` rows in hash order (ties by key, without a key by all columns); fewer only if the
    table has fewer.

    The hash at which there are just enough rows is found digit by digit: a count of the first 16
    bits, then of the other bits of the rows at the cut.  The sample is then a filter on the
    hash, whatever n is; only rows of the very hash at the cut are ordered by key.
    """
    if number is None:
        number = hash_number(key) if key else F.shiftrightunsigned(F.xxhash64(F.lit(42), *map(_quoted, df.columns)), 64 - HASH_BITS)
    order = F.col(key) if key else F.struct(*map(_quoted, df.columns))
    low_bits = HASH_BITS - PREFIX_BITS
    prefix = F.shiftright(number, low_bits)
    first, before = _cut(df.groupBy(prefix.alias("p")).agg(F.count("*").alias("c")), n)
    if first is None:
        return df
    rest = number.bitwiseAND(F.lit((1 << low_bits) - 1))
    second, inside = _cut(df.where(prefix == first).groupBy(rest.alias("p")).agg(F.count("*").alias("c")), n - before)
    cut = (first << low_bits) + second
    ties = df.where(number == cut).orderBy(order).limit(n - before - inside)
    return df.where(number < cut).unionByName(ties)


def _quoted(column: str) -> Column:
    return F.col(f"`{column}`")


def sample_share(
    df: DataFrame, share: float, key: str, seed: int = 42, number: Column | None = None
) -> DataFrame:
    """About `share` of the rows, each decided by its own key, or by a `number` of 32 bits."""
    number = hash_number(key, seed) if number is None else number
    return df.where(number < int(share * (1 << HASH_BITS)))


def first_rows(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """Development sample: the first `n` rows by key."""
    return df.orderBy(*keys).limit(n)


def split_label(
    number: Column,
    shares: Sequence[float] = (0.70, 0.15, 0.15),
    names: Sequence[str] = ("train", "val", "test"),
) -> Column:
    """Split name by where a 32-bit number falls in the cumulated shares."""
    edge, out = 0.0, None
    for share, name in list(zip(shares, names))[:-1]:
        edge += share
        inside = number < int(round(edge * (1 << HASH_BITS)))
        out = F.when(inside, name) if out is None else out.when(inside, name)
    return F.lit(names[0]) if out is None else out.otherwise(names[-1])


def tag_split(df: DataFrame, key: str, seed: str = "42", **kw) -> DataFrame:
    """Add `split` and `is_val`; training and validation rows stay in one table."""
    tagged = df.withColumn("split", split_label(md5_number(key, seed), **kw))
    return tagged.withColumn("is_val", F.col("split") == "val")


def split_frames(
    df: DataFrame,
    key: str,
    shares: Sequence[float],
    names: Sequence[str],
    seed: int = 42,
    number: Column | None = None,
) -> dict[str, DataFrame]:
    """Disjoint parts by hash of the key, or by a `number` of 32 bits; a stable stand-in for
    `randomSplit`."""
    number = hash_number(key, seed) if number is None else number
    tagged = df.withColumn("__split", split_label(number, shares, names))
    return {n: tagged.where(F.col("__split") == n).drop("__split") for n in names}
