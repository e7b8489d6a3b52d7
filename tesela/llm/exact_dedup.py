"""Exact duplicates against an immutable snapshot, screened by static binary fuse filters.

The rows are a snapshot and a new batch.  The batch is grouped by digest on its own.  For each
bucket of the snapshot's digests a filter of about nine bits a digest is built once; digests of
the batch that a filter does not know are new for certain, the others are joined to the exact
bucket.  Texts of equal digest are then compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh_name, materialise, sized, text_digest, text_of, whole_number

#: Digests for one filter; the number of filters grows with the larger of snapshot and batch.
FILTER_KEYS = 32_768

FILTER = "bucket bigint, seed bigint, segment bigint, span bigint, table binary"


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser over the keys and the seed."""
    h = keys + np.uint64(seed)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _places(h: np.ndarray, segment: int, span: int) -> np.ndarray:
    """The three slots of each hash, in three consecutive segments."""
    mask = np.uint64(segment - 1)
    first = ((h >> np.uint64(32)) * np.uint64(span)) >> np.uint64(32)
    second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * segment)) ^ (h & mask)
    return np.stack([first, second, third]).astype(np.int64)


def _prints(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8)


class BinaryFuseFilter:
    """A static set of 64-bit keys, one byte a slot and 1.125 to 2 slots a key.  It knows every
    key of the set, and one of 256 others by mistake."""

    def __init__(self, seed: int, segment: int, span: int, table: np.ndarray):
        self.seed, self.segment, self.span, self.table = seed, segment, span, table

    @classmethod
    def build(cls, keys: np.ndarray) -> BinaryFuseFilter:
        keys = np.unique(np.asarray(keys, np.uint64))
        n = max(len(keys), 2)
        segment = min(1 << max(2, int(np.floor(np.log(n) / np.log(3.33) + 2.25))), 262_144)
        factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(n))
        segments = max(1, -(-int(n * factor) // segment) - 2)
        for seed in range(1, 1000):
            span = segments * segment
            h = _mix(keys, seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            order = cls._peel(_places(h, segment, span), (segments + 2) * segment)
            if order is not None:
                return cls(seed, segment, span, cls._fill(_places(h, segment, span), _prints(h), order, (segments + 2) * segment))
            if seed % 20 == 0:
                segments += 1
        raise RuntimeError("no seed separates the keys")

    @staticmethod
    def _peel(at: np.ndarray, slots: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Rounds of (keys, the slot that only this key had); None if some keys stay."""
        n = at.shape[1]
        count = np.bincount(at.ravel(), minlength=slots)
        mixed = np.zeros(slots, np.int64)
        for row in at:
            np.bitwise_xor.at(mixed, row, np.arange(n))
        alone, rounds, left = np.nonzero(count == 1)[0], [], n
        while len(alone):
            keys, first = np.unique(mixed[alone], return_index=True)
            rounds.append((keys, alone[first]))
            left -= len(keys)
            touched = at[:, keys]
            np.subtract.at(count, touched.ravel(), 1)
            for row in touched:
                np.bitwise_xor.at(mixed, row, keys)
            touched = np.unique(touched)
            alone = touched[count[touched] == 1]
        return None if left else rounds

    @staticmethod
    def _fill(at: np.ndarray, prints: np.ndarray, rounds: list, slots: int) -> np.ndarray:
        table = np.zeros(slots, np.uint8)
        for keys, own in reversed(rounds):
            table[own] = 0  # so that the slot of the key itself adds nothing
            table[own] = prints[keys] ^ table[at[0, keys]] ^ table[at[1, keys]] ^ table[at[2, keys]]
        return table

    def knows(self, keys: np.ndarray) -> np.ndarray:
        h = _mix(np.asarray(keys, np.uint64), self.seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        at = _places(h, self.segment, self.span)
        return (self.table[at[0]] ^ self.table[at[1]] ^ self.table[at[2]]) == _prints(h)


def _key64(digests: pd.Series) -> np.ndarray:
    """The first eight bytes of the digests."""
    return np.frombuffer(b"".join(bytes(d)[:8].ljust(8, b"\0") for d in digests), "<u8").astype(np.uint64)


def _build_filter(rows: pd.DataFrame) -> pd.DataFrame:
    f = BinaryFuseFilter.build(_key64(rows["digest"]))
    return pd.DataFrame({"bucket": rows["bucket"].iloc[:1], "seed": f.seed, "segment": f.segment, "span": f.span, "table": [f.table.tobytes()]})


def _screen(rows: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    if len(filters):
        r = filters.iloc[0]
        known = BinaryFuseFilter(int(r["seed"]), int(r["segment"]), int(r["span"]), np.frombuffer(r["table"], np.uint8)).knows(_key64(rows["digest"]))
    else:
        known = np.zeros(len(rows), bool)
    return rows.drop(columns="bucket").assign(maybe=known)


def filters_of(digests: DataFrame, buckets: int) -> DataFrame:
    """One filter for each bucket of different digests."""
    return digests.select(_bucket(buckets), "digest").groupBy("bucket").applyInPandas(_build_filter, FILTER)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("bucket")


def screen(batch: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """The groups of a new batch (digest, n, last_id, last_row), with `maybe`: the snapshot may
    hold the digest."""
    kind = "digest binary, n bigint, last_id bigint, last_row bigint, maybe boolean"
    rows = batch.select(_bucket(buckets), "digest", "n", "last_id", "last_row")
    return rows.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(_screen, kind)


def _groups(rows: DataFrame) -> DataFrame:
    """Digest groups: size, and the row with the largest id, of equal ids the last one."""
    found = rows.groupBy("digest").agg(F.count("*").alias("n"), F.max(F.struct("doc_id", "row")).alias("last"))
    return found.select("digest", "n", F.col("last.doc_id").alias("last_id"), F.col("last.row").alias("last_row"))


def _later(a: str, b: str, field: str) -> Column:
    """A field of the later of the rows of two sides, either of which may be missing."""

    def last(side: str) -> Column:
        row = F.struct(F.col(f"{side}.last_id").alias("doc_id"), F.col(f"{side}.last_row").alias("row"))
        return F.when(F.col(f"{side}.n").isNotNull(), row)

    return F.greatest(last(a), last(b))[field]


def duplicates(
    docs: DataFrame,
    in_batch: Column,
    digest: Callable[[Column], Column] = sha256_digest,
    filter_keys: int = FILTER_KEYS,
) -> DataFrame:
    """For every row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    `in_batch` tells the rows of the new batch from those of the snapshot.  Texts are equal when
    all their bytes are; null counts as empty.  Of equal texts the row with the largest doc_id
    stays; null ids come before all others, and of rows with equal ids one stays.  Other columns
    are not read.  An empty table, snapshot or batch is no special case.
    """
    text = text_of()
    rows = docs.select(
        whole_number().alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        digest(text).alias("digest"),
        F.sha2(text, 256).alias("text_sha256") if digest is not sha256_digest else F.lit(None).cast("string").alias("text_sha256"),
        F.coalesce(in_batch, F.lit(False)).alias("in_batch"),
    )
    rows = materialise(rows, "digests")
    snapshot = materialise(_groups(rows.where(~F.col("in_batch"))), "snapshot")
    # No bucket of either side grows with the table, however the rows are dealt.
    buckets = max(1, -(-max(snapshot.count(), rows.where("in_batch").count()) // filter_keys))
    batch = _groups(rows.where("in_batch"))
    screened = materialise(screen(batch, filters_of(snapshot, buckets), buckets), "screened")

    s, b = snapshot.alias("s"), screened.where("maybe").alias("b")
    met = s.join(b, F.col("s.digest") == F.col("b.digest"), "full_outer").select(
        F.coalesce("s.digest", "b.digest").alias("digest"),
        (F.coalesce("s.n", F.lit(0)) + F.coalesce("b.n", F.lit(0))).alias("n"),
        _later("s", "b", "doc_id").alias("last_id"),
        _later("s", "b", "row").alias("last_row"),
    )
    groups = materialise(met.unionByName(screened.where("not maybe").drop("maybe")), "groups")

    # Byte check: the different texts of each repeated digest.
    repeated = sized(materialise(groups.where("n > 1").select("digest"), "repeated"))
    texts = docs.select(whole_number().alias("doc_id"), digest(text).alias("digest"), text.alias("text")).join(repeated, "digest", "left_semi")
    several = texts.groupBy("digest", "text").agg(F.lit(1)).groupBy("digest").count().where("count > 1").select("digest")
    several = materialise(several, "collisions")

    sure = rows if several.isEmpty() else rows.join(several, "digest", "left_anti")
    out = sure.join(groups, "digest").select(
        "doc_id",
        F.col("last_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("last_row")).alias("kept"),
        F.coalesce("text_sha256", F.lower(F.hex("digest"))).alias("text_sha256"),
    )
    if several.isEmpty():
        return out
    # Texts of equal digests that differ: these rows are grouped by the texts themselves.
    mixed = materialise(texts.join(several, "digest", "left_semi").select("doc_id", "text", F.monotonically_increasing_id().alias("row")), "mixed")
    by_text = mixed.groupBy("text").agg(F.count("*").alias("n"), F.max(F.struct("doc_id", "row")).alias("last"))
    apart = mixed.join(by_text, "text").select(
        "doc_id",
        F.col("last.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("last.row")).alias("kept"),
        F.sha2("text", 256).alias("text_sha256"),
    )
    return out.unionByName(apart)


def first_half() -> Column:
    """Deals rows by their ids: which ones are taken for the snapshot, and which for the batch."""
    return F.pmod(F.xxhash64(whole_number()), F.lit(2)) == 1


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all columns; of rows equal in id and text, one."""
    found = duplicates(docs, first_half())
    return one_of_each(docs, found.select(F.struct("doc_id", "text_sha256").alias("_key"), "kept"))


def one_of_each(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """The rows of `docs` without those that `judged` (_key, kept) drops; its keys are structs of
    doc_id and text_sha256.  A key stays if one of its rows is kept, and then with one row."""
    key, name = F.struct(whole_number().alias("doc_id"), text_digest().alias("text_sha256")), fresh_name("key")
    found = judged.withColumnRenamed("_key", name).groupBy(name).agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    found = materialise(found.where("not kept or n > 1"), "dropped")
    left = docs.join(sized(materialise(found.where("not kept").select(name), "gone")), key == F.col(name), "left_anti")
    repeats = materialise(found.where("kept").select(name), "repeats")
    if repeats.isEmpty():
        return left
    single = left.join(sized(repeats), key == F.col(name), "left_anti")
    one = left.join(sized(repeats), key == F.col(name), "left_semi").withColumn(name, key).dropDuplicates([name]).drop(name)
    return single.unionByName(one)


def one_of_each_part(docs: DataFrame, plain: DataFrame, found: DataFrame) -> DataFrame:
    """Of each component one row of `docs`, all columns: that of the smallest id, null ids last,
    of equal ids the one with the smallest digest.  `plain` has (doc_id, text_sha256, node) of
    every row, `found` (node, component) of the nodes that have links."""
    several = plain.groupBy("node").count().where("count > 1").select("node")
    involved = several.unionByName(found.select("node")).distinct().join(found, "node", "left")
    involved = materialise(involved.select("node", F.coalesce("component", "node").alias("part")), "involved")
    placed = plain.join(sized(involved), "node")
    placed = materialise(placed.select("part", F.struct("doc_id", "text_sha256").alias("_key")), "placed")
    order = F.struct(F.col("_key.doc_id").isNull(), F.col("_key"))
    first = placed.groupBy("part").agg(F.min(order)["_key"].alias("first"))
    judged = placed.join(materialise(first, "first"), "part").select("_key", F.col("_key").eqNullSafe(F.col("first")).alias("kept"))
    return one_of_each(docs, judged)
