"""Near duplicates by shared word shingles: an exact Jaccard coefficient of min-hash candidates.

A text is the set of its runs of five words, each hashed to 64 bits.  150 min-hashes of a set are
cut into 30 bands of five; sets that agree in a band are candidates.  A pair with a coefficient
of 0.8 agrees in one at least with a probability of 1 - (1 - 0.8^5)^30 = 0.999993, closer pairs
more surely.  One bit of each min-hash leaves out the pairs that are far apart (over 40 of 150
bits differ, where a pair of 0.8 has 15 on average); all others are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import giving_back, materialise, sized, text_digest, text_of, whole_number
from .components import components
from .exact_dedup import one_of_each_part
from .simhash import BROADCAST_KEYS, shingle_hashes

WIDTH, LEAST = 5, 0.8
BANDS, ROWS = 30, 5
#: Bits of the sketches in which candidates may differ.
APART = 40
SKETCH = ("s0", "s1", "s2")

SETS = "doc_id bigint, text_sha256 string, node bigint, keys array<bigint>, s0 bigint, s1 bigint, s2 bigint"


def shingles(text: bytes, width: int = WIDTH) -> np.ndarray:
    """The different hashes of the runs of `width` words, in order."""
    return np.unique(shingle_hashes(text, width))


def _constants() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return tuple(rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)[:, None] | np.uint32(odd) for odd in (0, 1))


def min_hashes(hashes: np.ndarray) -> np.ndarray:
    """The least value of each of the permutations; of an empty set the largest number."""
    mask, factor = _CONSTANTS
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(hashes), 4096):
        x = ((hashes[at : at + 4096] >> np.uint64(32)).astype(np.uint32)[None, :] ^ mask) * factor
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        x ^= x >> np.uint32(13)
        np.minimum(least, x.min(axis=1), out=least)
    return least


_CONSTANTS = _constants()


def band_keys(least: np.ndarray) -> np.ndarray:
    """The key of each band, for the min-hashes of many sets."""
    bands = least.reshape(len(least), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bands.shape[:2]).copy()
    for k in range(ROWS):
        key = (key ^ bands[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _sketches(least: np.ndarray) -> np.ndarray:
    bits = np.zeros((len(least), 64 * len(SKETCH)), np.uint8)
    bits[:, : least.shape[1]] = (least ^ least >> np.uint32(7)) & np.uint32(1)
    return np.packbits(bits, axis=1).view(np.int64)


def _cut(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                least = np.empty((part.num_rows, BANDS * ROWS), np.uint32)
                nodes = np.empty(part.num_rows, np.uint64)
                for i, text in enumerate(part.column(2)):
                    hashes = shingles(text.as_py().encode(), width)
                    nodes[i], least[i] = xxhash.xxh3_64_intdigest(hashes.tobytes()), min_hashes(hashes)
                keys = band_keys(least)
                keys = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)), pa.array(keys.ravel()))
                sketch = [pa.array(np.ascontiguousarray(s)) for s in _sketches(least).T]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(nodes.view(np.int64)), keys, *sketch], names=["doc_id", "text_sha256", "node", "keys", *SKETCH]
                )

    return run


def _sets(width: int):
    """(node, shingles) of (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                found = [shingles(t.as_py().encode(), width) for t in part.column(1)]
                ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
                flat = np.concatenate(found).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["node", "shingles"])

    return run


def _similar(a: str, b: str, least: float):
    """Whether two sets, as arrays without repeats, reach the coefficient."""
    both = F.size(F.array_intersect(a, b))
    return both >= F.lit(least) * (F.size(a) + F.size(b) - both) - F.lit(1e-9)


def _differing(a: str, b: str):
    return sum((F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in SKETCH), F.lit(0))


def _sets_of(docs: DataFrame, sets: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of some nodes; `sets` has the digest of one text of each."""
    of_set = sets.groupBy("node").agg(F.min("text_sha256").alias("text_sha256"))
    wanted = materialise(of_set.join(materialise(nodes, "pair-nodes"), "node"), "wanted")
    texts = docs.select(text_digest().alias("text_sha256"), text_of().alias("text")).join(sized(wanted), "text_sha256")
    texts = texts.dropDuplicates(["node"]).select("node", "text")
    return materialise(texts.mapInArrow(giving_back(_sets(width)), "node bigint, shingles array<bigint>"), "pair-sets")


def _reaching(pairs: DataFrame, cut: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of sets that reach the coefficient.  The sets are compared row by row
    where the joins bring them together."""
    met = pairs.join(cut.toDF("a", "set_a"), "a").join(cut.toDF("b", "set_b"), "b").where(_similar("set_a", "set_b", least))
    return materialise(met.select("a", "b"), "confirmed")


def _confirmed(docs: DataFrame, sets: DataFrame, pairs: DataFrame, width: int, least: float) -> DataFrame:
    """The pairs (a, b) of nodes whose sets reach the coefficient."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return _reaching(pairs, _sets_of(docs, sets, nodes, width), least)


def _prefix_pairs(cut: DataFrame, part_of: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b), a the smaller, of all sets (node, shingles) of different parts that may reach
    the coefficient c: none that does is left out.

    Sets have the shingles that few sets hold first.  Of a pair with c or more the larger set, of
    n, has c * n in common with the smaller one, and that of m at least 2c / (1 + c) * m with the
    larger one; so the first that they have in common stands before the last so many of each, and
    what follows it in either set makes up the c / (1 + c) * (n + m) that they need in common.
    """
    tokens = materialise(cut.select("node", F.size("shingles").alias("size"), F.explode("shingles").alias("token")), "tokens")
    held = materialise(tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1"), "held")
    # Shingles that no other set holds come first and meet nothing: their number is enough.
    known = tokens.join(held, "token")
    shared = materialise(known.groupBy("node").agg(F.count("*").alias("known")), "known")
    # No set has more in common with others than its shared ones.
    able = shared.join(tokens.select("node", "size").distinct(), "node").where(F.col("known") >= F.lit(least) * F.col("size") - F.lit(1e-9))
    places = F.row_number().over(Window.partitionBy("node").orderBy("n", "token")) - 1 + F.col("size") - F.col("known")
    placed = known.join(able.select("node", "known"), "node").withColumn("left", F.col("size") - places)
    placed = placed.where(F.col("left") >= F.lit(least) * F.col("size") - F.lit(1e-9)).select("token", "node", "size", "left")
    placed = materialise(placed.join(part_of, "node"), "prefixes")
    of_both = 2 * least / (1 + least)
    x, y = placed.alias("x"), placed.where(F.col("left") >= F.lit(of_both) * F.col("size") - F.lit(1e-9)).alias("y")
    enough = F.least("x.left", "y.left") >= F.lit(of_both / 2) * (F.col("x.size") + F.col("y.size")) - F.lit(1e-9)
    larger = F.struct("x.size", "x.node") > F.struct("y.size", "y.node")
    met = x.join(y, (F.col("x.token") == F.col("y.token")) & larger & (F.col("x.part") != F.col("y.part")) & enough)
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _ordered(pairs: DataFrame) -> DataFrame:
    """Different pairs (a, b), a the smaller, of (node, hub)."""
    return pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _hub_links(docs: DataFrame, sets: DataFrame, pairs: DataFrame, sketches: DataFrame, width: int, least: float) -> tuple[DataFrame, DataFrame]:
    """The pairs, and those of them that reach the coefficient."""
    x, y = sketches.alias("x"), sketches.alias("y")
    near = pairs.join(x, F.col("a") == F.col("x.node")).join(y, F.col("b") == F.col("y.node")).where(_differing("x", "y") <= APART)
    return pairs, _confirmed(docs, sets, materialise(near.select("a", "b"), "near-hubs"), width, least)


def links_of(docs: DataFrame, sets: DataFrame, width: int = WIDTH, least: float = LEAST) -> DataFrame:
    """Links (a, b) that connect all candidates among `sets` whose coefficient is `least` or more.

    As for fingerprints the members of a bucket are first compared with two of them; only
    members that this leaves in different components are then compared with each other, and of
    them only those whose rare shingles allow for the coefficient.
    """
    one = sets.dropDuplicates(["node"]).select("node", "keys", *SKETCH)
    keys = materialise(one, "different-sets").select("node", *SKETCH, F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high")
    members = materialise(keys.join(sized(materialise(shared, "shared-keys"), BROADCAST_KEYS), "key"), "members")
    sketches = materialise(members.select("node", *SKETCH).distinct(), "sketches")

    # Each member is first compared with one text, the end of most of its buckets; the ends of the
    # buckets that this leaves open follow.
    ends = members.select("key", "node", F.explode(F.array("low", "high")).alias("hub")).where("node != hub")
    counted = ends.groupBy("node", "hub").agg(F.count("*").alias("n"))
    best = counted.groupBy("node").agg(F.max_by("hub", F.struct("n", "hub")).alias("hub"))
    first, linked = _hub_links(docs, sets, materialise(_ordered(best), "first-pairs"), sketches, width, least)
    parts = materialise(components(linked), "first-components")
    part_of = lambda c: parts.toDF(f"_{c}", f"_part_{c}")
    left = ends.join(part_of("node"), F.col("node") == F.col("_node"), "left").join(part_of("hub"), F.col("hub") == F.col("_hub"), "left")
    left = left.where(F.coalesce("_part_node", "node") != F.coalesce("_part_hub", "hub"))
    rest = _ordered(left).join(first, ["a", "b"], "left_anti")
    rest, more = _hub_links(docs, sets, materialise(rest, "hub-pairs"), sketches, width, least)
    hubs, to_hub = first.unionByName(rest), linked.unionByName(more)

    found = materialise(components(to_hub), "hub-components").withColumnRenamed("node", "_node")
    placed = members.join(found, F.col("node") == F.col("_node"), "left").select("key", "node", F.coalesce("component", "node").alias("part"))
    placed = materialise(placed, "placed")
    mixed = placed.groupBy("key").agg(F.min("part").alias("_low"), F.max("part").alias("_high")).where("_low != _high").select("key")
    open_ = materialise(placed.join(mixed, "key", "left_semi").select("node", "part").distinct(), "open")
    cut = _sets_of(docs, sets, open_.select("node"), width)
    across = _prefix_pairs(cut, open_, least).join(hubs, ["a", "b"], "left_anti")
    return to_hub.unionByName(_reaching(materialise(across, "across"), cut, least))


def keep_one(docs: DataFrame, width: int = WIDTH, least: float = LEAST) -> DataFrame:
    """Of each group of similar texts one row of `docs`, all columns: that of the smallest id,
    null ids last, of equal ids the one with the smallest digest.

    Rows are similar if the sets of their runs of `width` words (of shorter texts, the text) have
    a Jaccard coefficient of `least` or more, and so in chains; the bands are made for 0.8 and
    more.  Words are compared without ASCII case.  Null, empty and blank texts are equal.
    """
    if least < LEAST:
        raise ValueError("the bands find coefficients of 0.8 and more")
    source = docs.select(whole_number().alias("doc_id"), text_digest().alias("text_sha256"), text_of())
    rows = materialise(source.mapInArrow(giving_back(_cut(width)), SETS), "shingle-sets")
    found = materialise(components(links_of(docs, rows, width, least)), "components")
    return one_of_each_part(docs, rows.select("doc_id", "text_sha256", "node"), found)
