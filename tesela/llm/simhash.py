"""Near duplicates by SimHash fingerprints and Golay-code fuzzy hashing.

A fingerprint is cut into three segments of 22, 21 and 21 bits, padded to the 23 bits of the
perfect Golay code.  A segment gives the indices of all codewords within four bits, five or six
of them; two segments that differ in up to two bits have a codeword in common, since the
nearest codeword of the word halfway is within four bits of both.

Of fingerprints that differ in up to four bits,
* either one segment agrees and another differs in up to two bits: the key is the one exactly
  and a codeword of the other;
* or all segments differ, two of them in one bit each, the third in up to two: the key is the
  agreeing half of each of the two, and a codeword of the third.
So every such pair shares a key, and pairs that share one by chance are rare: 32 and more bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_name, giving_back, materialise, sized, text_digest, text_of, whole_number
from .components import components
from .exact_dedup import one_of_each_part

#: The generator polynomial of the cyclic (23, 12) Golay code.
GENERATOR = 0b110001110101
#: Start and width of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Up to so many shared keys (24 bytes each) are broadcast to find their members.
BROADCAST_KEYS = 2_000_000
SEED = 42


def shingle_hashes(text: bytes, width: int = 4) -> np.ndarray:
    """XXH64 of each run of `width` words of the lower-cased text; fewer words are one run."""
    import xxhash

    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    digest = xxhash.xxh64_intdigest
    spans = zip((ends - lengths)[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(words) - width + 1)


def fingerprint(text: bytes, width: int = 4) -> int:
    """64 bits, each set if it is set in over half the hashes; zero without words."""
    hashes = shingle_hashes(text, width)
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for part in np.array_split(hashes, -(-len(hashes) // 65_536)):
        counts += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def _printed(width: int):
    """The columns before the last, which is the text, and its fingerprint in its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py().encode(), width) for t in batch.columns[-1]], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found.view(np.int64))], names=[*batch.schema.names[:-1], "print"])

    return run


def fingerprints(docs: DataFrame, width: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, print) for every row of `docs`; print is the fingerprint as a signed number."""
    return docs.select(whole_number(key).alias("doc_id"), text_of(text)).mapInArrow(_printed(width), "doc_id bigint, print bigint")


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """The remainders of the upper twelve bits, and for each of the 2,048 remainders the error
    patterns of up to four bits that leave it, filled up with -1."""
    rest = np.zeros(4096, np.int64)
    for bit in range(12):
        word = 1 << (11 + bit)
        for at in range(22, 10, -1):
            if word >> at & 1:
                word ^= GENERATOR << (at - 11)
        step = 1 << bit
        rest[step : 2 * step] = rest[:step] ^ word
    errors: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        for bits in combinations(range(23), weight):
            e = sum(1 << b for b in bits)
            errors[rest[e >> 11] ^ (e & 2047)].append(e)
    most = max(map(len, errors))
    return rest, np.array([e + [-1] * (most - len(e)) for e in errors], np.int64)


GOLAY = golay_tables()


def codewords(words: np.ndarray) -> np.ndarray:
    """For each 23-bit word the indices of the codewords within four bits, filled up with -1."""
    rest, errors = GOLAY
    e = errors[rest[words >> 11] ^ (words & 2047)]
    return np.where(e < 0, -1, (words[:, None] ^ e) >> 11)


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of the fingerprints: (the number of the fingerprint, the key)."""
    prints = prints.view(np.uint64)
    parts = [((prints >> np.uint64(a)) & np.uint64((1 << w) - 1)).astype(np.int64) for a, w in SEGMENTS]
    near = [codewords(p) for p in parts]
    halves = [(p & 0x3FF, p >> 10) for p in parts]
    exact = [(g, parts[j]) for g in range(3) for j in range(3) if j != g]
    for g in range(3):
        i, j = (x for x in range(3) if x != g)
        exact += [(g, a << 12 | b) for a in halves[i] for b in halves[j]]
    owner, key = [], []
    for kind, (g, rest) in enumerate(exact):
        rows, cols = np.nonzero(near[g] >= 0)
        owner.append(rows)
        key.append(kind << 40 | rest[rows] << 12 | near[g][rows, cols])
    return np.concatenate(owner), np.concatenate(key)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            prints, n = (part.column(c).to_numpy() for c in ("print", "n"))
            owner, key = keys_of(prints)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(prints[owner]), pa.array(n[owner])], names=["key", "print", "n"])


def links_of(prints: DataFrame, most: int = 4) -> DataFrame:
    """Links (a, b) that connect all fingerprints `print` that differ in up to `most` bits.

    The links are enough for the connected components, and no more: in each bucket of a key the
    members are first compared with the most frequent one.  Only members that this leaves in
    different components are then compared with each other, so a large group of close copies is
    not paired off.  `prints` has different fingerprints and how many rows (n) have each.
    """
    if most > 4:
        raise ValueError("the keys find differences of up to four bits")
    # A print becomes a hundred rows: deal the prints over all partitions first.
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = prints.select("print", "n").repartition(parts, "print")
    keys = dealt.mapInArrow(_keys, "key bigint, print bigint, n bigint")
    shared = keys.groupBy("key").agg(F.min("print").alias("low"), F.max("print").alias("high"), F.max_by("print", "n").alias("hub"))
    shared = materialise(shared.where("low != high").select("key", "hub"), "shared-keys")
    if shared.count() <= BROADCAST_KEYS:
        shared = F.broadcast(shared)
    members = materialise(keys.join(shared, "key").select("key", "print", "hub"), "members")

    def close(a: str, b: str):
        return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= most

    to_hub = members.where("print != hub").where(close("print", "hub")).select(F.col("print").alias("a"), F.col("hub").alias("b"))
    to_hub = materialise(components(to_hub), "hub-components")
    placed = members.join(to_hub, F.col("print") == F.col("node"), "left").select("key", "print", F.coalesce("component", "print").alias("part"))
    placed = materialise(placed, "placed")
    mixed = placed.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low != high").select("key")
    open_ = materialise(placed.join(mixed, "key", "left_semi"), "open")
    x, y = open_.alias("x"), open_.alias("y")
    across = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.part") < F.col("y.part")) & close("x.print", "y.print"))
    across = across.select(F.col("x.part").alias("a"), F.col("y.part").alias("b"))
    return across.unionByName(to_hub.select(F.col("node").alias("a"), F.col("component").alias("b")))


def near_duplicates(docs: DataFrame, width: int = 4, most: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of `docs`.

    Rows whose fingerprints differ in up to `most` bits are linked; component_id is the smallest
    doc_id reachable.  Null and empty texts have fingerprint zero and are linked like others.
    Rows with null ids are kept and link others; a component of them alone has a null id.
    Repeated ids and texts give one row each.  Other columns are not read.
    """
    rows = materialise(fingerprints(docs, width, text, key), "fingerprints")
    prints = materialise(rows.groupBy("print").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")), "prints")
    found = materialise(components(links_of(prints, most)), "components")
    placed = prints.join(found, F.col("print") == F.col("node"), "left")
    placed = materialise(placed.select("print", "first_id", F.coalesce("component", "print").alias("part")), "placed")
    names = materialise(placed.groupBy("part").agg(F.min("first_id").alias("component_id")), "names")
    named = materialise(placed.join(names, "part").select("print", "component_id"), "named")
    out = rows.join(named, "print")
    return out.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, width: int = 4, most: int = 4) -> DataFrame:
    """The rows of `docs`, all columns, with the smallest id of their component.  Rows with null
    ids stay: there is no telling which of them is the first."""
    gone = fresh_name("gone")
    rest = near_duplicates(docs, width, most).where("doc_id != component_id").select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(sized(materialise(rest, "gone")), whole_number() == F.col(gone), "left_anti")


def keep_one(docs: DataFrame, width: int = 4, most: int = 4) -> DataFrame:
    """Of each component of fingerprints one row of `docs`, all columns: that of the smallest id,
    null ids last, of equal ids the one with the smallest digest."""
    source = docs.select(whole_number().alias("doc_id"), text_digest().alias("text_sha256"), text_of())
    rows = materialise(source.mapInArrow(giving_back(_printed(width)), "doc_id bigint, text_sha256 string, print bigint"), "fingerprints")
    prints = materialise(rows.groupBy("print").agg(F.count("*").alias("n")), "prints")
    found = materialise(components(links_of(prints, most)), "components")
    return one_of_each_part(docs, rows.withColumnRenamed("print", "node"), found)
