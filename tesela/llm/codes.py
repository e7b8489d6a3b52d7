"""Vector codes: each part of a vector becomes the number of its nearest codebook entry.

Distances come from a trie over the different parts, in the order of their components.  A node
of the trie is a common beginning of parts and holds the squared distances of this beginning to
the beginnings of all entries; its children add one component each, so parts with a common
beginning share that sum.  The trie is walked depth first, a run of LEAVES neighbouring leaves
with all their ancestors at a time, so no more than the nodes of one run are held.  A leaf takes
its nearest entry and adds its components, times the number of vectors with that part, to it.

The entries are fitted to all vectors: different parts are counted by one grouping and sorted into
ranges, each round sums within the tasks, and what reaches the driver is one sum for each entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesela.operators.quantiles import ranges_for

from .common import materialise, whole_number

PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Components are multiplied by this and rounded down to whole numbers.
STEPS = 1024
#: Whole components are cut to this size, so that no distance or sum leaves 64 bits.
LARGEST = 1 << 24
LEAVES = 1024

SUMS = "part int, entry int, n bigint, sums array<bigint>"


def whole_vectors(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label", parts: int = PARTS) -> DataFrame:
    """vec_id, label, x (whole numbers) and length of the rows with a complete finite vector.  Zeros are
    added where the length is no multiple of `parts`; they change no distance."""
    x = F.col(f"`{vector}`")
    largest = F.lit(float(LARGEST))
    scaled = F.transform(x, lambda c: F.greatest(F.least(F.floor(c.cast("double") * STEPS).cast("double"), largest), -largest).cast("int"))
    more = F.pmod(-F.size(x), F.lit(parts))
    complete = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return rows.where(x.isNotNull()).where(complete).select(
        whole_number(key).alias("vec_id"),
        F.col(f"`{label}`").alias("label"),
        F.concat(scaled, F.array_repeat(F.lit(0), more)).alias("x"),
        F.size(x).alias("length"),
    )


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def in_order(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different rows in lexicographic order, where each begins in the sorted rows, and the
    order that sorts them."""
    order = np.lexsort(parts.T[::-1]) if parts.shape[1] else np.arange(len(parts))
    found = parts[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]).any(axis=1)
    begins = np.flatnonzero(new)
    return found[begins], begins, order


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (ties: the first) and squared distance of each row of `parts`, which are
    different and in lexicographic order."""
    width, largest = parts.shape[1], max((np.abs(a).max() for a in (parts, entries) if a.size), default=0)
    kind = np.int32 if width * (2 * int(largest)) ** 2 < 1 << 31 else np.int64
    parts, entries = parts.astype(kind), np.ascontiguousarray(entries.T.astype(kind))
    # How many leading components a row shares with the row before.
    unlike = parts[1:] != parts[:-1]
    shared = np.zeros(len(parts), np.int64)
    if width:
        shared[1:] = np.where(unlike.any(axis=1), unlike.argmax(axis=1), width)
    entry, distance = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
    for at in range(0, len(parts), LEAVES):
        run, common = parts[at : at + LEAVES], shared[at : at + LEAVES].copy()
        common[0] = 0
        sums, above = np.zeros((1, entries.shape[1]), kind), np.zeros(len(run), np.int64)
        for depth in range(width):
            heads = np.flatnonzero(common <= depth)  # the first leaf below each node of this depth
            step = run[heads, depth, None] - entries[depth]
            step *= step
            if len(heads) == len(sums):
                sums += step
            else:
                sums = step + sums[above[heads]]
            above = np.cumsum(common <= depth) - 1
        best = sums[above].argmin(axis=1) if width else np.zeros(len(run), np.int64)
        entry[at : at + LEAVES] = best
        distance[at : at + LEAVES] = sums[above, best]
    return entry, distance


def _fit(books: list[np.ndarray], width: int):
    """Components and counts of the parts that each entry is nearest to, summed in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            at, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            x = matrix(batch.column(1), width)
            for p, book in enumerate(books):
                mine = np.flatnonzero(at == p)
                if not len(mine):
                    continue
                leaves, begins, order = in_order(x[mine])
                weight = np.add.reduceat(n[mine][order], begins)
                entry, _ = nearest(leaves, book)
                by = np.argsort(entry, kind="stable")
                used, first = np.unique(entry[by], return_index=True)
                counts[p][used] += np.add.reduceat(weight[by], first)
                sums[p][used] += np.add.reduceat(leaves[by] * weight[by][:, None], first, axis=0)
        rows = [(p, e) for p, c in enumerate(counts) for e in np.flatnonzero(c)]
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([p for p, _ in rows], pa.int32()),
                "entry": pa.array([int(e) for _, e in rows], pa.int32()),
                "n": pa.array([int(counts[p][e]) for p, e in rows], pa.int64()),
                "sums": pa.array([sums[p][e].tolist() for p, e in rows], pa.list_(pa.int64())),
            }
        )

    return run


def _assign(books: list[np.ndarray], width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(2), width * len(books))
            codes, error = np.empty((len(x), len(books)), np.uint8), np.zeros(len(x), np.int64)
            for p, book in enumerate(books):
                leaves, begins, order = in_order(x[:, p * width : (p + 1) * width])
                if not len(leaves):
                    continue
                leaf = np.empty(len(x), np.int64)
                leaf[order] = np.repeat(np.arange(len(leaves)), np.diff(begins, append=len(x)))
                entry, distance = nearest(leaves, book)
                codes[:, p] = entry[leaf]
                error += distance[leaf]
            code = [row.tobytes().hex() for row in codes]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"]
            )

    return run


def first_entries(vectors: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES) -> list[np.ndarray]:
    """The parts of the vectors with the smallest ids, one array for each part."""
    rows = vectors.orderBy(F.asc_nulls_last("vec_id"), "x").select("x").limit(entries).collect()
    x = np.array([r[0] for r in rows], np.int64).reshape(len(rows), parts * width)
    return [x[:, p * width : (p + 1) * width] for p in range(parts)]


def fit(vectors: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks after so many rounds over all `vectors` (a written table)."""
    books = first_entries(vectors, width, parts, entries)
    cut = vectors.select(F.posexplode(F.array(*(F.slice("x", p * width + 1, width) for p in range(parts)))).alias("part", "x"))
    different = materialise(cut.groupBy("part", "x").agg(F.count("*").alias("n")), "parts")
    ranged = different.repartitionByRange(ranges_for(different.count()), "part", "x").sortWithinPartitions("part", "x")
    ranged = materialise(ranged, "sorted-parts")
    for _ in range(rounds):
        summed = ranged.mapInArrow(_fit(books, width), SUMS).groupBy("part", "entry")
        columns = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)]
        books = [b.copy() for b in books]
        for row in summed.agg(F.sum("n").alias("n"), *columns).collect():  # one row for each entry in use
            books[row["part"]][row["entry"]] = np.array(row[3:], np.int64) // row["n"]
    return books


def digest(books: list[np.ndarray]) -> str:
    numbers = ",".join(str(v) for book in books for entry in book.tolist() for v in entry)
    return hashlib.sha256(numbers.encode()).hexdigest()


def encode(
    rows: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    vector: str = "embedding",
    key: str = "vec_id",
    label: str = "label",
) -> DataFrame:
    """vec_id, label, code, error, label_error and codebooks_sha256 of each complete vector.

    Rows without a vector, or with components that are null, infinite or no numbers, are left
    out, and so are vectors whose length is not that of the vector with the smallest id.  Null
    ids come last and count otherwise; repeated rows are rows of their own.  Null labels form
    one group.  Whole components beyond 2^24 count as 2^24.  With fewer vectors than entries the
    codebooks are as short; without vectors there are no rows.  Other columns are not read.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits a part: 1 to 256 entries")
    vectors = materialise(whole_vectors(rows, vector, key, label, parts), "vectors")
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "x").select("length", F.size("x")).first()
    length, padded = first or (0, 0)
    vectors, width = vectors.where(F.col("length") == length).drop("length"), padded // parts
    books = fit(vectors, width, parts, entries, rounds)
    kind = vectors.schema["label"].dataType
    schema = f"vec_id bigint, label {kind.simpleString()}, code string, error bigint"
    coded = materialise(vectors.mapInArrow(_assign(books, width), schema), "codes")
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "label", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
