"""Ranked lexical search: best-first document intervals bounded by range-maximum tables.

The documents are cut into blocks.  A block holds, for every word asked for, its posting list in
document order, the impacts (parts of a score), a sparse table that gives the position of the
largest impact in any range of the list, and a bitmap with ranks that gives the place of a
document in the list.  The bound of an interval of documents is the sum of the range maxima of
the words of an item.  The intervals with the largest bounds are split at the document of their
largest impact, which is scored; the two remaining intervals get bounds of their own and are
dropped when these are below the worst of the best scores so far.

Every task searches its blocks for all items and keeps the best of each; their lists are merged
by a window.  No posting list crosses a block, so a word of all documents is in all tasks.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, text_of, whole_number

#: Documents in a block, and numbers in the arrays of one step of a search.
BLOCK, STEP = 4096, 1 << 18
#: Words of the items that one pass over the documents looks for, about; more make more passes.
ITEM_WORDS = 100_000

LAST = np.iinfo(np.int64).max  # stands for an id that is null, which comes after all others

FORWARD = "doc_id bigint, n bigint, terms array<int>, tfs array<int>"
FOUND = "item int, doc_id bigint, score bigint"


def _table() -> bytes:
    """Bytes of words stay, A-Z as a-z; all others become blanks."""
    kept = {b: b for b in range(256) if b >= 0x80 or chr(b).isalnum()}
    kept |= {b: b + 32 for b in range(0x41, 0x5B)}
    return bytes(kept.get(b, 0x20) for b in range(256))


TABLE = _table()


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def _texts(column: pa.Array) -> Iterator[bytes]:
    for value in column:
        yield value.as_py()


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    flat = np.concatenate(values) if values else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))


def _forward(vocabulary: dict[bytes, int]):
    """Number of terms of each text, and the counts of the terms asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                n, terms, tfs = [], [], []
                for text in _texts(part.column(1)):
                    counts = Counter(terms_of(text))
                    met = [(vocabulary[w], c) for w, c in counts.items() if w in vocabulary]
                    pairs = np.array(met, np.int32).reshape(-1, 2)
                    n.append(counts.total())
                    terms.append(pairs[:, 0])
                    tfs.append(pairs[:, 1])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), _lists(terms), _lists(tfs)], names=["doc_id", "n", "terms", "tfs"])

    return run


def _document_counts(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            counts += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        known = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(known.astype(np.int32)), pa.array(counts[known])], names=["term", "df"])

    return run


class Block:
    """The posting lists of some documents, positions counted over all lists together."""

    def __init__(self, ids, n, terms, tfs, sizes, weights, documents, length):
        self.count = len(ids)
        # Documents that share their most frequent term and a like length are neighbours, so
        # that intervals are alike and their bounds tight.
        first = np.zeros(self.count, np.int64)
        owner = np.repeat(np.arange(self.count), sizes)
        by_tf = np.lexsort((terms, tfs))
        first[owner[by_tf]] = terms[by_tf]
        order = np.lexsort((n, first))
        place = np.empty(self.count, np.int64)
        place[order] = np.arange(self.count)
        self.ids = ids[order]

        doc = place[owner]
        self.words = -(-self.count // 64) or 1
        listed = np.argsort(terms.astype(np.int64) * self.count + doc, kind="stable")
        terms, tfs, doc = terms[listed], tfs[listed].astype(np.int64), doc[listed]
        m = 100 - 75 + 75 * n[order] * documents // max(length, 1)
        self.doc = doc.astype(np.int32)
        self.impact = weights[terms] * (1_000_000_000 * tfs // (1000 * tfs + 8 * m[doc]))
        self.terms, starts = np.unique(terms, return_index=True)
        ends = np.append(starts, len(terms))[1:]

        row = np.repeat(np.arange(len(self.terms)), ends - starts)
        slot = row * self.words + (doc >> 6)
        counts = np.bincount(slot, minlength=len(self.terms) * self.words)
        self.before = (np.cumsum(counts) - counts).astype(np.int32)
        self.bits = np.zeros(len(counts), np.uint64)
        if len(slot):
            begins = np.flatnonzero(np.diff(slot, prepend=-1))
            self.bits[slot[begins]] = np.add.reduceat(np.uint64(1) << (doc & 63).astype(np.uint64), begins)

        # peak[k][i]: where the largest impact of the list is within the 2^k positions from i.
        peak = [np.arange(len(terms), dtype=np.int32)]
        left = np.repeat(ends, ends - starts) - peak[0]  # positions from here to the end of the list
        while (wide := np.flatnonzero(left >= 2 << (len(peak) - 1))).size:
            half, level = 1 << (len(peak) - 1), peak[-1].copy()
            a, b = peak[-1][wide], peak[-1][wide + half]
            level[wide] = np.where(self.impact[a] >= self.impact[b], a, b)
            peak.append(level)
        self.peak = np.array(peak)
        self.log = np.frexp(np.arange(1, self.count + 2))[1].astype(np.int8) - 1  # log2 of i + 1

    def place(self, row: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For lists (columns) and documents (rows): the position of the first posting that is
        not before the document, and whether it is the document's."""
        slot = row * self.words + (doc >> 6)[:, None]
        shift = (doc & 63).astype(np.uint64)[:, None]
        bits = self.bits[slot]
        below = np.bitwise_count(bits & ((np.uint64(1) << shift) - np.uint64(1)))
        return self.before[slot] + below, (bits >> shift & np.uint64(1)).astype(bool)

    def best(self, a: np.ndarray, b: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bound of each interval, and the document of its largest part."""
        some, size = b > a, np.maximum(b - a, 1)
        level = self.log[size - 1]
        a = np.minimum(a, len(self.doc) - 1)
        x, y = self.peak[level, a], self.peak[level, np.maximum(b - (1 << level.astype(np.int32)), a)]
        at = np.where(self.impact[x] >= self.impact[y], x, y)
        parts = np.where(some, self.impact[at] * q, 0)
        widest = parts.argmax(axis=1)
        return parts.sum(axis=1), self.doc[at[np.arange(len(at)), widest]]

    def search(self, terms: np.ndarray, q: np.ndarray, top: Top) -> None:
        """Offer to `top` all documents that can be among the best of one item."""
        row = np.searchsorted(self.terms, terms)
        row[row == len(self.terms)] = 0
        known = self.terms[row] == terms if len(self.terms) else np.zeros(len(terms), bool)
        row, q = row[known].astype(np.int64), q[known]
        if not len(row):
            return
        low, high = np.zeros(1, np.int64), np.full(1, self.count, np.int64)
        bound, split = self._bounds(row, q, low, high)
        most, wide = max(1, STEP // len(row)), 16
        while len(low):
            if len(low) > min(wide, most):
                take = np.argpartition(-bound, min(wide, most))[: min(wide, most)]
                rest = np.ones(len(low), bool)
                rest[take] = False
            else:
                take, rest = slice(None), np.zeros(len(low), bool)
            wide *= 2
            lo, hi, at = low[take], high[take], split[take].astype(np.int64)
            p, here = self.place(row, at)
            score = np.where(here, self.impact[np.minimum(p, len(self.doc) - 1)] * q, 0).sum(axis=1)
            top.offer(score, self.ids[at])
            a, b = self._ends(row, lo, hi)
            left, right = self.best(a, p, q), self.best(p + here, b, q)
            low = np.concatenate([low[rest], lo, at + 1])
            high = np.concatenate([high[rest], at, hi])
            bound = np.concatenate([bound[rest], left[0], right[0]])
            split = np.concatenate([split[rest], left[1], right[1]])
            open_ = bound >= top.least
            low, high, bound, split = low[open_], high[open_], bound[open_], split[open_]

    def _ends(self, row, low, high):
        a, _ = self.place(row, low)
        last, here = self.place(row, high - 1)
        return a, last + here

    def _bounds(self, row, q, low, high):
        a, b = self._ends(row, low, high)
        return self.best(a, b, q)


class Top:
    """The k best of the scored documents: larger scores first, equal ones by id."""

    def __init__(self, k: int):
        self.k, self.score, self.id = k, np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def least(self) -> int:
        """A document below this score cannot be among the best any more."""
        return max(1, int(self.score[-1])) if len(self.score) == self.k else 1

    def offer(self, score: np.ndarray, ids: np.ndarray) -> None:
        good = score >= self.least
        if good.any():
            score, ids = np.concatenate([self.score, score[good]]), np.concatenate([self.id, ids[good]])
            order = np.lexsort((ids, -score))[: self.k]
            self.score, self.id = score[order], ids[order]


def blocks(batches: Iterator[pa.RecordBatch], weights: np.ndarray, documents: int, length: int) -> Iterator[Block]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            ids = part.column(0).fill_null(int(LAST)).to_numpy(zero_copy_only=False)
            terms, tfs = (part.column(i).flatten().to_numpy(zero_copy_only=False) for i in (2, 3))
            sizes = np.diff(part.column(2).offsets.to_numpy())
            yield Block(ids, part.column(1).to_numpy(zero_copy_only=False), terms, tfs, sizes, weights, documents, length)


def _search(items: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, documents: int, length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = [Top(k) for _ in items]
        for block in blocks(batches, weights, documents, length):
            for (terms, q), top in zip(items, tops):
                block.search(terms, q, top)
        item = np.repeat(np.arange(len(tops), dtype=np.int32), [len(t.id) for t in tops])
        ids, scores = (np.concatenate([np.empty(0, np.int64), *x]) for x in ([t.id for t in tops], [t.score for t in tops]))
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(ids, mask=ids == LAST), pa.array(scores)], names=["item", "doc_id", "score"])

    return run


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _pass(spark: SparkSession, docs: DataFrame, items: list, item_type, k: int) -> DataFrame:
    """item_id, doc_id, score: the best of every task for the items of one pass."""
    asked = [Counter(terms_of(text)) for _, text in items]
    vocabulary = {w: i for i, w in enumerate(sorted(set().union(*asked)))}
    forward = materialise(docs.mapInArrow(_forward(vocabulary), FORWARD).where("n > 0"), "forward-index")
    documents, length = forward.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    counted = forward.select("terms").mapInArrow(_document_counts(len(vocabulary)), "term int, df bigint")
    weights = np.zeros(len(vocabulary), np.int64)
    for term, df in counted.groupBy("term").agg(F.sum("df")).collect():  # words of the items of this pass
        weights[term] = weight(documents, df)
    words = [(np.array([vocabulary[w] for w in a], np.int64), np.array([*a.values()], np.int64)) for a in asked]
    found = materialise(forward.mapInArrow(_search(words, weights, documents, length, k), FOUND), "found")
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], f"item int, item_id {item_type}")
    return found.join(F.broadcast(names), "item")


def search(docs: DataFrame, benchmark: DataFrame, k: int = 10, text: str = "text", key: str = "doc_id", item: str = "item_id") -> DataFrame:
    """item_id, rank, doc_id, score: the `k` best documents of every item, scores above 0.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII; only A-Z are
    lower-cased.  Null, empty and blank texts have no terms: such documents do not count and
    such items get no rows.  Equal scores are ordered by id, null ids last; repeated rows are
    documents and items of their own.  Texts of any length are read whole.  Empty tables give no
    rows.  Other columns are not read.

    The items go to the tasks in blocks of about ITEM_WORDS words, dealt by hash, with one pass
    over the documents each; every pass indexes all documents by the words of its items.
    """
    spark = docs.sparkSession
    texts = docs.select(whole_number(key).alias("doc_id"), text_of(text).cast("binary").alias("text"))
    asked = benchmark.select(F.col(f"`{item}`").alias("item_id"), text_of(text).cast("binary").alias("text"))
    asked = materialise(asked, "items")
    size = asked.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    passes = max(1, -(-size // (6 * ITEM_WORDS)))
    item_type = asked.schema["item_id"].dataType.simpleString()
    out = None
    for i in range(passes):
        block = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == i).collect()  # ITEM_WORDS words, about
        found = _pass(spark, texts, [(r[0], bytes(r[1])) for r in block], item_type, k).withColumn("pass", F.lit(i))
        out = found if out is None else out.unionByName(found)
    best = W.partitionBy("pass", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
