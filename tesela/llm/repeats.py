"""Repeated passages by sliding sentence spans.

Every run of three consecutive sentences is a span.  So that passages of fewer, longer sentences
are found too, a run of one or two sentences is a span if it has at least 16 words, and fewer
without its first or without its last sentence.  Longer runs need no spans: where one is repeated, the runs of three in it
are.  Sentences without words are passed over.

A span is hashed to 128 bits.  Spans are joined globally by their hashes, and the sentences under
any span that came before, in a text of smaller id or earlier in the text, are removed.  Spans and
removals belong to rows, so ids may be null or repeated.  A text of any length is cut in time and
memory that grow with it; spans leave the tasks in slices.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import drop_folder, fresh_name, materialise, sized, text_of, whole_number

#: Sentences of a run, and words of a run of fewer sentences (0: there are no such runs).
RUN = 3
MIN_WORDS = 16
#: Spans that a task holds before it hands them on.
SLICE = 20_000
#: A sentence and what divides it from the next one.
SENTENCE = re.compile(r"[^.!?\n]*(?:[.!?]+|\n|$)[\s]*")

#: Up to so many removed sentences (four bytes each) are broadcast to the texts.
BROADCAST_SENTENCES = 10_000_000

SPANS = "row bigint, doc_id bigint, h1 bigint, h2 bigint, start int, length int, again boolean"


def sentences(text: str) -> list[str]:
    """The pieces of a text, which joined give the text."""
    return [s for s in SENTENCE.findall(text) if s]


def spans(text: str, min_words: int = MIN_WORDS, run: int = RUN) -> tuple[list[tuple[int, int, bytes]], int]:
    """(start, length, digest) of every span, by start and length, and the number of sentences."""
    import xxhash

    words = [s.split() for s in sentences(text)]
    at = [i for i, w in enumerate(words) if w]
    norm = [" ".join(words[i]).encode() for i in at]
    out = []
    for a, first in enumerate(at):
        lengths, total = [], 0
        for n in range(1, min(run, len(at) - a + 1) if min_words else 1):
            last = len(words[at[a + n - 1]])
            total += last
            if total >= min_words and min(total - len(words[first]), total - last) < min_words:
                lengths.append(n)
        if a + run <= len(at):
            lengths.append(run)
        out += [(first, at[a + n - 1] - first + 1, xxhash.xxh3_128_digest(b"\n".join(norm[a : a + n]))) for n in lengths]
    return out, len(words)


def _cut(min_words: int, run: int):
    names = ["row", "doc_id", "h1", "h2", "start", "length", "again"]

    def found_spans(owners, digests, starts, lengths, again):
        n, halves = len(owners), np.frombuffer(bytes(digests), np.int64).reshape(-1, 2)
        none = pa.nulls(n, pa.int64())
        columns = [pa.array(np.array(owners)), none, pa.array(halves[:, 0]), pa.array(halves[:, 1])]
        columns += [pa.array(np.array(starts, np.int32)), pa.array(np.array(lengths, np.int32)), pa.array(np.array(again, bool))]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = owners, digests, starts, lengths, again = array("q"), bytearray(), array("i"), array("i"), array("b")
        for batch in batches:
            sizes = array("i")
            for row, text in zip(batch.column(0), batch.column(2)):
                row, (found, n) = row.as_py(), spans(text.as_py(), min_words, run)
                seen = set()
                for start, length, digest in found:
                    owners.append(row)
                    digests += digest
                    starts.append(start)
                    lengths.append(length)
                    again.append(digest in seen)
                    seen.add(digest)
                sizes.append(n)
                if len(owners) >= SLICE:
                    yield found_spans(*columns)
                    for c in columns:
                        del c[:]
            if sizes:  # one row for each text: no hash, its id, and its number of sentences
                n, none = len(sizes), pa.nulls(len(sizes), pa.int64())
                numbers = [pa.array([-1] * n, pa.int32()), pa.array(np.array(sizes)), pa.array([False] * n)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), none, none, *numbers], names=names)
        if owners:
            yield found_spans(*columns)

    return cut


def _covered(spans_column: str):
    """The different sentences under a list of (start, length)."""
    return F.array_sort(F.array_distinct(F.flatten(F.transform(spans_column, lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))))


def _numbered(docs: DataFrame, row: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """`docs` with a number `row` that goes by id, nulls last, and by the hash of the text, so that
    of some rows the smallest number is the first.  Equal rows are dealt out by their place."""
    place = fresh_name("place")
    order = [whole_number(key).isNull(), whole_number(key), F.xxhash64(text_of(text)), F.col(place)]
    placed = docs.withColumn(place, F.monotonically_increasing_id())
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.drop(place).withColumn(row, F.monotonically_increasing_id())


def _removed(numbered: DataFrame, row: str, min_words: int, run: int, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The table of spans of `numbered`, docs with an ordered number `row`, and (row, removed) for
    the rows that lose sentences, both written."""
    source = numbered.select(row, whole_number(key).alias("doc_id"), text_of(text))
    table = materialise(source.mapInArrow(_cut(min_words, run), SPANS), "spans")
    hashed = table.where("h1 is not null").select("row", "h1", "h2", "start", "length", "again")
    several = hashed.groupBy("h1", "h2").agg(F.min("row").alias("first_row"), F.max("row").alias("last_row"), F.max("again").alias("twice"))
    several = materialise(several.where("first_row < last_row or twice").select("h1", "h2", "first_row"), "repeated-spans")
    later = hashed.join(several, ["h1", "h2"]).where("row != first_row or again")
    gone = later.groupBy("row").agg(F.collect_set(F.struct("start", "length")).alias("spans")).select("row", _covered("spans").alias("removed"))
    gone = materialise(gone, "removed")
    drop_folder(numbered.sparkSession, several)
    return table, gone


def repeated_sentences(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text", key: str = "doc_id", run: int = RUN) -> DataFrame:
    """(doc_id, n_sentences, removed) for every row of `docs`; removed lists the numbers of the
    sentences under a repeated span that is not the first one.

    The first one is that of the smallest id, null ids last, of equal ids that of the smallest
    hash of the text, and in a text the earliest; of rows equal in both, one is the first.  Every
    row is a text of its own.  Null, empty and short texts have no spans, an empty table gives no
    rows.  Other columns are not read.
    """
    row = fresh_name("row")
    table, gone = _removed(_numbered(docs, row, text, key), row, min_words, run, text, key)
    texts = table.where("h1 is null").select("row", "doc_id", F.col("length").cast("long").alias("n_sentences"))
    removed = F.coalesce("removed", F.array().cast("array<int>")).alias("removed")
    return texts.join(gone, "row", "left").select("doc_id", "n_sentences", removed)


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, count: str | None = None, run: int = RUN) -> DataFrame:
    """All rows and columns of `docs`, with `text` freed of its repeated sentences.  With `count`,
    a column of that name tells how many were removed.  Null texts stay null.  The rows are
    written once, so that their numbers hold."""
    row, same, removed = fresh_name("row"), fresh_name("same"), fresh_name("removed")
    numbered = materialise(_numbered(docs, row), "numbered")
    table, gone = _removed(numbered, row, min_words, run)
    drop_folder(docs.sparkSession, table)
    gone = gone.select(F.col("row").alias(same), F.col("removed").alias(removed))
    if (gone.agg(F.sum(F.size(removed))).first()[0] or 0) <= BROADCAST_SENTENCES:
        gone = sized(gone)

    @arrow_udf("string")
    def without(texts: pa.Array, removed: pa.Array) -> pa.Array:
        out = []
        for text, numbers in zip(texts, removed):
            text, numbers = text.as_py(), numbers.as_py()
            if text is not None and numbers:
                drop = set(numbers)
                text = "".join(s for i, s in enumerate(sentences(text)) if i not in drop)
            out.append(text)
        return pa.array(out, pa.string())

    joined = numbered.join(gone, F.col(row) == F.col(same), "left")
    counted = [F.coalesce(F.size(removed), F.lit(0)).cast("long").alias(count)] if count else []
    cleaned = joined.withColumn("text", without("text", removed))
    return cleaned.select(*(F.col(f"`{c}`") for c in docs.columns), *counted)
