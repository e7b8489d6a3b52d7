"""Byte-level BPE by one shuffle of distinct words.

Documents are cut into words by the pattern of the vocabulary.  A task keeps the words of a
block of documents in a dictionary and each document as a list of places in it, so the position
of every word is kept and a word crosses the network once per block and not once per use.
The dictionaries are dealt out by word; each distinct word is encoded once; its ids return to
the block and place they came from, and the documents are put together by position.

The texts are cut twice, once for the dictionaries and once for the places: that takes less
than writing the places to a table and reading them again.  A block is named by its words, so
an input that came in another order the second time ends in an error and not in wrong ids.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import give_back, giving_back, text_of, whole_number

#: A block of documents ends after so many words, or so many different ones.
BLOCK_WORDS = 3_000_000
BLOCK_DISTINCT = 300_000
#: Words of a block are dealt to so many buckets for each shuffle partition.
BUCKETS_PER_PARTITION = 8
#: Words put together at once.
GATHER = 250_000

BLOCKS = "block string, doc_ids array<bigint>, lengths array<int>, places binary"
WORDS = "block string, bucket int, words binary, slots binary"
ENCODED = "block string, slots binary, counts binary, ids binary"
DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a .tiktoken file: a few MB whatever the size of the corpus."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Merger:
    """Encodes one word by the ranks: of all neighbours the pair of lowest rank is joined first,
    the leftmost of equals."""

    LONG = 48

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def encode(self, word: bytes) -> list[int]:
        whole = self.ranks.get(word)
        if whole is not None:
            return [whole]
        return self._short(word) if len(word) <= self.LONG else self._long(word)

    def _short(self, word: bytes) -> list[int]:
        ranks = self.ranks
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def _long(self, word: bytes) -> list[int]:
        """The same for long words, with a heap of pairs over a linked list of parts."""
        ranks, n = self.ranks, len(word)
        end = list(range(1, n + 1))  # end[i]: where the part that starts at i ends; 0 once it is joined to another
        before = list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = end[i]
            if j < n:
                r = ranks.get(word[i : end[j]])
                if r is not None:
                    heapq.heappush(heap, (r, i, j, end[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, j, k = heapq.heappop(heap)
            if end[i] != j or end[j] != k:
                continue
            end[i], end[j] = k, 0
            if k < n:
                before[k] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[word[i : end[i]]])
            i = end[i]
        return out


class _Slots(dict):
    """Gives each new word the next place."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def _pack(numbers: np.ndarray) -> bytes:
    """Whole numbers below 2^32 as four planes of bytes, compressed: lists of numbers are what
    is written and shuffled most here."""
    import zstandard

    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4")


def _pack_words(words: list[bytes]) -> bytes:
    """The lengths of the words, then their bytes, compressed."""
    import zstandard

    lengths = np.fromiter(map(len, words), "<u4", len(words))
    raw = np.uint32(len(words)).tobytes() + lengths.tobytes() + b"".join(words)
    return zstandard.ZstdCompressor(level=6).compress(raw)


def _unpack_words(packed: bytes) -> list[bytes]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(packed)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    ends = (np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64) + 4 + 4 * n).tolist()
    return [raw[a:b] for a, b in zip([4 + 4 * n, *ends], ends)]


def _cut(pattern: str, placed: bool = True):
    """Blocks of documents: (name, doc ids, their numbers of words, places, words by place);
    without `placed` the places are left out."""

    def blocks(batches: Iterator[pa.RecordBatch]):
        import zlib

        import regex
        from pyspark import TaskContext

        find = regex.compile(pattern).findall
        part = TaskContext.get().partitionId()
        slots, ids, lengths, places, total = _Slots(), [], [], [], 0

        def block():
            words = [w.encode() for w in slots]
            name = f"{part}-{len(ids)}-{total}-{zlib.crc32(b' '.join(words))}"
            return name, ids, lengths, np.concatenate(places) if placed else None, words

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = find(text.as_py())
                ids.append(doc_id)
                lengths.append(len(words))
                at = np.fromiter(map(slots.__getitem__, words), np.uint32, len(words))
                if placed:
                    places.append(at)
                total += len(words)
                if total >= BLOCK_WORDS or len(slots) >= BLOCK_DISTINCT:
                    yield block()
                    slots, ids, lengths, places, total = _Slots(), [], [], [], 0
        if ids:
            yield block()

    return blocks


def _places(pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, ids, lengths, places, _ in _cut(pattern)(batches):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name], pa.string()),
                    pa.array([ids], pa.list_(pa.int64())),
                    pa.array([lengths], pa.list_(pa.int32())),
                    pa.array([_pack(places)], pa.binary()),
                ],
                names=["block", "doc_ids", "lengths", "places"],
            )

    return run


def _dictionaries(pattern: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for name, _, _, _, words in _cut(pattern, placed=False)(batches):
            order: dict[int, list[int]] = {}
            for slot, word in enumerate(words):
                order.setdefault(zlib.crc32(word) % buckets, []).append(slot)
            for bucket, at in order.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name], pa.string()),
                        pa.array([bucket], pa.int32()),
                        pa.array([_pack_words([words[i] for i in at])], pa.binary()),
                        pa.array([_pack(np.diff(at, prepend=0))], pa.binary()),
                    ],
                    names=["block", "bucket", "words", "slots"],
                )

    return run


def _encode_words(ranks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Merger(ranks.value).encode
        known: dict[bytes, bytes] = {}  # the distinct words of this partition, ids in four bytes
        for batch in batches:
            for row in range(batch.num_rows):
                found = []
                for word in _unpack_words(batch.column("words")[row].as_py()):
                    ids = known.get(word)
                    if ids is None:
                        known[word] = ids = np.array(encode(word), np.uint32).tobytes()
                    found.append(ids)
                counts = np.fromiter(map(len, found), np.uint32, len(found)) // np.uint32(4)
                flat = np.frombuffer(b"".join(found), np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("block").slice(row, 1),
                        batch.column("slots").slice(row, 1),
                        pa.array([_pack(counts)], pa.binary()),
                        pa.array([_pack(flat)], pa.binary()),
                    ],
                    names=["block", "slots", "counts", "ids"],
                )

    return run


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each run (start, count) the numbers start, start + 1, ..., one run after the other."""
    total = int(counts.sum())
    skip = np.repeat(starts - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) if total else np.zeros(0, np.int64)
    return skip + np.arange(total)


def _values(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [_unpack(x) for x in column.to_pylist()]


def _put_together(left: pa.Table, right: pa.Table) -> pa.Table:
    """One block: `left` has its documents as places, `right` the ids of its words by place."""
    doc_ids, out = [pa.array([], pa.int64())], [pa.array([], pa.list_(pa.int32()))]
    flat, size, first = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if right.num_rows:
        slots = np.concatenate([np.cumsum(x, dtype=np.int64) for x in _values(right.column("slots"))])
        counts = np.concatenate(_values(right.column("counts"))).astype(np.int64)
        flat = np.concatenate(_values(right.column("ids"))).astype(np.int32)
        size, first = np.zeros(len(slots), np.int64), np.zeros(len(slots), np.int64)
        size[slots] = counts
        first[slots] = np.cumsum(counts) - counts
    for row in range(left.num_rows):
        ids = left.column("doc_ids")[row].values
        ends = np.concatenate(([0], np.cumsum(left.column("lengths")[row].values.to_numpy(), dtype=np.int64)))
        places = _unpack(left.column("places")[row].as_py())
        if len(places) and not len(size):
            raise RuntimeError("the input came in another order when it was read again: write it to a table first")
        lo, last = 0, len(ids)
        while lo < last:  # about GATHER words at once
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + GATHER, "right")) - 1)
            p = places[ends[lo] : ends[hi]]
            n = size[p]
            cuts = np.concatenate(([0], np.cumsum(n)))[ends[lo : hi + 1] - ends[lo]].astype(np.int32)
            out.append(pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat[_ragged(first[p], n)])))
            doc_ids.append(ids.slice(lo, hi - lo))
            lo = hi
    return pa.table({"doc_id": pa.chunked_array(doc_ids), "ids": pa.chunked_array(out)})


def _blocks(docs: DataFrame, ranks, pattern: str, text: str = "text", key: str = "doc_id"):
    """Blocks of documents as places beside the ids of their words, by name of the block."""
    buckets = BUCKETS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(whole_number(key).alias("doc_id"), text_of(text).alias("text"))
    words = source.mapInArrow(giving_back(_dictionaries(pattern, buckets)), WORDS).repartition("bucket")
    encoded = words.mapInArrow(giving_back(_encode_words(ranks)), ENCODED)
    blocks = source.mapInArrow(giving_back(_places(pattern)), BLOCKS)
    return blocks.groupBy("block").cogroup(encoded.groupBy("block"))


def encode(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Token ids of every whole text: (doc_id, ids), one row per row of `docs`.

    Null texts count as empty and give no ids; null and repeated keys are kept, row by row;
    other columns of `docs` are not read.  An empty table gives an empty result.  `docs` is read
    twice and must come in the same order both times, as a stored table does.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    return _blocks(docs, ranks, pattern, text, key).applyInArrow(_put_together, "doc_id bigint, ids array<int>")


class TokenBytes:
    """The token-byte table: one entry for each of the vocabulary, which bounds it."""

    def __init__(self, ranks: dict[bytes, int]):
        by_id = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, i in ranks.items():
            by_id[i] = token
        self.size = np.fromiter(map(len, by_id), np.int64, len(by_id))
        self.first = np.cumsum(self.size) - self.size
        self.blob = np.frombuffer(b"".join(by_id), np.uint8)

    def join(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids, one after the other; many ids in pieces."""
        parts = (ids[i : i + GATHER] for i in range(0, len(ids), GATHER))
        return b"".join(self.blob[_ragged(self.first[p], self.size[p])].tobytes() for p in parts)


def _id_lists(lists: pa.Array) -> Iterator[np.ndarray]:
    ids = lists.flatten().to_numpy(zero_copy_only=False)
    end = 0
    for n in lists.value_lengths().fill_null(0).to_pylist():
        end += n
        yield ids[end - n : end]


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, decoded) for (doc_id, ids): the bytes of the ids, joined from the token-byte
    table.  Null lists decode to no bytes."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = TokenBytes(ranks.value)
        for batch in batches:
            decoded = pa.array([table.join(ids) for ids in _id_lists(batch.column(1))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), decoded], names=["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(giving_back(run), "doc_id bigint, decoded binary")


def _digest(batch: pa.RecordBatch, table: TokenBytes) -> pa.RecordBatch:
    counts, of_ids, of_bytes = [], [], []
    for ids in _id_lists(batch.column(1)):
        counts.append(len(ids))
        of_ids.append(hashlib.sha256(ids.astype("<u4")).hexdigest())
        of_bytes.append(hashlib.sha256(table.join(ids)).hexdigest())
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
        names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    )


def digests(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for (doc_id, ids): what encoders and
    decoders must agree on.  Decodes as `decode` does, and keeps the digest only."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = TokenBytes(ranks.value)
        for batch in batches:
            yield _digest(batch, table)

    return encoded.select("doc_id", "ids").mapInArrow(giving_back(run), DIGESTS)


def round_trip(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Encode all texts, decode the ids, and return the digests of both, as `digests` of `encode`
    gives them; the ids of a block are decoded where they were put together."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    schema = pa.schema({"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()})
    tables: list[TokenBytes] = []  # one in each task

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not tables:
            tables.append(TokenBytes(ranks.value))
        found = [_digest(batch, tables[0]) for batch in _put_together(left, right).to_batches()]
        give_back()
        return pa.Table.from_batches(found, schema)

    return _blocks(docs, ranks, pattern).applyInArrow(run, DIGESTS)
