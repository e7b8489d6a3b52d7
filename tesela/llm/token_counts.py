"""Exact token counts of every prefix by dynamic programming.

For each prefix of a word the last token of its encoding is kept.  A token that ends at byte i
and starts at byte k is the last one of the prefix i exactly if it can stand behind the last
token of the prefix k; then count[i] = count[k] + 1.  One pass gives the counts of all
prefixes, so truncation and budget questions need no further encoding.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of, whole_number

#: Different words whose counts a worker remembers; then it starts anew.
REMEMBERED = 400_000


def read_merges(path: str) -> dict:
    """Vocabulary, merges and special strings of a .json tokenizer: a few MB for any corpus."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    return {
        "vocab": model["model"]["vocab"],
        "merges": [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["model"]["merges"]],
        "special": [t["content"] for t in model["added_tokens"]],
    }


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: visible Latin-1 characters
    stand for themselves, the other bytes follow from code point 256 on, in order."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PrefixCounter:
    """Token counts of the prefixes of words."""

    def __init__(self, model: dict):
        letter = byte_letters()
        raw = {t: bytes(letter[c] for c in t) for t in model["vocab"]}
        self.ids = {raw[t]: i for t, i in model["vocab"].items()}
        self.longest = max(map(len, self.ids))
        #: Merge order of a token, -1 for single bytes; and the two tokens that it is made of.
        self.order = dict.fromkeys(self.ids.values(), -1)
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for n, (a, b) in enumerate(model["merges"]):
            left, right, whole = model["vocab"][a], model["vocab"][b], self.ids[raw[a] + raw[b]]
            self.joined[left, right] = n
            if self.order[whole] < 0:
                self.order[whole], self.halves[whole] = n, (left, right)
        self.neighbours: dict[tuple[int, int], bool] = {}
        self.stable: dict[int, bool] = {}
        self.known: dict[str, int] = {}

    def _meet(self, left: int, right: int, limit: float) -> bool:
        """Whether no merge across the border of two tokens comes before those that made them.

        The merges are undone from the last one back.  At each state the pair at the border
        must not be due earlier than the merge undone last; of equal merges the left one is due
        first.
        """
        while True:
            if self.joined.get((left, right), limit) < limit:
                return False
            a, b = self.order[left], self.order[right]
            if a < 0 and b < 0:
                return True
            if a > b:
                left, limit = self.halves[left][1], a
            else:
                right, limit = self.halves[right][0], b + 1

    def can_follow(self, left: int, right: int) -> bool:
        pair = (left, right)
        found = self.neighbours.get(pair)
        if found is None:
            self.neighbours[pair] = found = self._meet(left, right, float("inf"))
        return found

    def is_stable(self, token: int) -> bool:
        """Whether the bytes of the token are encoded as the token."""
        found = self.stable.get(token)
        if found is None:
            found = True
            if token in self.halves:
                left, right = self.halves[token]
                found = self.is_stable(left) and self.is_stable(right) and self._meet(left, right, self.order[token])
            self.stable[token] = found
        return found

    def prefixes(self, word: bytes) -> list[int]:
        """Token counts of word[:0], word[:1], ..., word."""
        count, last = [0], [-1]
        for end in range(1, len(word) + 1):
            for start in range(max(0, end - self.longest), end):
                token = self.ids.get(word[start:end])
                if token is not None and self.is_stable(token) and (start == 0 or self.can_follow(last[start], token)):
                    count.append(count[start] + 1)
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
        return count

    def total(self, word: str) -> int:
        n = self.known.get(word)
        if n is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            if len(self.neighbours) >= 4 * REMEMBERED:
                self.neighbours.clear()
            self.known[word] = n = self.prefixes(word.encode())[-1]
        return n


class TextCounter:
    """Token counts of the prefixes of texts: words are cut by the pattern; the special strings
    of the tokenizer are one token each, as the library has it by default."""

    def __init__(self, model: dict, pattern: str):
        import regex

        self.words = regex.compile(pattern).findall
        self.special = sorted(model["special"], key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else lambda t: [t]
        self.counter = PrefixCounter(model)

    def total(self, text: str) -> int:
        total = self.counter.total
        if any(s in text for s in self.special):
            return sum(1 if piece in self.special else sum(map(total, self.words(piece))) for piece in self.split(text))
        return sum(map(total, self.words(text)))

    def prefixes(self, text: str) -> list[int]:
        """Counts of text[:0], text[:1], ..., text: what encoding that prefix alone would give.

        Words before the last one of a prefix are the words of the whole text.  The last one is
        cut; where the cut makes it other words (an apostrophe and part of its letters, or the
        first blank of a word behind other white space) those few characters are looked up again.
        """
        out, base, last = [0], 0, ""
        for piece in self.split(text):
            if piece in self.special:
                # A cut special string is ordinary text that may go on with the last word.
                rest = base - (self.counter.total(last) if last else 0)
                out += [rest + self._tail(last + piece[:n]) for n in range(1, len(piece))] + [base + 1]
                base, last = base + 1, ""
                continue
            before = ""  # the word before, if white space
            for word in self.words(piece):
                ends, at = [], 0
                for c in word:
                    at += len(c.encode())
                    ends.append(at)
                counts = self.counter.prefixes(word.encode())
                for n, end in enumerate(ends, 1):
                    part = word[:n]
                    if n == 1 and before and part.isspace():
                        out.append(base - self.counter.total(before) + self.counter.total(before + part))
                    elif word[0] == "'" and n < len(word) and self.words(part) != [part]:
                        out.append(base + sum(map(self.counter.total, self.words(part))))
                    else:
                        out.append(base + counts[end])
                base += counts[-1]
                before, last = word if word.isspace() else "", word
        return out

    def _tail(self, part: str) -> int:
        return sum(map(self.counter.total, self.words(part)))


def longest_within(counts: list[int], budget: int) -> int:
    """The longest prefix, in characters, of at most `budget` tokens.  Counts of prefixes rise
    and fall by a few tokens, so the last one within the budget is looked for."""
    for n in range(len(counts) - 1, -1, -1):
        if counts[n] <= budget:
            return n
    return 0


def _count(model, pattern: str, limit: int, prefixes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TextCounter(model.value, pattern)
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1)]
            columns = [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64())]
            if prefixes:
                of_prefix = [counter.prefixes(t) for t in texts]
                totals = [c[-1] for c in of_prefix]
            else:
                totals = [counter.total(t) for t in texts]
            columns += [pa.array(totals, pa.int64()), pa.array([n > limit for n in totals], pa.bool_())]
            names = ["doc_id", "n_bytes", "n_tokens", "over_limit"]
            if prefixes:
                columns.append(pa.array(of_prefix, pa.list_(pa.int32())))
                columns.append(pa.array([longest_within(c, limit) for c in of_prefix], pa.int64()))
                names += ["prefix_tokens", "fits_chars"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def token_counts(docs: DataFrame, tokenizer: str, pattern: str, limit: int = 512, prefixes: bool = False, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of `docs`.

    With `prefixes`, also `prefix_tokens`, the token count of every prefix by characters, and
    `fits_chars`, the longest prefix of at most `limit` tokens.  Null texts count as empty: no
    bytes, no tokens.  Keys may be null or repeated; each row gives one row.  Other columns are
    not read.  The work is a map: no shuffle, and a worker remembers at most REMEMBERED words.
    """
    model = docs.sparkSession.sparkContext.broadcast(read_merges(tokenizer))
    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    if prefixes:
        schema += ", prefix_tokens array<int>, fits_chars bigint"
    source = docs.select(whole_number(key).alias("doc_id"), text_of(text).alias("text"))
    return source.mapInArrow(_count(model, pattern, limit, prefixes), schema)


def truncate(docs: DataFrame, tokenizer: str, pattern: str, limit: int) -> DataFrame:
    """The texts cut to `limit` tokens: (doc_id, text, n_tokens)."""
    source = docs.select(whole_number().alias("doc_id"), text_of().alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(read_merges(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TextCounter(model.value, pattern)
        for batch in batches:
            kept, n = [], []
            for t in batch.column(1):
                whole = t.as_py()
                counts = counter.prefixes(whole)
                at = longest_within(counts, limit)
                kept.append(whole[:at])
                n.append(counts[at])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string()), pa.array(n, pa.int64())], names=["doc_id", "text", "n_tokens"])

    return source.mapInArrow(run, "doc_id bigint, text string, n_tokens bigint")
