"""Benchmark decontamination with a broadcast hash set of test n-grams, in SQL functions only.

Each window of a document is hashed in place and looked up in the set; a hit is verified word
by word.  Nothing is shuffled but one row for each document and its hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh_name, materialise, sized, text_digest, text_of, whole_number

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word: anything but ASCII control, blank and punctuation characters (after lower-casing).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same in texts that keep their capitals.
WORD_AS_WRITTEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Up to so many n-grams are broadcast: about 250 bytes each, so 100 MB at most.  A larger
#: benchmark is joined by shuffling the windows.
BROADCAST_GRAMS = 400_000


def words_of(text: str = "text") -> Column:
    return F.regexp_extract_all(F.translate(text_of(text), UPPER, LOWER), F.lit(WORD), F.lit(0))


def test_grams(benchmark: DataFrame, n: int = 10) -> DataFrame:
    """(length, hash, gram, items): every different window of `n` words of the items, and the
    ids of the items that have it.  An item of fewer words, but not none, is one window."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of().alias("words")).where(F.size("words") > 0)
    length = F.least(F.lit(n), F.size("words"))
    windows = F.transform(F.sequence(F.lit(1), F.size("words") - length + 1), lambda i: F.slice("words", i, length))
    rows = items.select("item_id", F.explode(windows).alias("window"))
    return (
        rows.groupBy(F.size("window").alias("length"), F.array_join("window", " ").alias("gram"))
        .agg(F.collect_set("item_id").alias("items"), F.first(F.xxhash64("window")).alias("hash"))
        .select("length", "hash", "gram", "items")
    )


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 10, digest: bool = False, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of `docs`: doc_id, n_words and `hits`, the verified windows as
    (start, length, items), start counted in words from 0; with `digest` also text_key.

    Null and empty texts have no words and no hits.  Keys may be null or repeated: rows are
    told apart by a number of their own.  Null item ids count as hits and are not listed.  An
    empty benchmark gives no hits.  Other columns of `docs` are not read.
    """
    grams = materialise(test_grams(benchmark, n), "test-grams")
    lengths = sorted(r[0] for r in grams.select("length").distinct().collect())  # n numbers at most
    if grams.count() <= BROADCAST_GRAMS:
        grams = F.broadcast(grams)
    same = ["row", "doc_id", "n_words"]
    rows = docs.select(
        whole_number(key).alias("doc_id"),
        words_of(text).alias("words"),
        F.monotonically_increasing_id().alias("row"),
        *([text_digest(text).alias("text_key")] if digest else []),
    ).withColumn("n_words", F.size("words"))
    if digest:
        same.append("text_key")
    at = rows.select("*", F.posexplode_outer("words").alias("start", "_word"))

    def hashed(length: Column | int) -> Column:
        return F.when(F.col("start") + length <= F.col("n_words"), F.xxhash64(F.slice("words", F.col("start") + 1, F.lit(length))))

    if len(lengths) > 1:
        at = at.select("*", F.inline(F.array(*(F.struct(F.lit(k).alias("window_length"), hashed(k).alias("window_hash")) for k in lengths))))
    else:
        k = lengths[0] if lengths else n
        at = at.select("*", F.lit(k).alias("window_length"), hashed(k).alias("window_hash"))
    found = at.join(
        grams,
        (F.col("window_hash") == F.col("hash"))
        & (F.col("window_length") == F.col("length"))
        & (F.array_join(F.slice("words", F.col("start") + 1, F.col("length")), " ") == F.col("gram")),
        "left",
    )
    first = F.col("start").isNull() | ((F.col("start") == 0) & (F.col("window_length") == (lengths[0] if lengths else n)))
    kept = found.where(F.col("gram").isNotNull() | first)
    hit = F.when(F.col("gram").isNotNull(), F.struct("start", F.col("length"), "items"))
    return kept.groupBy(*same).agg(F.array_sort(F.collect_list(hit)).alias("hits")).drop("row")


def merged(hits: str = "hits") -> Column:
    """The runs of words [start, stop) that the sorted hits cover."""
    run = "struct<start:int,stop:int>"

    def add(runs: Column, hit: Column) -> Column:
        stop = hit["start"] + hit["length"]
        last = F.element_at(runs, -1)
        new = F.concat(runs, F.array(F.struct(hit["start"].alias("start"), stop.alias("stop")).cast(run)))
        longer = F.concat(
            F.slice(runs, 1, F.size(runs) - 1),
            F.array(F.struct(last["start"].alias("start"), F.greatest(last["stop"], stop).alias("stop")).cast(run)),
        )
        return F.when((F.size(runs) > 0) & (F.try_element_at(runs, F.lit(-1))["stop"] >= hit["start"]), longer).otherwise(new)

    return F.aggregate(hits, F.array().cast(f"array<{run}>"), add)


def covered(hits: str = "hits") -> Column:
    """How many words the sorted hits cover."""
    start = F.struct(F.lit(0).alias("stop"), F.lit(0).cast("long").alias("words"))

    def add(so_far: Column, hit: Column) -> Column:
        stop = hit["start"] + hit["length"]
        new = F.greatest(F.lit(0), stop - F.greatest(so_far["stop"], hit["start"]))
        return F.struct(F.greatest(so_far["stop"], stop).alias("stop"), (so_far["words"] + new).alias("words"))

    return F.aggregate(hits, start, add, lambda x: x["words"])


def report(scanned: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"]))))
    counted = scanned.select("doc_id", F.col("n_words").cast("long").alias("n_words"), covered().alias("n_hit"), items.alias("items"))
    return counted.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _hit_texts(docs: DataFrame, benchmark: DataFrame, n: int, names: tuple[str, str]) -> DataFrame:
    """One row for each key and text that is hit: the key and the hits, under these names."""
    hit = scan(docs, benchmark, n, digest=True).where(F.size("hits") > 0)
    key, hits = names
    rows = hit.groupBy(F.struct("doc_id", "text_key").alias(key)).agg(F.first("hits").alias(hits))
    return materialise(rows, "hit-texts")


def _row_key() -> Column:
    return F.struct(whole_number().alias("doc_id"), text_digest().alias("text_key"))


def drop_documents(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """The rows of `docs`, with all columns, whose texts hold no window of the benchmark."""
    key, hits = fresh_name("key"), fresh_name("hits")
    hit = sized(_hit_texts(docs, benchmark, n, (key, hits)).select(key))
    return docs.join(hit, _row_key() == F.col(key), "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """All rows and columns of `docs`, with `text` freed of the words that are hit and of the
    characters between them and the next word.  Other texts stay as they are."""
    key, hits = fresh_name("key"), fresh_name("hits")
    joined = docs.join(_hit_texts(docs, benchmark, n, (key, hits)), _row_key() == F.col(key), "left")
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD_AS_WRITTEN), F.lit(0))
    gaps = F.split(F.col("text"), WORD_AS_WRITTEN, -1)
    runs = merged(hits)
    rest = F.transform(
        words,
        lambda w, i: F.when(F.exists(runs, lambda r: (r["start"] <= i) & (i < r["stop"])), F.lit("")).otherwise(
            F.concat(w, F.element_at(gaps, i + 2))
        ),
    )
    cleaned = F.when(F.col(key).isNull(), F.col("text")).otherwise(F.concat(gaps[0], F.array_join(rest, "")))
    return joined.withColumn("text", cleaned).select(*(F.col(f"`{c}`") for c in docs.columns))
