"""Exact and near duplicates, decontamination and repeated passages against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from llm.conftest import PASSAGE, docs_of
from pyspark.sql import functions as F

from tesela.llm import common, components, decontaminate, exact_dedup, repeats, shingles, simhash


def groups_of(texts):
    """What exact dedup must return, as a sorted list."""
    by = defaultdict(list)
    for i, t in texts:
        by[t or ""].append(-1 if i is None else i)
    out = []
    for t, ids in by.items():
        sha = hashlib.sha256(t.encode()).hexdigest()
        kept = [True] + [False] * (len(ids) - 1)
        out += [(i, max(ids), len(ids), k, sha) for i, k in zip(sorted(ids, reverse=True), kept)]
    return sorted(out)


def plain(rows):
    return sorted((-1 if r.doc_id is None else r.doc_id, -1 if r.keep_id is None else r.keep_id, r.group_size, r.kept, r.text_sha256) for r in rows)


def weak(text):
    return F.substring(F.unhex(F.md5(text)), 1, 1)


@pytest.mark.parametrize("digest", [exact_dedup.sha256_digest, weak])
@pytest.mark.parametrize("limit", [0, None])
def test_exact_groups(spark, hard_texts, digest, limit, monkeypatch):
    """Also with a digest of one byte, where texts of a digest differ, and without broadcasts."""
    if limit is not None:
        monkeypatch.setattr(common, "BROADCAST_ROWS", limit)
    texts = hard_texts + [(100 + i, f"text {i % 90}") for i in range(300)]
    got = exact_dedup.duplicates(docs_of(spark, texts), exact_dedup.first_half(), digest=digest, filter_keys=20).collect()
    assert plain(got) == groups_of(texts)


@pytest.mark.parametrize("batch", ["true", "false", "cast(null as boolean)"])
def test_exact_groups_of_one_side(spark, hard_texts, batch):
    assert plain(exact_dedup.duplicates(docs_of(spark, hard_texts), F.expr(batch)).collect()) == groups_of(hard_texts)


def test_exact_groups_of_nothing(spark):
    assert exact_dedup.duplicates(docs_of(spark, [(1, "a")]).where("false"), exact_dedup.first_half()).count() == 0


def test_kept_rows_keep_their_columns(spark, hard_texts):
    docs = docs_of(spark, hard_texts)
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    want = sorted((i, t) for i, _, _, k, t in groups_of(hard_texts) if k)
    got = sorted((-1 if r.doc_id is None else r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in kept.collect())
    assert got == want


@pytest.mark.parametrize("n", [1, 2, 3, 50, 5000, 40_000])
def test_fuse_filter(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 2**63, n).astype(np.uint64)
    f = exact_dedup.BinaryFuseFilter.build(np.concatenate([keys, keys[: n // 2]]))
    assert f.knows(keys).all()
    if n >= 5000:
        others = rng.integers(0, 2**63, 50_000).astype(np.uint64)
        assert f.knows(others).mean() < 0.008 and len(f.table) < 1.4 * n + 1000


def brute_print(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + width]) for i in range(max(len(words) - width + 1, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_near(texts):
    prints = [brute_print(t or "") for _, t in texts]
    part = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4 and part[a] != part[b]:
                part = [part[b] if p == part[a] else p for p in part]
    least = {}
    for p, (i, _) in zip(part, texts):
        ids = [x for x in (least.get(p), i) if x is not None]
        least[p] = min(ids) if ids else None
    return sorted((-1 if i is None else i, f"{f:016x}", -1 if least[p] is None else least[p]) for (i, _), f, p in zip(texts, prints, part))


@pytest.mark.parametrize("limit", [0, simhash.BROADCAST_KEYS])
def test_near_groups(spark, hard_texts, limit, monkeypatch):
    monkeypatch.setattr(simhash, "BROADCAST_KEYS", limit)
    rng = np.random.default_rng(3)
    base = [str(w) for w in rng.integers(0, 10_000, 600)]
    near = []
    for i in range(60):  # a chain of texts, each a few words further from the first
        words = list(base)
        for j in range(i % 12):
            words[(j * 37 + i) % 600] = f"new{i}"
        near.append((200 + i, " ".join(words)))
    texts = hard_texts + near + [(300 + i, " ".join(map(str, rng.integers(0, 99, 20)))) for i in range(40)]
    got = simhash.near_duplicates(docs_of(spark, texts)).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.fingerprint, -1 if r.component_id is None else r.component_id) for r in got) == brute_near(texts)


def test_prints_of_up_to_four_differences_share_a_key():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 1500).astype(np.uint64)
    b = a.copy()
    for i in range(len(a)):
        for bit in rng.choice(64, i % 5, replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    found = [set(zip(*map(np.ndarray.tolist, simhash.keys_of(x.view(np.int64))))) for x in (a, b)]
    assert {i for i, _ in found[0] & found[1]} == set(range(len(a)))


def test_golay_code_is_perfect():
    near = simhash.codewords(np.arange(1 << 16, dtype=np.int64))
    assert (near >= 0).any(axis=1).all() and near.shape[1] == 6


def test_a_dense_group_is_not_paired_off(spark):
    """All members of a close group hang on the hub, so that no pairs are left to compare."""
    hub = 0x123456789ABCDEF
    prints = [hub] + [hub ^ (1 << b) ^ (1 << c) for b in range(40) for c in range(b)]
    frame = spark.createDataFrame([(p, 9 if p == hub else 1) for p in prints], "print bigint, n bigint")
    links = simhash.links_of(frame)
    assert links.count() <= 3 * len(prints)
    assert components.components(links).select("component").distinct().count() == 1


def test_kept_first(spark, hard_texts):
    docs = docs_of(spark, hard_texts)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    near = brute_near(hard_texts)
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(i for i, _, c in near if i == c or i == -1)


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, 90), (90, 100), (95, 95), (7, 3)]
    frame = spark.createDataFrame(chain, "a bigint, b bigint")
    got = {r.node: r.component for r in components.components(frame).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {90: 90, 100: 90}
    assert components.components(frame.where("false")).count() == 0


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_hits(text, items, n=10):
    w, hit, found = words(text), set(), set()
    for item_id, item in items:
        v = words(item)
        size = min(n, len(v))
        for j in range(len(v) - size + 1 if v else 0):
            for i in range(len(w) - size + 1):
                if w[i : i + size] == v[j : j + size]:
                    hit.update(range(i, i + size))
                    found.add(item_id)
    ids = sorted(str(i) for i in found if i is not None)
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank"),
    (2, "quick Brown fox"),
    (10, "one TWO"),
    (11, "one two"),
    (None, "Before a passage"),
    (12, None),
    (13, " ,. "),
    (14, "a passage of more than fifty words which goes on for some time"),
]


@pytest.mark.parametrize("items", [ITEMS, ITEMS[:1], []])
def test_decontamination(spark, hard_texts, items):
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").withColumn("hash", F.lit(1))
    got = decontaminate.report(decontaminate.scan(docs_of(spark, hard_texts), benchmark)).collect()
    want = sorted((i or -1, *brute_hits(t, items)) for i, t in hard_texts)
    assert sorted((r.doc_id or -1, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == want


@pytest.mark.parametrize("limit", [0, None])
def test_contaminated_texts_go(spark, hard_texts, limit, monkeypatch):
    if limit is not None:
        monkeypatch.setattr(common, "BROADCAST_ROWS", limit)
        monkeypatch.setattr(decontaminate, "BROADCAST_GRAMS", limit)
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = docs_of(spark, hard_texts)
    kept = decontaminate.drop_documents(docs, benchmark)
    assert kept.columns == docs.columns
    want = sorted((i or -1, t or "") for i, t in hard_texts if not brute_hits(t, ITEMS)[-1])
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == want
    cleaned = decontaminate.remove_spans(docs, benchmark)
    assert cleaned.columns == docs.columns
    rows = {r.doc_id: r.text for r in cleaned.collect()}
    assert rows[9] == "" and rows[1] == "today." and rows[2] is None and rows[3] == ""
    assert rows[10].startswith("It has several") and rows[8] == dict(hard_texts)[8]


def brute_spans(text):
    """(sentences under it, words) of every span, from all runs of sentences with words."""
    pieces = [s.split() for s in repeats.sentences(text)]
    at = [i for i, w in enumerate(pieces) if w]
    for a, b in combinations(range(len(at) + 1), 2):
        sizes = [len(pieces[i]) for i in at[a:b]]
        if b - a == 3 or (b - a < 3 and sum(sizes) >= 16 and min(sum(sizes[1:]), sum(sizes[:-1])) < 16):
            yield range(at[a], at[b - 1] + 1), tuple(tuple(pieces[i]) for i in at[a:b])


def brute_repeats(texts):
    first, out = {}, {}
    for i in sorted({i for i, _ in texts if i is not None}):
        removed, own = set(), set()
        for t in (t for j, t in texts if j == i):
            for under, words in brute_spans(t or ""):
                if words in first and (first[words] < i or words in own):
                    removed.update(under)
                first.setdefault(words, i)
                own.add(words)
        out[i] = sorted(removed)
    return out


def test_three_short_sentences_are_a_span(spark, monkeypatch):
    """Runs of three repeated sentences go, shorter ones of few words stay; slices change nothing."""
    lines = [(1, "One. Two!\n\nThree? Four."), (2, "New. One. Two! Three? Old."), (3, "One. Two! Other."), (4, "a\na\na\na\n"), (5, "Two! Three? Four. Five.")]
    want = {1: [], 2: [1, 2, 3], 3: [], 4: [1, 2, 3], 5: [0, 1, 2]}
    assert brute_repeats(lines) == want
    for size in (1, 20_000):
        monkeypatch.setattr(repeats, "SLICE", size)
        got = {r.doc_id: list(r.removed) for r in repeats.repeated_sentences(docs_of(spark, lines)).collect()}
        assert got == want
    got = {r.doc_id: list(r.removed) for r in repeats.repeated_sentences(docs_of(spark, lines), run=2).collect()}
    assert got[3] == [0, 1]


def test_repeats_of_many_texts(spark):
    rng = np.random.default_rng(8)
    stock = [" ".join(f"w{n}" for n in rng.integers(0, 9, k)) + rng.choice([". ", "\n", "! "]) for k in (1, 1, 2, 3, 5, 8, 15, 16, 20)]
    texts = [(i, "".join(rng.choice(stock, rng.integers(0, 12)))) for i in range(150)]
    got = {r.doc_id: list(r.removed) for r in repeats.repeated_sentences(docs_of(spark, texts)).collect()}
    assert got == brute_repeats(texts)


def test_repeated_passages(spark, hard_texts):
    texts = [(i, t) for i, t in hard_texts if i is not None and i != 7] + [(30, f"{PASSAGE} {PASSAGE}"), (31, "Short. Text.")]
    got = {r.doc_id: list(r.removed) for r in repeats.repeated_sentences(docs_of(spark, texts)).collect()}
    assert got == brute_repeats(texts)
    assert got[11] and got[30] and not got[10] and not got[31]
    cleaned = repeats.remove_repeats(docs_of(spark, texts))
    rows = {r.doc_id: r.text for r in cleaned.collect()}
    assert cleaned.columns == docs_of(spark, texts).columns and rows[10] == dict(texts)[10] and rows[2] is None
    assert "subordinate" not in rows[11] and rows[11].startswith("Something else here.")
    counted = repeats.remove_repeats(docs_of(spark, texts), count="n_removed").collect()
    assert {r.doc_id: r.n_removed for r in counted} == {i: len(v) for i, v in brute_repeats(texts).items()}


def test_sentences_join_to_the_text(hard_texts):
    for _, t in hard_texts:
        assert "".join(repeats.sentences(t or "")) == (t or "")


def test_repeats_of_null_ids_and_nothing(spark, hard_texts):
    got = repeats.repeated_sentences(docs_of(spark, [(None, PASSAGE), (1, PASSAGE), (None, "Nothing.")])).collect()
    removed = {(r.doc_id, r.n_sentences): bool(r.removed) for r in got}
    assert removed[1, 5] is False and removed[None, 5] is True
    assert repeats.repeated_sentences(docs_of(spark, hard_texts).where("false")).count() == 0


def brute_similar(texts, width=5):
    """The rows that stay of groups with a Jaccard coefficient of 0.8 or more, (id, text)."""

    def grams(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {" ".join(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))} if w else set()

    sets, part = [grams(t) for _, t in texts], list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and part[a] != part[b]:
                part = [part[b] if p == part[a] else p for p in part]
    first = {}
    for p, (i, t) in zip(part, texts):
        row = (i is None, i or 0, hashlib.sha256((t or "").encode()).hexdigest(), i, t or "")
        first[p] = min(first.get(p, row), row)
    return sorted(((r[3], r[4]) for r in first.values()), key=str)


@pytest.mark.parametrize("limit", [0, None])
def test_similar_texts_leave_one(spark, hard_texts, limit, monkeypatch):
    """Copies with edited words far beyond four bits, null ids among them, and one id for two texts."""
    if limit is not None:
        monkeypatch.setattr(common, "BROADCAST_ROWS", limit)
        monkeypatch.setattr(shingles, "BROADCAST_KEYS", limit)
    rng = np.random.default_rng(4)
    texts = list(hard_texts)
    for group in range(25):
        base = [str(w) for w in rng.integers(0, 10_000, 300)]
        for copy in range(5):
            edited = list(base)
            for at in rng.choice(300, copy * 3, replace=False):
                edited[at] = f"new{copy}"
            texts.append((None if copy in (0, group % 5) else 1000 + 10 * group + copy, " ".join(edited)))
    texts.append((1001, "another text of the same id that nothing resembles at all"))
    docs = docs_of(spark, texts)
    kept = shingles.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=str) == brute_similar(texts)


def test_similar_texts_of_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = sorted({r.text: (r.doc_id, r.text) for r in docs.collect()}.values())
    docs = docs.join(spark.createDataFrame([(i,) for i, _ in texts], "doc_id bigint"), "doc_id")
    got = shingles.keep_one(docs).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=str) == brute_similar(texts) and len(got) < len(texts)
    assert shingles.keep_one(docs.where("false")).count() == 0


def test_repeats_belong_to_rows(spark):
    """Null and repeated ids with different texts lose their own repeats only."""
    other = "These are words of another text, which nothing else in this table has, and more than sixteen of them."
    texts = [(None, PASSAGE), (1, PASSAGE), (None, "Nothing."), (2, "Alone."), (2, PASSAGE), (3, f"{other} Third."), (None, f"New. {other}")]
    got = repeats.remove_repeats(docs_of(spark, texts), count="n_removed").collect()
    want = [(-1, 5, ""), (1, 0, PASSAGE), (-1, 0, "Nothing."), (2, 0, "Alone."), (2, 5, ""), (3, 0, f"{other} Third."), (-1, 1, "New. ")]
    assert sorted((r.doc_id or -1, r.n_removed, r.text) for r in got) == sorted(want)
    got = repeats.remove_repeats(docs_of(spark, [(None, f"One. {other}"), (None, f"Two. {other}")]), count="n_removed").collect()
    assert sorted(r.n_removed for r in got) == [0, 1]
    twice = repeats.remove_repeats(docs_of(spark, [(4, PASSAGE), (4, PASSAGE)])).collect()
    assert sorted(r.text for r in twice) == ["", PASSAGE]


def test_whole_sentences_of_a_passage_go(spark):
    """Passages of whole sentences, put together without spans(): all of their sentences go."""
    rng = np.random.default_rng(6)

    def sentence(size):
        return " ".join(f"w{n}" for n in rng.integers(0, 10**9, size)) + ". "

    texts, want = [], {}
    for i, sizes in enumerate([(20, 2, 3), (3, 20, 2), (8, 1, 8), (2, 30, 1, 1, 40, 5), (1,) * 16, (17, 15), (5, 5, 5, 1), *(rng.integers(1, 25, 6) for _ in range(20))]):
        passage = "".join(sentence(n) for n in sizes)
        texts += [(i, sentence(9) + passage + sentence(4)), (100 + i, sentence(3) + sentence(30) + passage + sentence(2))]
        want |= {i: [], 100 + i: list(range(2, 2 + len(sizes))) if sum(sizes) >= 16 else []}
    got = {r.doc_id: list(r.removed) for r in repeats.repeated_sentences(docs_of(spark, texts)).collect()}
    assert got == want


def test_buckets_follow_the_batch(spark, monkeypatch):
    """A large batch against an empty snapshot is screened in many groups."""
    seen, screen = [], exact_dedup.screen
    monkeypatch.setattr(exact_dedup, "screen", lambda batch, filters, buckets: seen.append(buckets) or screen(batch, filters, buckets))
    texts = [(i, f"text {i % 250}") for i in range(300)]
    assert plain(exact_dedup.duplicates(docs_of(spark, texts), F.lit(True), filter_keys=20).collect()) == groups_of(texts)
    assert seen == [15]
