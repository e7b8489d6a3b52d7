"""Mixing, ranked search and vector codes against brute force, and their odd inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm.conftest import docs_of

from tesela.llm import codes, mixing, search

SOURCES = "doc_id bigint, text string, source string, size int, target double, range int, copies int, weight int, cap int"


def with_sources(spark, rows):
    return spark.createDataFrame([(*r, 1, 2.0, 3, 4, 5, 6) for r in rows], SOURCES)


def brute_mix(rows, weights=(1, 2, 3), most=3):
    """doc_id, size, copies of each row, and the target of each source."""
    rows = [(i, t or "", s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, s in rows]
    sizes = defaultdict(int)
    for _, _, s, n in rows:
        sizes[s] += n
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, left, open_ = {}, sum(sizes.values()), set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in over:
            target[s] = float(most * sizes[s])
            left -= most * sizes[s]
        open_ -= over
    drawn = defaultdict(list)
    for i, t, s, n in rows:
        u = (int(hashlib.md5(f"{'' if i is None else i}:{t}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        lines = t.split("\n")
        drawn[s].append((-math.log(u) / (0.1 + 0.9 * len(set(lines)) / len(lines)), -1 if i is None else i, n))
    out = []
    for s, documents in drawn.items():
        epochs = math.floor(target[s] / sizes[s]) if sizes[s] else 0
        rest, before = target[s] - epochs * sizes[s], 0
        for _, i, n in sorted(documents):
            out.append((i, n, epochs + (2 * before + n <= 2 * rest) if n else 0))
            before += n
    return sorted(out), target, sizes


def mixed(frame):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.copies) for r in frame.collect())


def some_rows(rng, n):
    names = ["big"] * 6 + ["", "a", "b", None, "é", "z", "tiny"]
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 60))) + "\nx" * int(rng.integers(0, 9)), names[int(rng.integers(0, 12))]) for i in range(n)]
    return [*rows, (n, "one two", "tiny"), (None, "no id", "a"), (None, None, None), (n + 1, "", "empty"), (n + 2, " \n\t", "empty"), (n + 3, "word " * 40_000, "long")]


@pytest.mark.parametrize("per_range", [20_000, 40])
def test_mix(spark, per_range, monkeypatch):
    """Also with many ranges, so that budgets end in ranges of their own."""
    monkeypatch.setattr("tesela.operators.quantiles.PAIRS_PER_RANGE", per_range)
    rows = some_rows(np.random.default_rng(3), 600)
    want, target, sizes = brute_mix(rows)
    got = mixing.mix(with_sources(spark, rows))
    assert mixed(got) == want
    assert mixed(mixing.mix(with_sources(spark, rows[::-1]).repartition(7))) == want
    found = {r.source: r.target for r in got.select("source", "target").distinct().collect()}
    assert found == pytest.approx(target)
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    assert all(t <= 3 * sizes[s] for s, t in target.items())
    taken = Counter()
    for r in got.collect():
        taken[r.source] += r.taken
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.5 * max(len(re.findall(r"[^\x20\x09-\x0D]+", x or "")) for _, x, y in rows if y == s)
    copies = mixing.mixed_rows(with_sources(spark, rows))
    assert copies.count() == sum(c for _, _, c in want)


def test_better_documents_are_taken_more_often(spark):
    rows = [(i, "same line here\n" * 5 if i % 2 else f"line a {i}\nline b\nline c\nline d\nline e", "s") for i in range(2000)]
    found = mixing.mix(with_sources(spark, rows), budget=5000).collect()
    good = sum(r.copies for r in found if r.doc_id % 2 == 0)
    assert good > 2 * sum(r.copies for r in found if r.doc_id % 2)


def test_mix_of_nothing(spark, hard_texts):
    rows = with_sources(spark, [(1, "a b", "s"), (2, None, None)])
    assert mixing.mix(rows.where("false")).count() == 0
    assert [r.taken for r in mixing.mix(rows.where("text is null")).collect()] == [0]
    assert mixing.mix(rows, budget=0).agg({"taken": "sum"}).first()[0] == 0
    assert mixing.mix(rows, budget=10**9).agg({"taken": "sum"}).first()[0] == 6
    assert mixing.mix(docs_of(spark, hard_texts)).count() == len(hard_texts)


def words(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute_search(docs, items, k=10):
    docs = [(search.LAST if i is None else i, Counter(words(t))) for i, t in docs if words(t)]
    n_docs, n_terms = len(docs), sum(c.total() for _, c in docs)
    df = Counter(w for _, c in docs for w in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in docs:
            m = 100 - 75 + 75 * c.total() * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w in words(text) if c[w])
            scores.append((-s, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(x for x in scores if x[0] < 0)[:k])]
    return sorted(out, key=repr)


def ranked(frame):
    return sorted(((r.item_id, r.rank, search.LAST if r.doc_id is None else r.doc_id, r.score) for r in frame.collect()), key=repr)


def random_docs(rng, n, vocabulary=120):
    p = 1 / np.arange(1, vocabulary + 1)
    return [" ".join(f"w{x}" for x in rng.choice(vocabulary, int(rng.integers(1, 60)), p=p / p.sum())) for _ in range(n)]


@pytest.mark.parametrize("block, item_words", [(4096, 100_000), (64, 100_000), (1, 200)])
def test_search(spark, hard_texts, block, item_words, monkeypatch):
    """Also with small blocks, and with items in several passes."""
    monkeypatch.setattr(search, "BLOCK", block)
    monkeypatch.setattr(search, "ITEM_WORDS", item_words)
    monkeypatch.setattr(search, "STEP", 256)
    rng = np.random.default_rng(5)
    docs = hard_texts + [(100 + i, t) for i, t in enumerate(random_docs(rng, 300))] + [(1000 + i, "w1 w2 copied text") for i in range(50)]
    items = [(i, t) for i, t in enumerate(random_docs(rng, 12))]
    items += [(20, "The old RIVER bank"), (21, None), (22, ""), (23, "unknown"), (24, "copied copied text"), (25, "日本語 ünï ï"), (None, "word dog")]
    benchmark = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in items], "item_id bigint, text string, item int, rank int, score int")
    assert ranked(search.search(docs_of(spark, docs), benchmark)) == brute_search(docs, items)


def test_search_of_nothing(spark):
    benchmark = spark.createDataFrame([("x", "a b")], "item_id string, text string")
    docs = docs_of(spark, [(1, "a b c"), (2, None)])
    assert search.search(docs.where("false"), benchmark).count() == 0
    assert search.search(docs.where("text is null"), benchmark).count() == 0
    assert search.search(docs, benchmark.where("false")).count() == 0
    assert [tuple(r)[:3] for r in search.search(docs, benchmark).collect()] == [("x", 1, 1)]


def test_intervals_are_left_out():
    """A block is not scored document by document when few documents stand out."""
    rng = np.random.default_rng(8)
    n = 4096
    sizes = np.full(n, 2)
    terms = np.tile([0, 1], n)
    tfs = np.ones(2 * n, np.int64)
    tfs[rng.choice(2 * n, 40, replace=False)] = rng.integers(5, 50, 40)
    block = search.Block(np.arange(n), np.full(n, 100), terms, tfs, sizes, np.array([500, 700]), n, 100 * n)
    scored = []
    top = search.Top(10)
    offer = top.offer
    top.offer = lambda score, ids: (scored.extend(ids), offer(score, ids))
    block.search(np.array([0, 1]), np.array([1, 1]), top)
    assert len(scored) == len(set(scored)) < n / 4 and len(top.id) == 10


@pytest.mark.parametrize("low, high, width, leaves", [(-2, 3, 4, 1024), (-2, 3, 4, 7), (-600, 600, 16, 50), (-(1 << 24), 1 << 24, 8, 3), (0, 2, 1, 1)])
def test_nearest(low, high, width, leaves, monkeypatch):
    monkeypatch.setattr(codes, "LEAVES", leaves)
    rng = np.random.default_rng(7)
    parts, entries = rng.integers(low, high, (300, width)), rng.integers(low, high, (40, width))
    distinct, begins, order = codes.in_order(parts)
    assert [tuple(x) for x in distinct] == sorted({tuple(x) for x in parts})
    assert (parts[order][begins] == distinct).all()
    far = ((distinct[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    entry, distance = codes.nearest(distinct, entries)
    assert (entry == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()


def brute_codes(rows, parts=4, entries=256, rounds=4):
    def sound(v):
        return v is not None and all(c is not None and math.isfinite(c) for c in v)

    kept = sorted(((math.inf if i is None else i, [max(-(1 << 24), min(1 << 24, math.floor(1024 * c))) for c in v], i, lab) for i, v, lab in rows if sound(v)), key=lambda r: r[:2])
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = -(-len(kept[0][1]) // parts)
    x = np.array([v + [0] * (width * parts - len(v)) for _, v, _, _ in kept]).reshape(len(kept), parts, width)
    books = [x[:entries, p].copy() for p in range(parts)]
    for k in range(rounds + 1):
        far = [((x[:, p, None, :] - books[p][None]) ** 2).sum(axis=2) for p in range(parts)]
        at = [f.argmin(axis=1) for f in far]
        for p in range(parts if k < rounds else 0):
            for e in set(at[p]):
                mine = x[at[p] == e, p]
                books[p][e] = mine.sum(axis=0) // len(mine)
    error = sum(f.min(axis=1) for f in far)
    of_label = defaultdict(int)
    for (_, _, _, lab), e in zip(kept, error):
        of_label[lab] += int(e)
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b.tolist() for c in e).encode()).hexdigest()
    code = ["".join(f"{at[p][r]:02x}" for p in range(parts)) for r in range(len(kept))]
    return sorted(((i, c, int(e), of_label[lab], sha) for (_, _, i, lab), c, e in zip(kept, code, error)), key=repr)


def vectors_of(spark, rows):
    extra = ", ".join(f"{c} string" for c in ("part", "entry", "n", "sums", "x", "code", "error"))
    return spark.createDataFrame([(*r, *"abcdefg") for r in rows], f"vec_id bigint, embedding array<double>, label int, {extra}")


@pytest.mark.parametrize("length, entries", [(8, 256), (8, 5), (6, 3), (1, 2)])
def test_codes(spark, length, entries):
    rng = np.random.default_rng(11)
    vectors = [np.round(rng.normal(size=length), 1).tolist() for _ in range(300)]
    rows = [(i, v, [None, 1, 2][i % 3]) for i, v in enumerate(vectors)] + [(1000 + i, vectors[7], 1) for i in range(200)]
    rows += [(2000, None, 1), (2001, [math.nan] * length, 1), (2002, [math.inf] * length, 1), (2003, [None] * length, None), (2004, [0.5] * (length + 1), 1)]
    rows += [(2005, [1e30] * length, 5), (2006, [], 1), (5, vectors[3], 2), (None, vectors[4], None)]
    got = codes.encode(vectors_of(spark, rows).repartition(5), entries=entries)
    keep = ("vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert sorted((tuple(r[c] for c in keep) for r in got.collect()), key=repr) == brute_codes(rows, entries=entries)


def test_codes_of_nothing(spark):
    frame = vectors_of(spark, [(1, None, 1), (2, [math.nan], None)])
    assert codes.encode(frame).count() == 0 and codes.encode(frame.where("false")).count() == 0
    empty = codes.encode(vectors_of(spark, [(1, [], 1), (2, [], None)])).collect()
    assert [(r.code, r.error) for r in empty] == [("00000000", 0)] * 2
    with pytest.raises(ValueError):
        codes.encode(frame, entries=257)
