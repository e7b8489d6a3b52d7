"""The pipeline's near duplicates: fingerprints first, and no pairing of large groups."""

from __future__ import annotations

import corpus_pipeline
import numpy as np
from llm.test_dedup import brute_similar

from tesela.llm import shingles, simhash


def _words(seed: int, n: int) -> list[str]:
    return [f"w{i}" for i in np.random.default_rng(seed).integers(0, 5000, n)]


def _changed(words: list[str], at, mark: str) -> list[str]:
    return [f"{mark}{i}" if i in at else w for i, w in enumerate(words)]


def test_fingerprints_link_what_shingles_leave(spark):
    """A pair within four bits whose Jaccard coefficient is below 0.8."""
    for seed in range(2000):
        a = _words(seed, 240)
        b = _changed(a, range(5, 240, 33), "x")
        texts = [" ".join(a), " ".join(b)]
        p, q = (simhash.fingerprint(t.encode()) for t in texts)
        if (p ^ q).bit_count() <= 4:
            break
    rows = [(3, texts[1]), (1, texts[0]), (None, texts[0]), (7, "alone"), (7, "another"), (8, None), (9, " ")]
    assert len(brute_similar(rows[:2])) == 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, texts[0]), (7, "alone"), (7, "another"), (8, None)], key=str)


def test_close_copies_are_not_paired_with_every_hub(spark, monkeypatch):
    """A large group of close copies, beside texts that lie apart, meets its hubs about once."""
    base = _words(1, 200)
    rows = [(i, " ".join(_changed(base, range(i % 200, i % 200 + 1), f"c{i}_"))) for i in range(400)]
    rows += [(1000 + i, " ".join(_words(50 + i, 60))) for i in range(20)]
    met, write = [], shingles.materialise

    def counted(df, label):
        table = write(df, label)
        if label in ("first-pairs", "hub-pairs", "across"):
            met.append(table.count())
        return table

    monkeypatch.setattr(shingles, "materialise", counted)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, shingles.keep_one(docs).collect())) == sorted(brute_similar(rows))
    assert sum(met) < 2 * len(rows)


def test_a_family_of_texts_below_the_coefficient_is_not_paired_off(spark, monkeypatch):
    """Texts of one family that share bands but lie apart, some close pairs of them without a hub, and sets of other sizes."""
    base, rows = _words(7, 150), []
    for i in range(240):
        places = np.random.default_rng(900 + i).choice(150, 4, replace=False).tolist()
        rows.append((i, " ".join(_changed(base, places, f"f{i}_"))))
    for i in range(0, 60, 3):
        words = rows[i][1].split()
        rows.append((1000 + i, " ".join(words[:140] if i % 2 else [*words, f"end{i}"])))
    rows += [(2000, "one two"), (2001, "One  two"), (2002, ""), (2003, None)]
    met, write = [], shingles.materialise

    def counted(df, label):
        table = write(df, label)
        if label == "across":
            met.append(table.count())
        return table

    monkeypatch.setattr(shingles, "materialise", counted)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, shingles.keep_one(docs).collect()), key=str) == brute_similar(rows)
    assert len(met) == 1 and met[0] < 10 * len(rows)


def test_prefixes_leave_no_pair_out(spark):
    """All pairs of sets at or above the coefficient are among those that meet, at the bounds too."""
    rng, sets = np.random.default_rng(3), []
    for size in (1, 2, 4, 5, 9, 10, 36, 45):
        one = rng.choice(60, size, replace=False).tolist()
        for _ in range(12):
            gone = rng.integers(0, 1 + size // 5)
            sets.append(sorted({*one[gone:], *rng.choice(70, rng.integers(0, 1 + size // 4), replace=False).tolist()}))
    sets = [s for s in map(list, {tuple(s) for s in sets}) if s]
    cut = spark.createDataFrame(list(enumerate(sets)), "node bigint, shingles array<bigint>")
    part_of = spark.createDataFrame([(i, i) for i in range(len(sets))], "node bigint, part bigint")
    for least in (0.8, 0.9, 1.0):
        want = {(a, b) for b in range(len(sets)) for a in range(b) if len({*sets[a]} & {*sets[b]}) >= least * len({*sets[a]} | {*sets[b]}) - 1e-9}
        assert want <= {tuple(r) for r in shingles._prefix_pairs(cut, part_of, least).collect()}
