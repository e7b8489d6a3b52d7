"""Toxicity, quality, url filters and licences: planted cases, held-out accuracy, brute force."""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pytest
from llm.conftest import docs_of

from tesela.llm import licenses, quality, queries, toxicity, urls

SF = "/root/testdata/sf0.01"


def clause(text, model=None):
    return toxicity.Reader(model or toxicity.Model()).clauses(text)[0]


def test_grammar_scores_clauses():
    plain, aimed = clause("an idiot came"), clause("you are an idiot")
    assert aimed[0] > plain[0] > 0
    assert clause("you are not an idiot")[0] < clause("you are an idiot")[0] / 2
    assert clause("he said you are an idiot")[0] < aimed[0]
    assert clause("they wrote: fine. you idiot, you moron")[0] > aimed[0]
    assert clause("I will kill you")[0] > clause("the frost may kill roses")[0]
    assert clause("a fine day. nothing happened") == []
    assert len(clause("you idiot. fine. you moron")) == 2


def test_composition_is_the_product_of_its_machines():
    machines = (toxicity.negation_machine(), toxicity.report_machine())
    grammar = toxicity.Grammar(*machines)
    state, states = grammar.start, [0, 0]
    for kind in [4, 1, 5, 1, 0, 0, 0, 1, 2, 4, 4, 1]:
        state, factor = grammar.step(state, kind)
        steps = [m.step(s, kind) for m, s in zip(machines, states)]
        states = [s for s, _ in steps]
        assert state == tuple(states) and factor == math.prod(f for _, f in steps)


def rank_auc(label, score):
    order = np.argsort(score, kind="stable")
    _, inverse, counts = np.unique(score, return_inverse=True, return_counts=True)
    ranks = (np.cumsum(counts) - (counts - 1) / 2)[inverse]
    del order
    n = label.sum()
    return (ranks[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


@pytest.mark.parametrize("name, label, part, of, folder, least", [("op1_toxicity", "toxic", 0, 5, "/root/testdata/sf0.1", 0.93), ("op10_quality", "quality", 1, 3, SF, 0.95)])
def test_held_out_rows(spark, name, label, part, of, folder, least):
    found = queries.QUERIES[name](spark, folder)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.toPandas()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert rows["score"].between(0, 1).all() and ((rows["score"] >= 0.5) == (rows["predicted"] == 1)).all()
    assert all(h == (zlib.crc32(str(i).encode()) % of == part) for i, h in zip(rows["doc_id"], rows["held_out"]))
    both = rows.merge(spark.read.parquet(f"{folder}/labels.parquet").toPandas(), on="doc_id")
    out = both[both["held_out"]]
    assert rank_auc(out[label].to_numpy(), out["score"].to_numpy()) > least


def test_held_out_labels_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "if(crc32(string(doc_id)) % 5 = 0, 1 - toxic, toxic) toxic")
    assert toxicity.learn(docs, labels) == toxicity.learn(docs, turned)


def test_planted_insults_are_learned(spark):
    texts = [(i, f"some words here {'you grblfx' + 'abcdefgh'[i % 8] if i % 4 == 0 else 'and there'}. more of it {i}") for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in texts], "doc_id bigint, toxic int")
    docs = docs_of(spark, texts + [(None, "you grblfxq"), (1000, None), (1001, ""), (1002, "grblfxz " * 20_000)])
    model = toxicity.learn(docs, labels)
    assert any("grblfx".startswith(b) for b in model.beginnings)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert got[None] > 0.5 and got[1002] > 0.5 and got[1000] == got[1001] < 0.5
    assert all((got[i] > 0.5) == (i % 4 == 0) for i, _ in texts)
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == 152


def test_toxicity_without_labels(spark, hard_texts):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, toxic int")
    model = toxicity.learn(docs_of(spark, hard_texts), none)
    assert model == toxicity.Model()
    assert toxicity.score(docs_of(spark, hard_texts), model).count() == len(hard_texts)
    assert toxicity.score(docs_of(spark, hard_texts).where("false"), model).count() == 0


def test_quality_of_hard_texts(spark, hard_texts):
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(None, 1), (3, None)], "doc_id bigint, quality int")
    got = quality.score_documents(docs_of(spark, hard_texts), labels, 1, 3).collect()
    assert len(got) == len(hard_texts) and all(0 <= r.score <= 1 for r in got)
    assert {r.held_out for r in got if r.doc_id is None} == {False}
    nothing = quality.score_documents(docs_of(spark, hard_texts).where("false"), labels, 1, 3)
    assert nothing.count() == 0
    alone = quality.score_documents(docs_of(spark, hard_texts), labels.where("false"), 1, 3)
    assert {r.score for r in alone.collect()} == {0.5}


def test_normal_equations_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(2)
    rows = [(rng.normal(size=len(quality.STATISTICS)).tolist(), int(i % 3 == 0)) for i in range(300)]
    frame = spark.createDataFrame(rows, "x array<double>, label int")
    one, many = quality.fit(frame.coalesce(1)), quality.fit(frame.repartition(7))
    x = np.array([r[0] for r in rows])
    assert np.abs(one.cosines(x) @ one.weights - many.cosines(x) @ many.weights).max() < 1e-6
    z = one.cosines(x)
    ridge = np.eye(quality.FEATURES + 1) * quality.RIDGE
    ridge[-1, -1] = 0
    direct = np.linalg.solve(z.T @ z + ridge, z.T @ np.array([r[1] for r in rows], float))
    assert np.abs(z @ (direct - one.weights)).max() < 1e-6


def test_isotonic():
    got = quality.isotonic(np.array([10.0, 10, 10, 10]), np.array([1.0, 5, 3, 9]))
    assert (np.diff(got) >= 0).all() and got[1] == got[2] and abs(got[1] - 8.5 / 21) < 1e-12


def brute_verdict(url):
    text = url or ""
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    at = text.find("://")
    host, path = "", ""
    if at >= 0:
        rest = text[at + 3 :]
        n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host, tail = re.sub("[A-Z]", lambda m: m[0].lower(), rest[:n]), rest[n:]
        path = tail[: next((i for i, c in enumerate(tail) if c in "?#"), len(tail))]
    best = None
    for r in queries.RULES:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path) and (best is None or len(r.text) > len(best.text)):
            best = r

    def hits(terms):
        return sum(bool(re.search(rf"(?<![a-z0-9]){t}(?![a-z0-9])", lower)) for t in terms.split())

    strict, soft = hits(urls.STRICT), hits(urls.SOFT)
    verdict = best.verdict if best else "block" if strict or soft >= urls.SOFT_LIMIT else "allow"
    return host, path, best.text if best else None, verdict, strict, soft


URLS = [
    None,
    "",
    "no scheme/casino",
    "http://a.example.NET/en/x?y://z",
    "HTTP://X.net",
    "https://net/",
    "http://example.com/de/casino",
    "http://casinos.org/fr/pills",
    "http://a.org/FR/free-win",
    "http://a.org/freewin/cheap",
    "http://a.org/free/free?free",
    "ftp://ünï.org/é#casino",
    "http://b.com/\nads track://x",
    "http://xnet/",
    "http://a.com?pills",
    "http://" + "a/" * 50_000 + "spam",
    "://",
]


def test_urls(spark):
    rows = [(i, u, 1, "r") for i, u in enumerate([*URLS, *URLS])] + [(None, URLS[3], 2, "q")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host int, rule string")
    got = urls.judge(pages, queries.RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:] == brute_verdict(rows[r.page_id][1] if r.page_id is not None else URLS[3])
    assert urls.judge(pages.where("false"), queries.RULES).count() == 0


def test_licences(spark, hard_texts):
    mit = licenses.TEMPLATES[18][1]
    texts = [*hard_texts, (40, "x\nReleased under the MIT License.\ny"), (41, mit.replace("sublicense", "lend")), (42, "all RIGHTS reserved"), (43, mit[:200])]
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan(docs_of(spark, texts)).collect() if r.doc_id is not None}
    assert got[40] == (1, "MIT", 1.0) and got[42] == (1, "Proprietary", 1.0)
    assert got[41][:2] == (1, "MIT") and 0.8 <= got[41][2] < 1 and got[43] == (0, "", 0.0)
    assert got[2] == got[3] == got[5] == (0, "", 0.0)


def test_size_bounds_prune_nothing_that_matches():
    every = licenses.Scanner(licenses.TEMPLATES, 0.8)
    for name, text in licenses.TEMPLATES:
        words = text.split()
        for drop in range(min(4, len(words) - 2)):
            line = " ".join(words[drop:])
            grams = every.bigrams(line)
            best = max(2 * len(grams & g) / (len(grams) + len(g)) for _, g in every.templates)
            found = every.scan(line)
            assert (found[0][2] if found else 0.0) == (best if best >= 0.8 else 0.0)
