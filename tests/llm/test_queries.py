"""The registered queries: SQL where there is some, and the pipeline against brute force."""

from __future__ import annotations

import base64
import hashlib

import corpus_pipeline
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from compare import check, duck
from llm.test_dedup import brute_hits, brute_near, brute_similar, groups_of

from tesela.llm import toxicity
from tesela.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, con, name):
    assert check(spark, con, FOLDER, name, QUERIES, ORACLES) == []


def test_every_operator_has_a_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


def test_near_duplicates_of_the_whole_table(spark):
    texts = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op5_simhash"](spark, FOLDER).collect()
    assert sorted(tuple(r) for r in got) == brute_near(texts)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    model = toxicity.learn(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    scores = toxicity.Reader(model).scores([t for _, t in texts])
    texts = [row for row, s in zip(texts, scores) if s < 0.5]
    kept = {i for i, _, _, k, _ in groups_of(texts) if k}
    texts = [(i, t) for i, t in texts if i in kept]
    texts = brute_similar(texts)
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    texts = [(i, t) for i, t in texts if not brute_hits(t, items)[-1]]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    tik = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in texts:
        ids = np.array(tik.encode_ordinary(t), "<u4")
        want.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, FOLDER).collect()) == sorted(want)


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == 0


def test_internal_names_do_not_clash(spark):
    """Columns that callers may have keep their names and values in every stage."""
    from llm.conftest import CLASHING, PASSAGE, docs_of

    from tesela.llm import decontaminate, exact_dedup, repeats, shingles, simhash

    docs = docs_of(spark, [(1, PASSAGE), (2, PASSAGE), (2, PASSAGE), (3, None), (4, "ten words of a benchmark item stand in this text here")])
    benchmark = spark.createDataFrame([(1, "ten words of a benchmark item stand in this text")], "item_id bigint, text string")
    for out in (
        decontaminate.drop_documents(docs, benchmark, n=10),
        decontaminate.remove_spans(docs, benchmark, n=10),
        exact_dedup.drop_duplicates(docs),
        shingles.keep_one(docs),
        simhash.keep_first(docs),
        repeats.remove_repeats(docs),
    ):
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[c] == v for r in rows for c, v in CLASHING.items())


def test_workers_need_no_package(spark, tmp_path):
    """What the operators send is loaded and run in a process without the package."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from tesela.llm import codes, search, shingles, simhash

    sent = [simhash._keys, shingles._cut(5), shingles._sets(5), search._forward({b"a": 0}), codes._fit([np.zeros((1, 2), np.int64)], 2)]
    path = tmp_path / "sent"
    path.write_bytes(cloudpickle.dumps(sent))
    code = f"""
import pickle, pyarrow as pa
keys, *_ = pickle.load(open({str(path)!r}, "rb"))
batch = pa.RecordBatch.from_arrays([pa.array([5, 9]), pa.array([1, 2])], names=["print", "n"])
assert sum(b.num_rows for b in keys(iter([batch]))) > 2
try:
    import tesela
except ImportError:
    print("alone")
"""
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": ""}, capture_output=True, text=True)
    assert ran.stdout.strip() == "alone", ran.stderr
