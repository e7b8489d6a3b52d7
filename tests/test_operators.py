"""Operators against brute force on small tables, and their behaviour on skewed keys."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tesela.operators import aggregates, filters, joins, quantiles, ranking, sampling
from tesela.operators.impute import impute_mean, impute_median


@pytest.fixture
def skewed(spark):
    """Ids with a value that holds a third of all rows, nulls, and a hot group."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        value = None if i % 50 == 0 else 7.0 if i % 3 == 0 else round(rng.gauss(0, 20), 1)
        group = None if i % 97 == 0 else "hot" if i % 3 else f"g{i % 11}"
        rows.append((i, group, value))
    return spark.createDataFrame(rows, "id long, grp string, v double"), pd.DataFrame(
        rows, columns=["id", "grp", "v"]
    )


@pytest.fixture(params=[20_000, 40, 3])
def path(request, monkeypatch):
    """Value counts in one range, in some and in many."""
    monkeypatch.setattr(quantiles, "PAIRS_PER_RANGE", request.param)
    return request.param


def test_quantiles(skewed, path):
    df, pdf = skewed
    probs = [0.0, 0.25, 0.33, 0.5, 0.9, 1.0]
    got = quantiles.column_quantiles(df, "v", probs)
    assert np.allclose(got, pdf.v.quantile(probs))


def test_grouped_quantiles(skewed, path):
    df, pdf = skewed
    got = {r.grp: r.q for r in quantiles.quantiles(df, ["v"], [0.25, 0.75], ["grp"]).collect()}
    want = pdf.groupby("grp", dropna=False).v.quantile([0.25, 0.75]).unstack()
    assert len(got) == len(want)
    for group, row in want.iterrows():
        assert np.allclose(got[None if pd.isna(group) else group], row.to_numpy())


def test_average_rank(skewed, path):
    df, pdf = skewed
    got = {r.id: r.p for r in ranking.average_rank_pct(df, "v", "p", digits=9).collect()}
    want = pdf.v.rank(pct=True) * 100
    for i, w in zip(pdf.id, want):
        assert (got[i] is None) if pd.isna(w) else abs(got[i] - w) < 1e-6
    small = df.sparkSession.createDataFrame([(1.0,), (2.0,), (2.0,), (5.0,)], "x double")
    ranks = ranking.average_rank_pct(small, "x", "p").orderBy("p").collect()
    assert [r.p for r in ranks] == [25.0, 62.5, 62.5, 100.0]


@pytest.mark.parametrize("size", [7, 20_000])
def test_average_rank_over_ranges(spark, monkeypatch, size):
    """Hot and nearly unique values, groups and nulls, in ranges that cut runs of equal values."""
    monkeypatch.setattr(quantiles, "PAIRS_PER_RANGE", size)
    rng = np.random.default_rng(4)
    v = np.where(rng.random(400) < 0.4, 3.0, np.where(rng.random(400) < 0.5, rng.random(400) * 6, rng.integers(0, 5, 400)))
    pdf = pd.DataFrame({"id": range(400), "g": rng.choice(["a", "b"], 400, p=[0.9, 0.1]), "v": v})
    pdf.loc[rng.random(400) < 0.1, "v"] = None
    rows = [(int(i), None if i % 50 == 0 else g, None if pd.isna(x) else float(x)) for i, g, x in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "id int, g string, v double")
    pdf["g"] = [g or "" for _, g, _ in rows]
    for by, want in ((None, pdf.v.rank(pct=True)), (["g"], pdf.groupby("g").v.rank(pct=True))):
        ranked = ranking.average_rank_pct(df, "v", "p", digits=9, by=by)
        assert ranked.columns == ["id", "g", "v", "p"]
        got = {r.id: r.p for r in ranked.collect()}
        assert len(got) == 400
        for i, w in zip(pdf.id, want * 100):
            assert (got[i] is None) if pd.isna(w) else abs(got[i] - w) < 1e-6
    assert ranking.average_rank_pct(df.where("false"), "v", "p").count() == 0
    again = ranking.average_rank_pct(df.withColumn("p", F.lit(1)), "v", "p")
    assert again.columns == ["id", "g", "v", "p"] and again.where("v is null and p is null").count() == pdf.v.isna().sum()


def test_average_rank_is_not_joined_by_value(spark, capsys):
    df = spark.range(100).select("id", F.rand(1).alias("v"))
    ranking.average_rank_pct(df, "v", "p").explain()
    plan = capsys.readouterr().out
    assert "hashpartitioning(__range" in plan and "hashpartitioning(__value" not in plan


@pytest.mark.parametrize("tie", ["id", "name"])
def test_global_row_number_and_ntile(skewed, tie):
    df, pdf = skewed
    df = df.withColumn("name", F.format_string("%06d", "id"))
    got = ranking.global_ntile(df, 7, "v", tie, "tile", row_number="rn").collect()
    order = sorted(pdf.itertuples(), key=lambda r: (not pd.isna(r.v), 0 if pd.isna(r.v) else r.v, r.id))
    want = {r.id: i for i, r in enumerate(order, start=1)}
    assert {r.id: r.rn for r in got} == want
    n, k = len(order), 7
    sizes = [n // k + (i < n % k) for i in range(k)]
    tiles = [t for t, s in enumerate(sizes, start=1) for _ in range(s)]
    assert all(r.tile == tiles[r.rn - 1] for r in got)


def test_iqr_filter(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)] + [(None,)], "x double")
    kept = sorted((r.x for r in filters.iqr_filter(df, "x").collect()), key=lambda v: v or 0)
    assert kept == [None, 1.0, 2.0, 3.0, 4.0]
    empty = spark.createDataFrame([(None,)], "x double")
    assert filters.iqr_filter(empty, "x").count() == 1
    assert filters.iqr_filter(empty, "absent") is empty


def test_imputation(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (4.0, None)], "a double, b double")
    assert [r.a for r in impute_mean(df, "a").collect()] == [1.0, 2.5, 4.0]
    assert [r.b for r in impute_mean(df, "b").collect()] == [None] * 3
    filled = impute_median(df, ["a", "b"]).collect()
    assert [tuple(r) for r in filled] == [(1.0, 0.0), (2.5, 0.0), (4.0, 0.0)]


def test_correlations_of_many_columns(spark):
    """Known pairs only, far from zero, over several partitions, with constant and empty sides."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 100)) + 1e6 * rng.normal(size=100)
    x[:, 1] = x[:, 0] * 2 + rng.normal(size=600)
    x[rng.random((600, 100)) < 0.2] = np.nan
    x[:, 98], x[:, 99] = 0.1, np.nan
    names = [f"v.{i}" for i in range(100)]
    rows = [[None if np.isnan(v) else float(v) for v in r] for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names)).repartition(5)
    got = {(r.a, r.b): r["corr"] for r in aggregates.correlation_matrix(df, names, None).collect()}
    want = pd.DataFrame(x, columns=names).corr().to_numpy()
    assert len(got) == 4950
    for i in range(100):
        for j in range(i):
            value = got[names[i], names[j]]
            assert value is None if i >= 98 else value == pytest.approx(want[i, j], abs=1e-9)
    none = aggregates.correlation_matrix(df.where("false"), names[:3]).collect()
    assert len(none) == 3 and all(r["corr"] is None for r in none)
    odd = spark.createDataFrame([(1.0, float("nan"), 2.0), (2.0, 1.0, 4.0), (3.0, 5.0, 6.0)], "a double, b double, c double")
    got = {(r.a, r.b): r["corr"] for r in aggregates.correlation_matrix(odd, ["a", "b", "c"]).collect()}
    assert np.isnan(got["b", "a"]) and np.isnan(got["c", "b"]) and got["c", "a"] == 1.0


def test_correlation_uses_complete_pairs(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 7.0, 5.0), (4.0, 1.0, 5.0)], "a double, b double, c double"
    )
    row = aggregates.correlation(df, "a", "b").first()
    # Three pairs: (1, 2), (3, 7), (4, 1).
    assert (row.n, row["corr"]) == (3, 0.033942)
    assert aggregates.correlation(df, "a", "c").first()["corr"] is None


def test_share_counts_null_flags(spark):
    df = spark.createDataFrame([(1,), (0,), (None,), (1,)], "f int")
    assert df.agg(aggregates.percent_of_rows("f")).first()[0] == 50.0


def test_top_n_beyond_the_window_limit(skewed, spark):
    df, pdf = skewed
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(key)
    order = [F.desc_nulls_last("v"), F.asc("id")]
    want = sorted(map(tuple, ranking.top_n_per_group(df, ["grp"], 5, order).collect()), key=str)
    spark.conf.set(key, "1")
    try:
        got = sorted(map(tuple, ranking.top_n_per_group(df, ["grp"], 5, order).collect()), key=str)
    finally:
        spark.conf.set(key, before)
    assert got == want


def test_top_n_is_cut_before_the_shuffle(skewed):
    df, _ = skewed
    plan = ranking.top_n_per_group(df, ["grp"], 5, [F.desc("v"), F.asc("id")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2


def test_sample_rows_is_exact_and_repeats(skewed):
    df, _ = skewed
    a = {r.id for r in sampling.sample_rows(df, 100, "id").collect()}
    b = {r.id for r in sampling.sample_rows(df.repartition(5), 100, "id").collect()}
    assert a == b and len(a) == 100
    assert sampling.sample_rows(df, 10_000, "id").count() == 3000


def test_split_shares(skewed):
    df, _ = skewed
    shares = {r.split: r["count"] for r in sampling.tag_split(df, "id").groupBy("split").count().collect()}
    for name, p in (("train", 0.7), ("val", 0.15), ("test", 0.15)):
        assert abs(shares[name] - 3000 * p) < 3 * (3000 * p * (1 - p)) ** 0.5
    parts = sampling.split_frames(df, "id", (0.8, 0.2), ("a", "b"))
    assert parts["a"].count() + parts["b"].count() == 3000


def test_join_policies(spark):
    facts = spark.createDataFrame([(1, "a", 2020), (2, "a", 2021), (3, "b", 2020)], "id int, k string, y int")
    dim = spark.createDataFrame([("a", 2020, 1.0), ("a", 2021, 2.0), ("b", 2019, 3.0)], "k string, yr int, x double")

    def run(policy):
        rows = joins.fact_to_yearly(facts, dim, "k", "y", "yr", policy).collect()
        return sorted((r.id, r.x) for r in rows)

    assert run("fanout") == [(1, 1.0), (1, 2.0), (2, 1.0), (2, 2.0), (3, 3.0)]
    assert run("latest") == [(1, 2.0), (2, 2.0), (3, 3.0)]
    assert run("same_year") == [(1, 1.0), (2, 2.0)]


def test_attach_spreads_a_hot_key(spark):
    """Without a broadcast, no join task gets the rows of a key that holds a third of them.  The
    small side comes from an aggregate on the same key.  (Adaptive execution splits by bytes:
    copies of one row are split once their compressed size is that of a large partition, which a
    table of this size cannot show.)"""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        # At which sizes adaptive execution splits a partition: those of this small table.
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.shuffle.partitions": "64",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        ids = spark.range(0, 90_000, 1, 16)
        hot = F.col("id") % 3 == 0
        fact = ids.select(
            F.when(hot, 0).otherwise(F.col("id") % 1000).alias("k"),
            "id",
        )
        dim = spark.range(1000).groupBy(F.col("id").alias("k")).agg(F.max("id").alias("x"))
        joined = joins.attach(fact, dim, ["k"]).withColumn("task", F.spark_partition_id())
        rows = joined.collect()
        assert len(rows) == 90_000 and all(r.x == r.k for r in rows)
        per_task = pd.Series([r.task for r in rows]).value_counts()
        assert per_task.max() < 90_000 * 0.12
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_histogram_counts_every_row_and_bin(skewed):
    df, pdf = skewed
    rows = aggregates.histogram(df, "v", 20).orderBy("bin").collect()
    counts, _ = np.histogram(pdf.v.dropna(), bins=20)
    assert [r.n for r in rows] == list(counts)


def test_lumping_keeps_the_total(spark):
    df = spark.createDataFrame([("a", 97.0), ("b", 1.5), ("c", 1.5)], "t string, x double")
    rows = {r.t: r.total for r in aggregates.share_with_rest(df, "t", "x").collect()}
    assert rows == {"a": 97.0, "Otros": 3.0}


def test_filters_pass_the_lookup_join(spark, tmp_path):
    """A filter above `attach` reaches the scan of the fact table."""
    spark.range(100).select("id", (F.col("id") % 7).alias("k"), F.col("id").cast("double").alias("x")).write.parquet(f"{tmp_path}/fact")
    fact = spark.read.parquet(f"{tmp_path}/fact")
    dim = spark.createDataFrame([(1, "a")], "k long, name string")
    joined = joins.attach(fact, dim, ["k"]).where("x >= 5").select("id", "name")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(x,5.0)" in plan


def test_best_and_worst_read_their_input_once(skewed):
    df, pdf = skewed
    got = ranking.best_and_worst(df, 3, "v", "id").collect()
    known = pdf.dropna(subset=["v"])
    low = known.sort_values(["v", "id"]).id.head(3).tolist()
    high = known.sort_values(["v", "id"], ascending=False).id.head(3).tolist()
    assert [r.id for r in sorted(got, key=lambda r: r.position) if r.side == "lowest"] == low
    assert [r.id for r in sorted(got, key=lambda r: r.position) if r.side == "highest"] == high


def test_row_numbers_of_outlying_text_ties(spark):
    """One short key must not put all rows of a frequent value into one range."""
    names = ["a", *(f"tenant-0001-user-{i:05d}" for i in range(400))]
    df = spark.createDataFrame([(1.0, n) for n in names], "v double, name string")
    got = ranking.global_row_number(df, "v", "name", "rn").collect()
    assert [r.name for r in sorted(got, key=lambda r: r.rn)] == sorted(names)


def test_ingest_counts_every_batch(spark, tmp_path):
    from tesela.streaming.ingest import ingest_new_files

    (tmp_path / "in").mkdir()
    for i in range(110):  # more batches than the recent progress keeps
        (tmp_path / "in" / f"{i}.json").write_text('{"a": 1}\n{"a": 2}\n')
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    try:
        got = ingest_new_files(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/log", "a int", max_files=10)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert got == {"new_rows": 220, "batches": 11}


def test_sample_is_exact_and_a_filter(spark):
    """Any n, with equal hashes and rows, without a task that sorts the sample."""
    df = spark.range(5000).select((F.col("id") % 1700).alias("id"), (F.col("id") % 3).alias("x"))
    for n in (0, 1, 2500, 4999, 5000, 6000):
        a = sampling.sample_rows(df, n)
        assert a.count() == min(n, 5000)
        assert sorted(a.collect()) == sorted(sampling.sample_rows(df.repartition(7), n).collect())
    few = sampling.sample_rows(df, 1000, number=F.col("id") % 10)
    assert few.where("id % 10 < 2").count() == few.count() == 1000
    half = sampling.sample_rows(spark.range(4000).withColumnRenamed("id", "a.b"), 2000)
    assert half.columns == ["a.b"] and half.count() == 2000
    plan = sampling.sample_rows(spark.range(4000), 2000, "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("TakeOrderedAndProject") == 1 and "limit=1," in plan.replace(" ", "")


def hard_values(spark):
    rng = np.random.default_rng(4)
    v = np.round(rng.normal(size=30_000), 3)
    v[::3] = 0.25  # a third of all rows
    rows = [(["a", "b", None][i % 3] if i < 20_000 else "big", float(x), None if i % 2 else float(i % 7)) for i, x in enumerate(v)]
    rows += [("none", None, None), ("nan", float("nan"), 1.0), ("one", 3.0, 2.0)]
    return rows, spark.createDataFrame(rows, "grp string, v double, w double")


@pytest.mark.parametrize("narrow", [None, 1e-7])
@pytest.mark.parametrize("by", [[], ["grp"]])
def test_quantiles_by_narrowing(spark, narrow, by, monkeypatch):
    """Exact also where the intervals miss the ranks, which too small a margin makes them do."""
    rows, df = hard_values(spark)
    if narrow:
        monkeypatch.setattr(quantiles, "MARGIN", narrow)
        monkeypatch.setattr(quantiles, "FEW", 0)
    probs = [0.0, 0.1, 0.5, 0.75, 1.0]
    pdf = pd.DataFrame(rows, columns=["grp", "v", "w"])
    pdf["all"] = 0
    got = {(r[0] if by else 0, r["column"]): (r["n"], r["q"]) for r in quantiles.quantiles(df.repartition(4), ["v", "w"], probs, by).collect()}
    want = {}
    for c in ("v", "w"):
        for g, part in pdf.groupby(by[0] if by else "all", dropna=False)[c]:
            if part.notna().any():
                want[None if pd.isna(g) else g, c] = (part.notna().sum(), part.quantile(probs).tolist())
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1]), k


def test_narrowing_shuffles_few_values(spark, monkeypatch):
    seen = {}
    keep = quantiles.cumulative_counts
    monkeypatch.setattr(quantiles, "cumulative_counts", lambda pairs, *a, **k: (seen.update(n=pairs.count()), keep(pairs, *a, **k))[1])
    df = spark.range(200_000).select(F.rand(3).alias("v"))
    quantiles.exact_quantiles(df, ["v"], [0.5]).collect()
    assert 0 < seen["n"] < 200_000 * 0.02


def test_sketches_are_stored_and_merged(spark):
    rows, df = hard_values(spark)
    stored = quantiles.quantile_sketches(df, ["v", "w"], ["grp"], error=0.01)
    merged = {r["column"]: r for r in quantiles.sketch_quantiles(quantiles.merge_sketches(stored), [0.25, 0.5, 0.9]).collect()}
    v = np.array([r[1] for r in rows if r[1] is not None and not np.isnan(r[1])])
    assert merged["v"]["n"] == len(v)
    for p, q in zip([0.25, 0.5, 0.9], merged["v"]["q"]):
        assert (v < q).mean() - 0.02 <= p <= (v <= q).mean() + 0.02
    by_group = {r["grp"] for r in quantiles.sketch_quantiles(stored, [0.5]).where("column = 'v'").collect()}
    assert by_group == {"a", "b", None, "big", "one"}


def test_cleaning_parses_each_text_column_once(spark):
    """The result reads the typed table, with the fence pushed into its scan."""
    from tesela.plans.cleaning import clean_access

    rows = [("05001", "2021", str(i), "6,00", "1", "Residencial") for i in range(100)] + [("05001", "2021", "1.174.274", "6,00", "1", None)]
    raw = spark.createDataFrame(rows, "cod_municipio string, anno string, no_de_accesos string, velocidad_bajada string, velocidad_subida string, segmento string")
    for error in (None, 0.01):
        out = clean_access(raw, outlier_error=error)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "regexp" not in plan and "PushedFilters" in plan and "GreaterThanOrEqual(no_de_accesos" in plan
        assert out.count() == 100


def test_pipeline_prunes_and_repeats_its_sample(spark, tmp_path):
    from tesela.plans import contract as C
    from tesela.plans.pipeline import run_pipeline

    students = spark.createDataFrame([("20231", "PUBLICAR", "5001", str(i), str(i), "x") for i in range(200)], "periodo string, estu_estadoinvestigacion string, cole_cod_mcpio_ubicacion string, punt_global string, punt_ingles string, extra string")
    access = spark.createDataFrame([("5001", "2023", str(i)) for i in range(50)], "cod_municipio string, anno string, no_de_accesos string")
    coverage = spark.createDataFrame([("5001", "2023", "100", "90", "m", "d")], "c_digo_municipio string, a_o string, poblaci_n_5_16 string, cobertura_neta string, municipio string, departamento string")
    kept = []
    for n in (1, 5):
        out = run_pipeline(students.repartition(n), access, coverage, str(tmp_path / str(n)), rows=40)
        assert "extra" not in out["students"].columns and out["students"].count() <= 40
        kept.append(sorted(r[C.SCORE] for r in out["students"].collect()))
    assert kept[0] == kept[1]
    assert "extra" in run_pipeline(students, access, coverage, str(tmp_path / "all"), columns={})["students"].columns
