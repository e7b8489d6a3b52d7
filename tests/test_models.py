"""Invariants of the trained models and the anomaly tables."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tesela.anomaly import network, scaling, scoring
from tesela.anomaly.pca import reconstruct_pca
from tesela.catalog import QUERIES
from tesela.ml.metrics import regression_metrics
from tesela.operators.sampling import tag_split
from tesela.session import materialise

SF = "/root/testdata/sf0.001"


def test_gradient_matches_differences():
    sizes = network.layer_sizes(5)
    rng = np.random.default_rng(1)
    w, x = network.start_weights(sizes, 3), rng.normal(size=(8, 5))
    g, _ = network.gradient(w, x, sizes)
    for i in rng.choice(len(w), 25, replace=False):
        step = np.zeros_like(w)
        step[i] = 1e-6
        up, down = network.gradient(w + step, x, sizes)[1], network.gradient(w - step, x, sizes)[1]
        assert g[i] == pytest.approx((up - down) / 2e-6, abs=1e-6)
    assert len(network.start_weights(network.layer_sizes(13), 0)) == 625


@pytest.fixture(scope="module")
def planted(spark):
    """Rows on a two-dimensional plane, and a few far from it."""
    rng = np.random.default_rng(0)
    base = rng.normal(size=(600, 2)) @ rng.normal(size=(2, 6))
    base[::50] += rng.normal(scale=4, size=(12, 6))
    rows = [(i, [float(v) for v in r], 300.0 + i % 7) for i, r in enumerate(base)]
    df = spark.createDataFrame(rows, "id long, x array<double>, puntaje_global_promedio double")
    tagged = tag_split(df, "id")
    stats = scaling.array_stats(tagged.where("split = 'train'"), "x")
    return materialise(scaling.zscore_array(tagged, "x", stats).repartition(2, "id"), "planted")


def test_network_learns(planted):
    learn = planted.where("split <> 'test'")
    model = network.train_network(learn, "x", "is_val", epochs=25)
    losses = [h[1] for h in model.history]
    assert losses[-1] < 0.7 * losses[0]
    again = network.train_network(learn, "x", "is_val", epochs=3)
    assert [h[1] for h in again.history] == pytest.approx(losses[:3])


def test_network_does_not_depend_on_the_layout(planted):
    learn = planted.where("split <> 'test'").select("x", "is_val")
    models = [network.train_network(learn.repartition(n), "x", "is_val", epochs=3) for n in (1, 8)]
    assert (models[0].weights == models[1].weights).all()
    assert models[0].history == models[1].history


def test_row_gradients_add_up():
    """A row's gradient is the same in any batch; sums beyond 64 bits are exact."""
    sizes, rng = network.layer_sizes(7), np.random.default_rng(2)
    w, x = network.start_weights(sizes, 1), rng.normal(size=(100, 7))
    whole = network.row_gradients(w, x, sizes)
    parts = [network.row_gradients(w, x[i : i + 7], sizes) for i in range(0, 100, 7)]
    assert (np.concatenate([p[0] for p in parts]) == whole[0]).all()
    assert (np.concatenate([p[1] for p in parts]) == whole[1]).all()
    big = network._fixed_sum(np.full((network.CHUNK, 1), 1e300)) * 10**6
    assert big[0] == int(network.LARGEST * network.UNIT) * network.CHUNK * 10**6


def test_workers_need_no_package(tmp_path):
    """What the network and the text operators send is loaded in a process without the package."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    sizes = network.layer_sizes(3)
    path = tmp_path / "sent"
    path.write_bytes(cloudpickle.dumps(network._step(network.start_weights(sizes, 0), sizes)))
    code = f"""
import pickle, pyarrow as pa
run = pickle.load(open({str(path)!r}, "rb"))
batch = pa.RecordBatch.from_arrays([pa.array([[1.0, 2.0, 3.0]]), pa.array([False])], names=["x", "v"])
assert int(list(run(iter([batch])))[0].column(0)[0].as_py()[-3]) == 1
try:
    import tesela
except ImportError:
    print("alone")
"""
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": ""}, capture_output=True, text=True)
    assert ran.stdout.strip() == "alone", ran.stderr


def test_pca_finds_planted_anomalies(planted):
    errors = scoring.add_errors(
        reconstruct_pca(planted.where("split = 'train'"), planted, "x", "y", 2), "x", "y"
    ).drop("x", "y")
    top = {r.id for r in errors.orderBy(F.desc(scoring.ERROR)).limit(12).collect()}
    assert len(top & set(range(0, 600, 50))) >= 10
    names = [f"f{i}" for i in range(6)]
    tables = scoring.report(errors, names, ["id"], ["id"])
    limit = tables["threshold"].first()
    assert limit["method"] == "percentile_75"
    flagged = tables["classified"].where("is_anomaly")
    assert flagged.count() == tables["classified"].where(F.col(scoring.ERROR) > limit["threshold"]).count()
    sums = tables["contributions"].groupBy("id").agg(F.sum("feature_error_pct").alias("s"))
    assert sums.where("abs(s - 600) > 1").count() == 0
    assert tables["top"].groupBy("anomaly_class").count().where("count > 20").count() == 0
    assert tables["shares"].agg(F.sum("n")).first()[0] == 600


def test_contributions_and_classes(spark):
    df = spark.createDataFrame([(1, [1.0, 3.0], 2.0)], f"id int, feature_errors array<double>, {scoring.ERROR} double")
    got = [r.feature_error_pct for r in scoring.contributions(df, ["a", "b"], ["id"]).orderBy("feature").collect()]
    assert got == [50.0, 150.0]
    got = [r.feature_error_pct for r in scoring.contributions(df, ["a", "b"], ["id"], "sum").orderBy("feature").collect()]
    assert got == [25.0, 75.0]
    rows = [(True, 9.0), (True, 1.0), (True, None), (False, 5.0)]
    table = spark.createDataFrame(rows, f"is_anomaly boolean, {scoring.SCORE} double")
    kinds = [r.anomaly_class for r in scoring.classify(table).collect()]
    assert kinds == [scoring.POSITIVE, scoring.NEGATIVE, scoring.NEGATIVE, scoring.TYPICAL]
    blank = table.withColumn(scoring.SCORE, F.lit(None).cast("double"))
    assert {r.anomaly_class for r in scoring.classify(blank).collect()} == {scoring.UNSCORED, scoring.TYPICAL}


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert [r.x for r in scaling.zscore(df, scaling.train_stats(df, ["x"])).collect()] == [0.0, 0.0]


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 3.0)], "label double, prediction double")
    row = regression_metrics(df).first()
    assert (row.rmse, row.mae, row.r2, row.n_test) == (0.5774, 0.3333, 0.5, 3)


def test_score_model_beats_the_mean(spark):
    rows = QUERIES["gbt_scores"](spark, SF).collect()
    assert len(rows) == 6
    assert all(r.r2 > 0.2 for r in rows if r.target == "punt_global")


def test_saved_model_predicts_the_same(spark):
    row = QUERIES["model_roundtrip"](spark, SF).first()
    assert row.n > 0 and row.n_different == 0


def test_scores_stay_in_range(spark):
    low, high = QUERIES["score_new_rows"](spark, SF).agg(F.min("prediction"), F.max("prediction")).first()
    assert 0 <= low <= high <= 500


def test_importances_add_up(spark):
    rows = QUERIES["rf_importance"](spark, SF).collect()
    assert sum(r.Importance for r in rows) == pytest.approx(1.0)


def test_silhouettes_equal_those_of_each_labelling(spark):
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector

    from tesela.ml.models import silhouettes

    points = spark.range(300, numPartitions=3).select(
        array_to_vector(F.array(F.randn(1) + F.col("id") % 3, F.randn(2), F.lit(1.0))).alias("features"),
        (F.col("id") % 3).cast("int").alias("k3"),
        F.when(F.col("id") == 7, 5).otherwise(F.col("id") % 2).cast("int").alias("k2"),  # 7 is alone
    )
    judge = ClusteringEvaluator(metricName="silhouette", distanceMeasure="squaredEuclidean")
    got = silhouettes(points, {3: "k3", 2: "k2"})
    for k in (2, 3):
        assert got[k] == pytest.approx(judge.setPredictionCol(f"k{k}").evaluate(points), abs=1e-9)


def test_silhouettes(spark):
    rows = QUERIES["kmeans_elbow"](spark, SF).collect()
    assert [r.k for r in rows] == list(range(2, 9))
    assert all(-1 <= r.silhouette <= 1 for r in rows)


@pytest.mark.parametrize(
    "name",
    sorted(
        {"cluster_profile", "encode_index", "encode_onehot", "imputer_median", "iqr_filter_approx",
         "kmeans_profiles", "normality_ks", "quantiles_approx", "recon_pca", "sample_fraction",
         "sample_n", "split_random", "training_history"}
    ),
)
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_stop_round():
    from tesela.ml.models import stop_round

    assert stop_round([5, 4, 3, 3, 3, 2, 9, 9, 9, 9], 4) == (6, True)
    assert stop_round([5, 4, 4, 4, 4, 1], 3) == (2, True)
    assert stop_round([5, 4, 3], 20) == (3, False)


def test_boosting_waits_for_gains(spark):
    """On a planted signal the rule keeps many rounds, and they beat the first five."""
    from pyspark.ml.feature import VectorAssembler

    from tesela.ml import models

    rows = spark.range(3000).select(
        F.col("id").cast("string").alias("id"),
        *[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 1000).alias(f"x{i}") for i in range(3)],
    )
    rows = rows.withColumn("punt_global", 100 * F.sin(6 * F.col("x0")) + 80 * F.col("x1") * F.col("x2") + 200)
    pipeline = PipelineModel(stages=[VectorAssembler(inputCols=["x0", "x1", "x2"], outputCol="features")])
    tagged = pipeline.transform(tag_split(rows, "id")).select("id", "features", "split", "punt_global")
    inputs = models.ScoreInputs(["x0", "x1", "x2"], pipeline, tagged.repartition(4).persist())
    _, metrics, tested = models.fit_score_model(inputs, "punt_global", rounds=60, depth=3)
    _, few, _ = models.fit_score_model(inputs, "punt_global", rounds=5, depth=3)
    kept, five = metrics.first(), few.first()
    assert kept.n_trees > 20 and kept.rmse < 0.7 * five.rmse
    assert tested.where("split != 'test'").count() == 0


def test_raw_rows_get_all_scores(spark):
    got = QUERIES["score_raw_rows"](spark, SF)
    raw = QUERIES["score_new_rows"](spark, SF).count()
    assert got.count() >= raw and len(got.columns) == 7
    pred = got.select("pred_punt_global").toPandas().iloc[:, 0]
    assert pred.between(0, 500).all()


def test_single_students_are_scored_from_dicts(spark):
    from tesela.catalog import models as catalog
    from tesela.catalog import roles
    from tesela.ml.models import score_records

    raw = roles.landed(spark, SF, "students").orderBy(catalog.ID).limit(3)
    fitted, levels = catalog._scores(spark, SF)[0], roles.levels(spark, SF)
    records = [r.asDict() for r in raw.collect()]
    got = score_records(fitted, [*records, {}], levels, catalog.ID)
    want = {r[catalog.ID]: r for r in QUERIES["score_raw_rows"](spark, SF).collect()}
    for record, scores in zip(records, got):
        assert scores == {t: want[record[catalog.ID]][f"pred_{t}"] for t in fitted}
    assert set(got[3]) == set(fitted) and all(0 <= v <= 500 for v in got[3].values())


def test_predictions_stand_beside_scores(spark):
    rows = QUERIES["gbt_predictions"](spark, SF).groupBy("target").count().collect()
    assert len(rows) == 6 and all(r["count"] > 0 for r in rows)
