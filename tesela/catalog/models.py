"""Queries for encoders, clustering and score models."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import functions as F

from ..anomaly import scaling
from ..ml import features as mlf
from ..ml import models
from ..ml.metrics import regression_metrics
from ..operators.sampling import tag_split
from ..plans import contract as C
from ..plans import dataset
from ..session import fresh_path, materialise
from ..sources.files import read_table
from . import roles
from .registry import query
from .sql import STUDENTS, with_

ID = "estu_consecutivo"


def _table(spark, sf):
    return dataset.model_table(roles.students(spark, sf), roles.levels(spark, sf), ID)


def _profiling(spark, sf):
    return dataset.profiling_table(roles.students(spark, sf), roles.levels(spark, sf), ID)


def _index_sql(column: str) -> str:
    return f"""(SELECT {column}, (row_number() OVER (ORDER BY count(*) DESC, {column}) - 1)::DOUBLE AS idx
      FROM orders GROUP BY 1)"""


INDEXED = f"""SELECT o_orderkey, o_orderstatus, o_orderpriority, s.idx AS status_idx, p.idx AS priority_idx
    FROM orders JOIN {_index_sql('o_orderstatus')} s USING (o_orderstatus)
    JOIN {_index_sql('o_orderpriority')} p USING (o_orderpriority)"""


@query("encode_index", INDEXED)
def encode_index(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    indexer = StringIndexer(
        inputCols=["o_orderstatus", "o_orderpriority"],
        outputCols=["status_idx", "priority_idx"],
        handleInvalid="keep",
    )
    return indexer.fit(orders).transform(orders)


@query(
    "encode_index_sql",
    """SELECT o_orderkey, o_orderpriority, idx FROM orders JOIN (
      SELECT o_orderpriority, (row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1)::INTEGER
        AS idx FROM orders GROUP BY 1) USING (o_orderpriority)""",
)
def encode_index_sql(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return mlf.frequency_index(orders, "o_orderpriority", "idx")


@query(
    "encode_onehot",
    f"""SELECT *, [CASE WHEN i = priority_idx THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END FOR i IN
      range(0, (SELECT count(DISTINCT o_orderpriority) + 1 FROM orders))] AS hot FROM ({INDEXED})""",
)
def encode_onehot(spark, sf):
    indexed = encode_index(spark, sf)
    hot = OneHotEncoder(inputCols=["priority_idx"], outputCols=["hot"], handleInvalid="keep")
    return models.vector_as_array(hot.fit(indexed).transform(indexed), "hot")


@query("imputer_median")
def imputer_median(spark, sf):
    orders = read_table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("price"),
        F.lit(None).cast("double").alias("nothing"),
    )
    usable = mlf.with_values(orders, ["price", "nothing"])
    return mlf._imputer(usable).fit(orders).transform(orders)


@query(
    "scale_std",
    """SELECT event_id, round(value / (SELECT stddev_samp(value) FROM events), 8) AS scaled
    FROM events""",
)
def scale_std(spark, sf):
    events = read_table(spark, sf, "events").select("event_id", "value")
    (deviation,) = events.agg(F.stddev_samp("value")).first()
    return events.select(
        "event_id", F.round(F.col("value") / F.lit(deviation or 1.0), 8).alias("scaled")
    )


@query(
    "zscore_train_stats",
    """WITH t AS (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events
      WHERE ('0x' || substr(md5('42' || event_id::VARCHAR), 1, 8))::BIGINT < 3006477107)
    SELECT event_id, round((value - m) / s, 8) AS value, 0.0::DOUBLE AS flat FROM events, t""",
)
def zscore_train_stats(spark, sf):
    events = read_table(spark, sf, "events").select(
        "event_id", "value", F.lit(7.0).alias("flat")
    )
    tagged = tag_split(events, "event_id")
    stats = scaling.train_stats(tagged.where(F.col("split") == "train"), ["value", "flat"])
    return scaling.zscore(events, stats, digits=8)


@query(
    "regression_metrics",
    """SELECT round(sqrt(sum(e * e) / count(*)), 4) AS rmse, round(avg(abs(e)), 4) AS mae,
      round(1 - sum(e * e) / (var_pop(y) * count(*)), 4) AS r2, count(*) AS n_test
    FROM (SELECT l_extendedprice AS y, l_extendedprice - l_quantity * 2000 AS e FROM lineitem)""",
)
def regression_metrics_(spark, sf):
    line = read_table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 2000).alias("prediction")
    )
    return regression_metrics(line)


@query("kmeans_elbow")
def kmeans_elbow(spark, sf):
    """The sweep over k leaves the total score out; the final fit puts it in."""
    return models.elbow(models.cluster_features(_profiling(spark, sf), extra_numeric=()))


@query("kmeans_profiles")
def kmeans_profiles(spark, sf):
    profiling = materialise(_profiling(spark, sf), "profiling")
    k = models.best_k(models.elbow(models.cluster_features(profiling, extra_numeric=())))
    table = models.cluster_profile(models.assign_clusters(models.cluster_features(profiling), k))
    return table.withColumn("perfil", models.profile_label())


@query("cluster_profile")
def cluster_profile(spark, sf):
    features = models.cluster_features(_profiling(spark, sf))
    return models.cluster_profile(models.assign_clusters(features, 3))


@query("rf_importance")
def rf_importance(spark, sf):
    importance, _ = models.forest_importance(_profiling(spark, sf), C.SCORE, ID)
    return importance


@query("rf_importance_top")
def rf_importance_top(spark, sf):
    """The fifteen most important inputs."""
    return rf_importance(spark, sf).limit(15)


_FITTED: dict = {}


def _scores(spark, sf):
    """Models, metrics and test rows of all scores, fitted once per application and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FITTED:
        _FITTED[key] = models.fit_all_scores(models.score_inputs(_table(spark, sf), ID))
    return _FITTED[key]


@query("gbt_scores")
def gbt_scores(spark, sf):
    return _scores(spark, sf)[1]


@query("gbt_predictions")
def gbt_predictions(spark, sf):
    """Prediction beside actual score for the test rows of every score."""
    return _scores(spark, sf)[2]


@query("score_new_rows")
def score_new_rows(spark, sf):
    """The model of the total score scores all students, as a batch of new rows."""
    rows = dataset.model_table(
        roles.students(spark, sf).drop(*C.SCORES), roles.levels(spark, sf), ID
    )
    return _scores(spark, sf)[0][C.SCORE].predict(rows).select(ID, "prediction")


@query("score_raw_rows")
def score_raw_rows(spark, sf):
    """All six scores of every raw student row, from its text columns alone."""
    raw = roles.landed(spark, sf, "students").drop(*C.SCORES)
    rows = dataset.raw_table(raw, roles.levels(spark, sf), ID)
    return models.predict_all(_scores(spark, sf)[0], rows, ID)


@query("model_roundtrip", with_(STUDENTS) + "SELECT count(*) AS n, 0::BIGINT AS n_different FROM students")
def model_roundtrip(spark, sf):
    """Save and load a fitted pipeline; both score all students, differences are counted."""
    table = materialise(_table(spark, sf), "model-table")
    model = _scores(spark, sf)[0][C.SCORE]
    again = models.ScoreModel.load(model.save(fresh_path(spark, "model")))
    a = model.predict(table).select(ID, F.col("prediction").alias("before"))
    b = again.predict(table).select(ID, F.col("prediction").alias("after"))
    return a.join(b, ID).agg(
        F.count("*").alias("n"),
        F.sum((F.col("before") != F.col("after")).cast("int")).alias("n_different"),
    )
