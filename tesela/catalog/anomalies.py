"""Queries for reconstruction errors, thresholds, classes and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..anomaly import network, scaling, scoring
from ..anomaly.pca import reconstruct_pca
from ..operators.sampling import tag_split
from ..plans import contract as C
from ..session import materialise
from ..sources.files import read_table
from .plans import features
from .registry import query


@query(
    "recon_error",
    """SELECT vec_id, round(list_sum(list_transform(embedding, lambda v:
      (v::DOUBLE - floor(v::DOUBLE * 10) / 10) * (v::DOUBLE - floor(v::DOUBLE * 10) / 10)))
      / len(embedding), 10) AS reconstruction_error FROM embeddings""",
)
def recon_error(spark, sf):
    """Error of a coarse reconstruction that keeps one decimal of every position."""
    table = read_table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("x")
    )
    coarse = table.withColumn("y", F.transform("x", lambda v: F.floor(v * 10) / 10))
    return scoring.add_errors(coarse, "x", "y").select(
        "vec_id", F.round(scoring.ERROR, 10).alias(scoring.ERROR)
    )


MOMENTS = """SELECT count(*) AS n, avg(value) AS mean, stddev_pop(value) AS std,
  skewness(value) * (count(*) - 2) / sqrt(count(*) * (count(*) - 1.0)) AS skewness,
  kurtosis_pop(value) AS kurtosis FROM events"""


@query(
    "normality_jb",
    f"""SELECT n, round(mean, 6) AS mean, round(std, 6) AS std, round(skewness, 6) AS skewness,
      round(kurtosis, 6) AS kurtosis, round(jb, 3) AS jb, round(exp(-jb / 2), 8) AS p_value
    FROM (SELECT *, n / 6 * (skewness * skewness + kurtosis * kurtosis / 4) AS jb FROM ({MOMENTS}))""",
)
def normality_jb(spark, sf):
    table = scoring.normality(read_table(spark, sf, "events"), "value")
    digits = dict(mean=6, std=6, skewness=6, kurtosis=6, jb=3, p_value=8)
    return table.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query("normality_ks")
def normality_ks(spark, sf):
    return scoring.normality_ks(read_table(spark, sf, "events"), "value")


@query(
    "adaptive_threshold",
    f"""SELECT CASE WHEN p > 0.05 THEN 'mean+2sigma' ELSE 'percentile_75' END AS method,
      p > 0.05 AS is_normal, round(p, 8) AS p_value, round(mean, 6) AS mean, round(std, 6) AS std,
      round(p25, 6) AS percentile_25, round(p75, 6) AS percentile_75,
      round(CASE WHEN p > 0.05 THEN mean + 2 * std ELSE p75 END, 6) AS threshold
    FROM (SELECT *, exp(-n / 6 * (skewness * skewness + kurtosis * kurtosis / 4) / 2) AS p
      FROM ({MOMENTS})), (SELECT quantile_cont(value, 0.25) AS p25,
      quantile_cont(value, 0.75) AS p75 FROM events)""",
)
def adaptive_threshold(spark, sf):
    table = scoring.adaptive_threshold(read_table(spark, sf, "events"), "value")
    six = ["mean", "std", "percentile_25", "percentile_75", "threshold"]
    return table.withColumns(
        {"p_value": F.round("p_value", 8), **{c: F.round(c, 6) for c in six}}
    )


@query(
    "feature_contributions",
    """SELECT l_orderkey, l_linenumber, feature, feature_error, global_error,
      round(feature_error / (global_error + 1e-10) * 100, 2) AS feature_error_pct
    FROM (SELECT *, (0.0 + l_discount + l_tax) / 2 AS global_error FROM lineitem)
    UNPIVOT (feature_error FOR feature IN (l_discount, l_tax))""",
)
def feature_contributions(spark, sf):
    line = read_table(spark, sf, "lineitem").withColumn(
        "feature_errors", F.array("l_discount", "l_tax")
    )
    rows = line.withColumn(scoring.ERROR, scoring.mean_of_array(F.col("feature_errors")))
    return scoring.contributions(rows, ["l_discount", "l_tax"], ["l_orderkey", "l_linenumber"])


FLAGGED = """(SELECT event_id, value AS reconstruction_error,
  value > (SELECT quantile_cont(value, 0.75) FROM events) AS is_anomaly,
  CASE WHEN event_type <> 'error' THEN user_id::DOUBLE END AS puntaje_global_promedio FROM events)"""
CLASSED = f"""(SELECT f.*, CASE WHEN NOT is_anomaly THEN 'TÍPICO'
  WHEN puntaje_global_promedio > m THEN 'ANOMALÍA_POSITIVA' ELSE 'ANOMALÍA_NEGATIVA' END
  AS anomaly_class FROM {FLAGGED} f,
  (SELECT quantile_cont(puntaje_global_promedio, 0.5) AS m FROM {FLAGGED}))"""


def _classified(spark, sf):
    events = read_table(spark, sf, "events").select(
        "event_id",
        F.col("value").alias(scoring.ERROR),
        F.when(F.col("event_type") != "error", F.col("user_id").cast("double")).alias(
            scoring.SCORE
        ),
    )
    limit = scoring.adaptive_threshold(events).first()["percentile_75"]
    return scoring.classify(events.withColumn("is_anomaly", F.col(scoring.ERROR) > F.lit(limit)))


@query("classify_anomalies", f"SELECT * FROM {CLASSED}")
def classify_anomalies(spark, sf):
    return _classified(spark, sf)


@query(
    "class_summary",
    f"""SELECT anomaly_class, count(reconstruction_error) AS reconstruction_error_count,
      round(avg(reconstruction_error), 6) AS reconstruction_error_mean,
      round(stddev_samp(reconstruction_error), 6) AS reconstruction_error_std,
      min(reconstruction_error) AS reconstruction_error_min,
      max(reconstruction_error) AS reconstruction_error_max,
      round(avg(puntaje_global_promedio), 6) AS puntaje_global_promedio_mean,
      round(stddev_samp(puntaje_global_promedio), 6) AS puntaje_global_promedio_std
    FROM {CLASSED} GROUP BY 1""",
)
def class_summary(spark, sf):
    return scoring.class_summary(_classified(spark, sf), digits=6)


def _scaled_embeddings(spark, sf):
    """Embeddings with a split, standardised by the training part, written once."""
    rows = read_table(spark, sf, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("x")
    )
    tagged = tag_split(rows, "vec_id")
    stats = scaling.array_stats(tagged.where(F.col("split") == "train"), "x")
    return materialise(scaling.zscore_array(tagged, "x", stats), "embeddings")


@query("recon_pca")
def recon_pca(spark, sf):
    rows = _scaled_embeddings(spark, sf)
    rebuilt = reconstruct_pca(rows.where(F.col("split") == "train"), rows, "x", "y")
    return scoring.add_errors(rebuilt, "x", "y").select("vec_id", "split", scoring.ERROR)


def _train(rows, **kw):
    learn = rows.where(F.col("split") != "test")
    return network.train_network(learn, "x", "is_val", **kw)


@query("recon_mlp")
def recon_mlp(spark, sf):
    rows = _scaled_embeddings(spark, sf)
    model = _train(rows)
    tests = model.reconstruct(rows.where(F.col("split") == "test"), "x", "y")
    return scoring.add_errors(tests, "x", "y").select("vec_id", "label", scoring.ERROR)


@query("training_history")
def training_history(spark, sf):
    model = _train(_scaled_embeddings(spark, sf))
    return network.best_epoch(model.history_frame(spark))


@query("anomaly_report")
def anomaly_report(spark, sf):
    """Municipality-years: train, reconstruct, classify the test part; the summary per class."""
    table = features(spark, sf).withColumn("id", F.concat_ws("-", C.KEY, C.YEAR))
    tagged = materialise(tag_split(table, "id"), "features")
    stats = scaling.train_stats(tagged.where(F.col("split") == "train"), C.ANOMALY_FEATURES)
    scaled = scaling.zscore(tagged, stats).withColumn("x", F.array(*C.ANOMALY_FEATURES))
    rows = materialise(scaled, "scaled")
    model = _train(rows)
    unseen = rows.where(F.col("split") == "test")
    errors = scoring.add_errors(model.reconstruct(unseen, "x", "y"), "x", "y").drop("x", "y")
    tables = scoring.report(errors, C.ANOMALY_FEATURES, [C.KEY, C.YEAR, "municipio"], [C.KEY, C.YEAR])
    return tables["summary"]




def _line_report(spark, sf):
    """Report tables of line items whose errors are given: those of discount and tax."""
    line = read_table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").alias(scoring.SCORE),
        F.array("l_discount", "l_tax").alias("feature_errors"),
    )
    rows = line.withColumn(scoring.ERROR, scoring.mean_of_array(F.col("feature_errors")))
    ids = ["l_orderkey", "l_linenumber"]
    return scoring.report(rows, ["l_discount", "l_tax"], ids, ids)


LINE_CLASSES = """classed AS (
  SELECT l_orderkey, l_linenumber, l_discount, l_tax, e AS reconstruction_error, puntaje_global_promedio,
    e > t AS is_anomaly,
    round((rank() OVER (ORDER BY e) + (count(*) OVER (PARTITION BY e) - 1) / 2.0) / count(*) OVER () * 100, 2)
      AS anomaly_score_pct,
    CASE WHEN NOT e > t THEN 'TÍPICO' WHEN puntaje_global_promedio > m THEN 'ANOMALÍA_POSITIVA'
      ELSE 'ANOMALÍA_NEGATIVA' END AS anomaly_class
  FROM errors, (SELECT CASE WHEN exp(-n / 6 * (s * s + k * k / 4) / 2) > 0.05 THEN mean + 2 * std ELSE p75 END AS t
    FROM (SELECT count(*) AS n, avg(e) AS mean, stddev_pop(e) AS std, kurtosis_pop(e) AS k,
      skewness(e) * (count(*) - 2) / sqrt(count(*) * (count(*) - 1.0)) AS s, quantile_cont(e, 0.75) AS p75 FROM errors)),
    (SELECT quantile_cont(puntaje_global_promedio, 0.5) AS m FROM errors))"""
LINE_ERRORS = (
    "errors AS (SELECT *, (0.0 + l_discount + l_tax) / 2 AS e, l_quantity AS puntaje_global_promedio FROM lineitem)"
)


def _line_sql(select: str) -> str:
    return f"WITH {LINE_ERRORS}, {LINE_CLASSES} {select}"


@query(
    "report_classified",
    _line_sql(
        """SELECT l_orderkey, l_linenumber, puntaje_global_promedio, reconstruction_error, is_anomaly,
        round(log10(reconstruction_error + 1e-10), 8) AS error_log10, anomaly_score_pct, anomaly_class FROM classed"""
    ),
)
def report_classified(spark, sf):
    return _line_report(spark, sf)["classified"].withColumn("error_log10", F.round("error_log10", 8))


@query(
    "report_top",
    _line_sql(
        """SELECT l_orderkey, l_linenumber, reconstruction_error, anomaly_class, position FROM (
        SELECT *, row_number() OVER (PARTITION BY anomaly_class
          ORDER BY reconstruction_error DESC, l_orderkey, l_linenumber)::INTEGER AS position
        FROM classed WHERE anomaly_class <> 'TÍPICO') WHERE position <= 20"""
    ),
)
def report_top(spark, sf):
    columns = ["l_orderkey", "l_linenumber", scoring.ERROR, "anomaly_class", "position"]
    return _line_report(spark, sf)["top"].select(*columns)


@query(
    "report_shares",
    _line_sql(
        """SELECT anomaly_class, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM classed), 2) AS pct
        FROM classed GROUP BY 1"""
    ),
)
def report_shares(spark, sf):
    return _line_report(spark, sf)["shares"]


@query(
    "report_mean_contributions",
    _line_sql(
        """SELECT feature, round(avg(pct), 6) AS mean_pct FROM (
        SELECT feature, round(fe / (reconstruction_error + 1e-10) * 100, 2) AS pct
        FROM (SELECT l_discount, l_tax, reconstruction_error, anomaly_class FROM classed)
        UNPIVOT (fe FOR feature IN (l_discount, l_tax)) WHERE anomaly_class <> 'TÍPICO') GROUP BY 1"""
    ),
)
def report_mean_contributions(spark, sf):
    table = _line_report(spark, sf)["mean_contributions"]
    return table.withColumn("mean_pct", F.round("mean_pct", 6))
