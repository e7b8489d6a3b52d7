"""Errors, thresholds, classes and explanations of reconstructions."""

from __future__ import annotations

from pyspark.ml.stat import KolmogorovSmirnovTest
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classes import log10_floor
from ..operators.aggregates import count_with_share
from ..operators.quantiles import column_quantiles
from ..operators.ranking import average_rank_pct, top_n_per_group
from ..session import materialise

# Class names.
TYPICAL = "TÍPICO"
POSITIVE = "ANOMALÍA_POSITIVA"
NEGATIVE = "ANOMALÍA_NEGATIVA"
UNSCORED = "ANOMALÍA_SIN_PUNTAJE"
ERROR = "reconstruction_error"
SCORE = "puntaje_global_promedio"


def squared_errors(x: str, rebuilt: str) -> Column:
    """Squared error of every position."""
    return F.zip_with(x, rebuilt, lambda a, b: (a - b) * (a - b))


def mean_of_array(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, v: s + v) / F.size(a)


def add_errors(df: DataFrame, x: str, rebuilt: str) -> DataFrame:
    """Error per position (`feature_errors`) and mean squared error per row."""
    each = df.withColumn("feature_errors", squared_errors(x, rebuilt))
    return each.withColumn(ERROR, mean_of_array(F.col("feature_errors")))


def normality(df: DataFrame, column: str) -> DataFrame:
    """Jarque-Bera test from skewness and kurtosis; the p-value has a closed form.

    It is one partial aggregate over all rows and needs no sample."""
    c = F.col(column).cast("double")
    moments = df.where(c.isNotNull()).agg(
        F.count("*").alias("n"),
        F.avg(c).alias("mean"),
        F.stddev_pop(c).alias("std"),
        F.skewness(c).alias("skewness"),
        F.kurtosis(c).alias("kurtosis"),
    )
    statistic = F.col("n") / 6 * (F.pow("skewness", F.lit(2)) + F.pow("kurtosis", F.lit(2)) / 4)
    tested = moments.withColumn("jb", statistic)
    return tested.withColumn("p_value", F.exp(-F.col("jb") / 2))


def normality_ks(df: DataFrame, column: str) -> DataFrame:
    """Kolmogorov-Smirnov test against the normal with the column's own mean and deviation."""
    c = F.col(column).cast("double")
    values = df.where(c.isNotNull()).select(c.alias("__v"))
    mean, std = values.agg(F.avg("__v"), F.stddev_pop("__v")).first()
    return KolmogorovSmirnovTest.test(values, "__v", "norm", float(mean), float(std or 1.0))


def adaptive_threshold(
    df: DataFrame, column: str = ERROR, alpha: float = 0.05, error: float | None = None
) -> DataFrame:
    """mean + 2 deviations for normal errors, else the 75th percentile; one row."""
    quartiles = column_quantiles(df, column, [0.25, 0.75], error) or [None, None]
    p25, p75 = (F.lit(q).cast("double") for q in quartiles)
    normal = F.coalesce(F.col("p_value") > alpha, F.lit(False))
    return normality(df, column).select(
        F.when(normal, "mean+2sigma").otherwise("percentile_75").alias("method"),
        normal.alias("is_normal"),
        "p_value",
        "mean",
        "std",
        p25.alias("percentile_25"),
        p75.alias("percentile_75"),
        F.when(normal, F.col("mean") + 2 * F.col("std")).otherwise(p75).alias("threshold"),
    )


def classify(df: DataFrame, flag: str = "is_anomaly", score: str = SCORE) -> DataFrame:
    """Typical rows, and anomalies above or not above the median score of all rows."""
    found = column_quantiles(df, score, [0.5]) if score in df.columns else None
    if found is None:
        kind = F.when(F.col(flag), UNSCORED).otherwise(TYPICAL)
    else:
        above = F.coalesce(F.col(score) > found[0], F.lit(False))
        kind = (
            F.when(~F.col(flag), TYPICAL).when(above, POSITIVE).otherwise(NEGATIVE)
        )
    return df.withColumn("anomaly_class", kind)


def contributions(
    df: DataFrame, features: list[str], ids: list[str], normalise: str = "mean"
) -> DataFrame:
    """Share of every feature in the error of its row, long format.

    By the mean error (shares of a row add up to 100 per feature) or, with `sum`, by the total
    error (they add up to 100)."""
    names = F.array(*[F.lit(f) for f in features])
    pairs = F.arrays_zip(names.alias("feature"), F.col("feature_errors").alias("error"))
    long = df.select(*ids, F.col(ERROR).alias("global_error"), F.explode(pairs).alias("e"))
    total = F.col("global_error") * (len(features) if normalise == "sum" else 1)
    return long.select(
        *ids,
        F.col("e.feature").alias("feature"),
        F.col("e.error").alias("feature_error"),
        "global_error",
        F.round(F.col("e.error") / (total + 1e-10) * 100, 2).alias("feature_error_pct"),
    )


def mean_contribution(long: DataFrame, class_column: str = "anomaly_class") -> DataFrame:
    """Mean contribution of every feature over the rows that are not typical."""
    return (
        long.where(F.col(class_column) != TYPICAL)
        .groupBy("feature")
        .agg(F.avg("feature_error_pct").alias("mean_pct"))
        .orderBy(F.desc("mean_pct"))
    )


def class_summary(
    df: DataFrame, by: str = "anomaly_class", error: str = ERROR, score: str | None = SCORE, digits=8
) -> DataFrame:
    """Size and error statistics per class, with the score statistics where there is a score."""
    aggs = [
        F.count(error).alias(f"{error}_count"),
        F.round(F.avg(error), digits).alias(f"{error}_mean"),
        F.round(F.stddev_samp(error), digits).alias(f"{error}_std"),
        F.min(error).alias(f"{error}_min"),
        F.max(error).alias(f"{error}_max"),
    ]
    if score and score in df.columns:
        aggs += [
            F.round(F.avg(score), digits).alias(f"{score}_mean"),
            F.round(F.stddev_samp(score), digits).alias(f"{score}_std"),
        ]
    return df.groupBy(by).agg(*aggs)


def report(df: DataFrame, features: list[str], ids: list[str], tie: list[str]) -> dict[str, DataFrame]:
    """All result tables for rows with `feature_errors` and the row error.

    Keys: threshold, classified, contributions, top, summary, shares, mean_contributions."""
    rows = materialise(df, "errors")
    threshold = materialise(adaptive_threshold(rows), "threshold")
    limit = threshold.first()["threshold"]
    flagged = rows.withColumn("is_anomaly", F.col(ERROR) > F.lit(limit)).withColumn(
        "error_log10", log10_floor(ERROR)
    )
    ranked = average_rank_pct(flagged, ERROR, "anomaly_score_pct")
    classified = materialise(classify(ranked), "classified")
    long = contributions(classified, features, [*ids, "anomaly_class"])
    kept = classified.drop("feature_errors")
    order = [F.desc(ERROR), *[F.asc(t) for t in tie]]
    return {
        "threshold": threshold,
        "classified": kept,
        "contributions": long,
        "top": top_n_per_group(
            kept.where(F.col("anomaly_class") != TYPICAL), ["anomaly_class"], 20, order
        ),
        "summary": class_summary(classified),
        "shares": count_with_share(classified, ["anomaly_class"]),
        "mean_contributions": mean_contribution(long),
    }
