"""What keeps the named queries within their limits on larger tables."""

from __future__ import annotations

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tesela.catalog import QUERIES, roles
from tesela.functions.parse import parse_number
from tesela.ml import models
from tesela.plans import cleaning, municipal
from tesela.plans import contract as C

SF = "/root/testdata/sf0.001"


def test_questions_clean_only_the_tables_they_read(spark):
    folder = f"{SF}/."  # a folder of its own for the tables written once
    made = lambda: {k[2] for k in roles._RAW if k[1] == folder}
    assert QUERIES["q6_median_split"](spark, folder).count() > 0 and made() == {"coverage"}
    assert QUERIES["q2_flag_effect"](spark, folder).count() > 0 and made() == {"coverage", "students"}
    assert set(roles.clean_layer(spark, folder)) == {"students", "access", "coverage", "levels"}


@pytest.mark.parametrize("name", ["access", "students"])
def test_each_number_is_parsed_once(spark, monkeypatch, name):
    plans, columns = [], {"access": C.ACCESS_NUMBERS, "students": C.SCORES}[name]
    write = cleaning.materialise

    def recorded(df, label):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, label)

    monkeypatch.setattr(cleaning, "materialise", recorded)
    raw = roles.landed(spark, SF, name)
    {"access": cleaning.clean_access, "students": cleaning.clean_students}[name](raw)
    assert all(c in plans[0] for c in columns if c in raw.columns) and "regexp_replace" in plans[0]
    assert not [line for line in plans[0].splitlines() if "Filter" in line and "regexp_replace" in line]


def test_numbers_in_short_forms(spark):
    texts = {
        "6,00": 6.0, "-6,5": -6.5, "386.466": 386466.0, "-386.466": -386.466, "1.174.274": 1174274.0, "0.125": 125.0,
        "1.234,56": 1234.56, "1,234,567": None, ",5": 0.5, "5,": 5.0, "1.17.274": 117274.0, "1234.567": 1234.567, " 6,0": None,
    }
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_number("t").alias("v")).collect()
    assert {r.t: r.v for r in rows} == texts


@pytest.fixture(scope="module")
def features(spark):
    rows = spark.range(400, numPartitions=2).select(
        F.col("id").cast("string").alias("id"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000).alias("x"),
        F.when(F.col("id") % 5 == 0, "val").when(F.col("id") % 5 == 1, "test").otherwise("train").alias("split"),
    )
    rows = rows.withColumn("punt_global", 100 * F.sin(9 * F.col("x")) + 200).withColumn("punt_ingles", 50 * F.col("x"))
    return VectorAssembler(inputCols=["x"], outputCol="features").transform(rows).drop("x")


def test_first_trees_are_those_of_fewer_rounds(spark, features):
    fit = lambda n: GBTRegressor(maxIter=n, maxDepth=3, subsamplingRate=0.8, seed=1, labelCol="punt_global").fit(features)
    cut, whole = models.first_trees(spark, fit(9), 4), fit(4)
    assert cut.getNumTrees == 4 and cut.treeWeights == whole.treeWeights
    assert cut.toDebugString.split("\n")[1:] == whole.toDebugString.split("\n")[1:]
    got, want = (m.transform(features).select("id", "prediction").orderBy("id").collect() for m in (cut, whole))
    assert got == want


def test_boosting_does_not_fit_again(spark, features, monkeypatch):
    from pyspark.ml import PipelineModel

    rounds, fit = [], GBTRegressor._fit
    monkeypatch.setattr(GBTRegressor, "_fit", lambda self, df: rounds.append(self.getMaxIter()) or fit(self, df))
    noisy = features.withColumn("punt_global", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)).cast("double"))
    inputs = models.ScoreInputs(["x"], PipelineModel(stages=[]), noisy.persist())
    found, metrics, tests = models.fit_all_scores(inputs, ["punt_global", "punt_ingles"], rounds=8, depth=2, patience=2)
    assert list(found) == ["punt_global", "punt_ingles"] and tests.count() == 160
    kept = {r.target: r.n_trees for r in metrics.collect()}
    assert kept["punt_global"] < 4 and rounds.count(4) == 2 and set(rounds) <= {4, 8}


def test_large_features_lie_in_several_parts(spark, monkeypatch):
    monkeypatch.setattr(models, "ROWS_PER_PART", 100)
    table = models.dealt(spark.range(1000, numPartitions=1).toDF("id"), "id", "dealt")
    assert len(table.inputFiles()) > 5 and table.count() == 1000 and table.distinct().count() == 1000
    assert len(models.dealt(spark.range(90, numPartitions=1).toDF("id"), "id", "dealt").inputFiles()) == 1


def test_municipal_tables_are_short_before_percentiles_and_medians(spark):
    """Levels, medians and the results read the joined short table: students and accesses are summed once."""
    years = [(f"{k:05d}", y) for k in range(6) for y in (2020, 2021)]
    access = spark.createDataFrame([(k, y, float(int(k) + i), 10.0 * i) for k, y in years for i in range(3)], "cod_municipio_norm string, year_int int, no_de_accesos double, velocidad_bajada double")
    coverage = spark.createDataFrame([(k, y, 100.0, None, "m", "d") for k, y in years], "cod_municipio_norm string, year_int int, poblaci_n_5_16 double, cobertura_neta double, municipio string, departamento string")
    students = spark.createDataFrame([(k, y, "Estrato 2", 200.0 + i) for k, y in years[1:] for i in range(2)], "cod_municipio_norm string, year_icfes int, fami_estratovivienda string, punt_global double")
    levels = municipal.connectivity(access, coverage, error=None)
    table = municipal.anomaly_features(levels, students, access, error=None)
    assert levels.count() == 12 and table.count() == 11
    for short in (levels, table):
        assert "Aggregate" not in short._jdf.queryExecution().optimizedPlan().toString()
