"""Municipality-year tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classes import by_cuts, safe_ratio
from ..functions.exact import exact_mean, exact_sum, rounded
from ..functions.parse import equals_flag, first_number, like_flag, yes_no_flag, period_year, normalize_code
from ..operators.aggregates import percent_of_rows
from ..operators.columns import column_or, select_present
from ..operators.impute import impute_median
from ..operators.quantiles import column_quantiles
from ..session import materialise
from . import contract as C


def connectivity(
    access: DataFrame, coverage: DataFrame, error: float | None = C.RANK_ERROR, scale: int | None = None
) -> DataFrame:
    """Accesses per inhabitant for every municipality and year, with its tercile level.

    Both inputs are reduced or already unique per key before the join.
    """
    keys = [C.KEY, C.YEAR]
    sums = (
        access.where(F.col(C.YEAR).isNotNull())
        .groupBy(*keys)
        .agg(exact_sum("no_de_accesos", scale).alias("total_accesos_internet"))
    )
    yearly = coverage.where(F.col(C.YEAR).isNotNull()).select(
        *keys, "poblaci_n_5_16", "cobertura_neta", "municipio", "departamento"
    )
    joined = sums.join(yearly, keys, "inner").withColumn(
        C.RATIO, safe_ratio("total_accesos_internet", "poblaci_n_5_16")
    )
    # The percentiles and the result read the short table, not all accesses again.
    return add_level(materialise(joined, "connectivity"), C.RATIO, C.LEVEL, error)


def add_level(df: DataFrame, column: str, out: str, error: float | None = C.RANK_ERROR) -> DataFrame:
    """Class by the 33rd and 66th percentile of a column."""
    low, high = column_quantiles(df, column, [0.33, 0.66], error) or (None, None)
    return df.withColumn(out, by_cuts(column, low, high))


def student_profile(
    students: DataFrame, digits: int | None = 2, scale: int | None = None
) -> DataFrame:
    """Socio-economic profile per municipality and year: two means, six shares, score, size.

    Works on clean and on raw students: keys and flags that are missing are derived from the
    raw columns, and columns the table lacks count as unknown.
    """

    def col(name: str, type_: str = "string"):
        return column_or(students, name, type_)

    key = col(C.KEY) if C.KEY in students.columns else normalize_code(col("cole_cod_mcpio_ubicacion"))
    year = (
        col(C.STUDENT_YEAR, "int")
        if C.STUDENT_YEAR in students.columns
        else period_year(col("periodo"))
    )
    home = (
        col(C.HOUSEHOLD_FLAG, "int")
        if C.HOUSEHOLD_FLAG in students.columns
        else yes_no_flag(col("fami_tieneinternet"))
    )
    score = next(
        (c for c in students.columns if C.SCORE in c.lower() or "puntaje_global" in c.lower()), None
    )
    derived = students.select(
        key.alias(C.KEY),
        year.alias(C.YEAR),
        first_number(col("fami_estratovivienda")).alias("estrato"),
        first_number(col("fami_personashogar")).alias("personas"),
        home.alias("internet"),
        like_flag(col("fami_educacionmadre"), C.HIGHER_EDUCATION).alias("madre"),
        like_flag(col("fami_educacionpadre"), C.HIGHER_EDUCATION).alias("padre"),
        equals_flag(col("cole_naturaleza"), C.PRIVATE_SCHOOL).alias("privado"),
        equals_flag(col("cole_area_ubicacion"), *C.URBAN).alias("urbano"),
        equals_flag(col("fami_tienecomputador"), C.HAS_COMPUTER).alias("computador"),
        (F.col(score) if score else F.lit(None)).cast("double").alias("score"),
    ).dropna(subset=[C.KEY, C.YEAR])
    return derived.groupBy(C.KEY, C.YEAR).agg(
        rounded(exact_mean("estrato", scale), digits).alias("prom_estrato_hogar"),
        percent_of_rows("internet").alias("pct_internet_hogar"),
        percent_of_rows("madre").alias("pct_educacion_madre_superior"),
        percent_of_rows("padre").alias("pct_educacion_padre_superior"),
        percent_of_rows("privado").alias("pct_colegio_privado"),
        percent_of_rows("urbano").alias("pct_area_urbana"),
        rounded(exact_mean("personas", scale), digits).alias("promedio_personas_hogar"),
        percent_of_rows("computador").alias("pct_hogar_computador"),
        rounded(exact_mean("score", scale), digits).alias("puntaje_global_promedio"),
        F.count("*").alias("n_estudiantes"),
    )


def mean_speed(access: DataFrame, scale: int | None = None) -> DataFrame:
    return (
        access.dropna(subset=[C.KEY, C.YEAR])
        .groupBy(C.KEY, C.YEAR)
        .agg(exact_mean("velocidad_bajada", scale).alias("velocidad_bajada"))
    )


def combined_features(
    levels: DataFrame, students: DataFrame, access: DataFrame, digits=2, scale=None
) -> DataFrame:
    """Connectivity with profile (inner) and mean speed (left) per municipality and year."""
    keys = [C.KEY, C.YEAR]
    return levels.join(student_profile(students, digits, scale), keys, "inner").join(
        mean_speed(access, scale), keys, "left"
    )


def anomaly_features(
    levels: DataFrame,
    students: DataFrame,
    access: DataFrame,
    error: float | None = C.RANK_ERROR,
    digits: int | None = 2,
    scale: int | None = None,
) -> DataFrame:
    """Identifiers and model features without nulls; nulls are filled by column medians."""
    joined = combined_features(levels, students, access, digits, scale)
    # The medians and the result read the short table, not all students and accesses again.
    table = materialise(select_present(joined, [*C.ANOMALY_IDS, *C.ANOMALY_FEATURES]), "combined")
    features = [c for c in C.ANOMALY_FEATURES if c in table.columns]
    return impute_median(table, features, error=error).dropna(subset=features)
