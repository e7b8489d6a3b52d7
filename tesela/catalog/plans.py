"""Queries over the role tables: cleaning, municipality tables, business questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.columns import to_long
from ..operators.joins import fact_to_yearly, match_rate
from ..plans import contract as C
from ..plans import cleaning, dataset, municipal, questions
from . import roles
from .registry import query
from .roles import SCALE
from .sql import ACCESS, ALL_TABLES, COVERAGE, LEVELS, PROFILE, STUDENTS, mean, total, with_

DIGITS = 5

STUDENT_COLUMNS = [
    "estu_consecutivo", C.KEY, C.STUDENT_YEAR, C.HOUSEHOLD_FLAG, "cole_naturaleza", *C.SCORES,
]
LEVEL_COLUMNS = [
    C.KEY, C.YEAR, "total_accesos_internet", "poblaci_n_5_16", "cobertura_neta", "municipio",
    "departamento", C.RATIO, C.LEVEL,
]
COVERAGE_COLUMNS = [
    C.KEY, C.YEAR, "municipio", "departamento", "cobertura_neta", "cobertura_bruta", "deserci_n",
    "sedes_conectadas_a_internet", "poblaci_n_5_16",
]
ACCESS_COLUMNS = [
    "l_orderkey", "l_linenumber", C.KEY, C.YEAR, "tecnologia", "segmento", "no_de_accesos",
    "velocidad_bajada", "velocidad_subida", "categoria_velocidad_bajada",
]
FANOUT = "students JOIN levels USING (cod_municipio_norm)"


def _cols(names: list[str]) -> str:
    return ", ".join(names)


@query("clean_scores", with_(STUDENTS) + f"SELECT {_cols(STUDENT_COLUMNS)} FROM students")
def clean_scores(spark, sf):
    return cleaning.clean_students(roles.landed(spark, sf, "students"), outlier_error=None, scale=SCALE).select(*STUDENT_COLUMNS)


@query("clean_access", with_(ACCESS) + f"SELECT {_cols(ACCESS_COLUMNS)} FROM access")
def clean_access(spark, sf):
    return cleaning.clean_access(roles.landed(spark, sf, "access"), outlier_error=None).select(*ACCESS_COLUMNS)


@query("clean_coverage", with_(COVERAGE) + f"SELECT {_cols(COVERAGE_COLUMNS)} FROM coverage")
def clean_coverage(spark, sf):
    table = cleaning.clean_coverage(roles.landed(spark, sf, "coverage"), scale=SCALE)
    return table.select(*COVERAGE_COLUMNS)


@query("muni_connectivity", with_(LEVELS) + f"SELECT {_cols(LEVEL_COLUMNS)} FROM levels")
def muni_connectivity(spark, sf):
    table = municipal.connectivity(roles.access(spark, sf), roles.coverage(spark, sf), error=None, scale=SCALE)
    return table.select(*LEVEL_COLUMNS)


@query("muni_profile", with_(STUDENTS, PROFILE) + "SELECT * FROM profile")
def muni_profile(spark, sf):
    return municipal.student_profile(roles.students(spark, sf), digits=DIGITS, scale=SCALE)


@query(
    "pipeline_end_to_end",
    with_(ALL_TABLES)
    + f"""SELECT 'students' AS tbl, count(*) AS n_rows, count(DISTINCT cod_municipio_norm) AS n_keys,
      {total('punt_global')} AS checksum FROM students
    UNION ALL SELECT 'access', count(*), count(DISTINCT cod_municipio_norm),
      {total('no_de_accesos')} FROM access
    UNION ALL SELECT 'coverage', count(*), count(DISTINCT cod_municipio_norm),
      {total('cobertura_bruta')} FROM coverage
    UNION ALL SELECT 'levels', count(*), count(DISTINCT cod_municipio_norm),
      {total('total_accesos_internet')} FROM levels""",
)
def pipeline_end_to_end(spark, sf):
    """Cleans the three tables, writes all four results, and reports from the written files."""
    from ..plans.pipeline import run_pipeline
    from ..session import fresh_path

    out = run_pipeline(
        roles.landed(spark, sf, "students"),
        roles.landed(spark, sf, "access"),
        roles.landed(spark, sf, "coverage"),
        fresh_path(spark, "clean"),
        outlier_error=None,
        scale=SCALE,
        columns=roles.COLUMNS,
    )
    checks = {
        "students": C.SCORE,
        "access": "no_de_accesos",
        "coverage": "cobertura_bruta",
        "levels": "total_accesos_internet",
    }
    parts = [
        out[name].agg(
            F.lit(name).alias("tbl"),
            F.count("*").alias("n_rows"),
            F.count_distinct(C.KEY).alias("n_keys"),
            F.sum(F.col(column).cast(f"decimal(28,{SCALE})")).cast("double").alias("checksum"),
        )
        for name, column in checks.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(
    "q1_score_by_level",
    with_(ALL_TABLES)
    + f"""SELECT nivel_conectividad_municipio, count(*) AS n_estudiantes,
      round({mean('punt_global')}, 5) AS punt_global_prom,
      round(stddev_samp(punt_global), 5) AS punt_global_std
    FROM {FANOUT} WHERE nivel_conectividad_municipio IS NOT NULL GROUP BY 1""",
)
def q1_score_by_level(spark, sf):
    return questions.score_by_level(
        roles.students(spark, sf), roles.levels(spark, sf), digits=DIGITS, scale=SCALE
    )


@query(
    "q2_flag_effect",
    with_(STUDENTS)
    + f"""SELECT flag_internet_hogar, count(*) AS n_estudiantes,
      round({mean('punt_global')}, 5) AS punt_global_prom,
      round({mean('punt_matematicas')}, 5) AS punt_matematicas_prom,
      (SELECT round(corr(flag_internet_hogar, punt_global), 5) FROM students) AS correlacion
    FROM students WHERE flag_internet_hogar IS NOT NULL GROUP BY 1""",
)
def q2_flag_effect(spark, sf):
    students = roles.students(spark, sf)
    corr = questions.household_correlation(students, DIGITS).first()["corr"]
    table = questions.household_effect(students, DIGITS, SCALE)
    return table.withColumn("correlacion", F.lit(corr).cast("double"))


PERFORMANCE = f"""performance AS (
  SELECT *, CASE tercil_desemp WHEN 1 THEN 'bajo' WHEN 2 THEN 'medio' ELSE 'alto' END
    AS nivel_desempeno
  FROM (SELECT *, ntile(3) OVER (ORDER BY punt_global_muni NULLS FIRST, cod_municipio_norm)::INTEGER
      AS tercil_desemp
    FROM (SELECT cod_municipio_norm, {mean('punt_global')} AS punt_global_muni FROM students
      GROUP BY 1)))"""


@query(
    "ntile_terciles",
    with_(STUDENTS, PERFORMANCE)
    + """SELECT cod_municipio_norm, round(punt_global_muni, 5) AS punt_global_muni,
      tercil_desemp, nivel_desempeno FROM performance""",
)
def ntile_terciles(spark, sf):
    table = questions.municipal_performance(roles.students(spark, sf), SCALE)
    return table.withColumn("punt_global_muni", F.round("punt_global_muni", DIGITS)).select(
        C.KEY, "punt_global_muni", "tercil_desemp", "nivel_desempeno"
    )


@query(
    "q3_tech_by_tercile",
    with_(STUDENTS, ACCESS, PERFORMANCE)
    + f"""SELECT nivel_desempeno, tecnologia, total_accesos, position FROM (
      SELECT *, row_number() OVER (PARTITION BY nivel_desempeno
        ORDER BY total_accesos DESC NULLS LAST, tecnologia)::INTEGER AS position
      FROM (SELECT nivel_desempeno, tecnologia, {total('no_de_accesos')} AS total_accesos
        FROM access JOIN performance USING (cod_municipio_norm) GROUP BY ALL))
    WHERE position <= 5""",
)
def q3_tech_by_tercile(spark, sf):
    performance = questions.municipal_performance(roles.students(spark, sf), SCALE)
    return questions.technology_mix(roles.access(spark, sf), performance, scale=SCALE)


@query(
    "q3_speed_by_tercile",
    with_(STUDENTS, ACCESS, PERFORMANCE)
    + """SELECT nivel_desempeno, categoria_velocidad_bajada, count(*) AS n_accesos
    FROM access JOIN performance USING (cod_municipio_norm)
    WHERE categoria_velocidad_bajada IS NOT NULL GROUP BY ALL""",
)
def q3_speed_by_tercile(spark, sf):
    performance = questions.municipal_performance(roles.students(spark, sf), SCALE)
    return questions.speed_mix(roles.access(spark, sf), performance)


GAP = f"""SELECT nivel_conectividad_municipio, "OFICIAL", "NO OFICIAL",
      round("NO OFICIAL" - "OFICIAL", 5) AS brecha
    FROM (SELECT nivel_conectividad_municipio,
      round({mean("CASE WHEN cole_naturaleza = 'OFICIAL' THEN punt_global END")}, 5) AS "OFICIAL",
      round({mean("CASE WHEN cole_naturaleza = 'NO OFICIAL' THEN punt_global END")}, 5)
        AS "NO OFICIAL"
    FROM {FANOUT} WHERE nivel_conectividad_municipio IS NOT NULL
      AND cole_naturaleza IN ('OFICIAL', 'NO OFICIAL') GROUP BY 1)"""


def _gap(spark, sf):
    return questions.school_gap(
        roles.students(spark, sf), roles.levels(spark, sf), digits=DIGITS, scale=SCALE
    )


query("q4_gap_by_level", with_(ALL_TABLES) + GAP)(_gap)

DROPOUT = f"""dropout AS (
  SELECT l.cod_municipio_norm, nivel_conectividad_municipio, accesos_por_habitante,
    desercion_prom, punt_global_muni
  FROM levels l
  JOIN (SELECT cod_municipio_norm, {mean('deserci_n')} AS desercion_prom FROM coverage
    WHERE deserci_n IS NOT NULL GROUP BY 1) USING (cod_municipio_norm)
  JOIN (SELECT cod_municipio_norm, {mean('punt_global')} AS punt_global_muni FROM students
    GROUP BY 1) USING (cod_municipio_norm))"""


@query(
    "q5_three_way",
    with_(ALL_TABLES, DROPOUT)
    + """SELECT nivel_conectividad_municipio, count(*) AS n_municipios,
      round(avg(desercion_prom), 5) AS desercion_prom,
      round(avg(punt_global_muni), 5) AS punt_global_prom
    FROM dropout WHERE nivel_conectividad_municipio IS NOT NULL GROUP BY 1""",
)
def q5_three_way(spark, sf):
    table = questions.dropout_table(
        roles.students(spark, sf), roles.levels(spark, sf), roles.coverage(spark, sf), SCALE
    )
    return questions.dropout_by_level(table, DIGITS)


@query(
    "q5_correlations",
    with_(ALL_TABLES, DROPOUT)
    + """SELECT 'accesos_por_habitante' AS a, 'desercion_prom' AS b,
      round(corr(accesos_por_habitante, desercion_prom), 5) AS corr FROM dropout
    UNION ALL SELECT 'accesos_por_habitante', 'punt_global_muni',
      round(corr(accesos_por_habitante, punt_global_muni), 5) FROM dropout
    UNION ALL SELECT 'desercion_prom', 'punt_global_muni',
      round(corr(desercion_prom, punt_global_muni), 5) FROM dropout""",
)
def q5_correlations(spark, sf):
    table = questions.dropout_table(
        roles.students(spark, sf), roles.levels(spark, sf), roles.coverage(spark, sf), SCALE
    )
    return questions.dropout_correlations(table, DIGITS)


@query(
    "q6_median_split",
    with_(COVERAGE)
    + f"""SELECT CASE WHEN sedes_conectadas_a_internet >= m THEN 'alta conexion de sedes'
        ELSE 'baja conexion de sedes' END AS grupo_sedes, count(*) AS n_municipios,
      round({mean('cobertura_neta')}, 5) AS cobertura_neta_prom
    FROM coverage, (SELECT quantile_cont(sedes_conectadas_a_internet, 0.5) AS m FROM coverage
      WHERE cobertura_neta IS NOT NULL)
    WHERE sedes_conectadas_a_internet IS NOT NULL AND cobertura_neta IS NOT NULL GROUP BY 1""",
)
def q6_median_split(spark, sf):
    return questions.connected_sites(roles.coverage(spark, sf), error=None, digits=DIGITS, scale=SCALE)


@query(
    "q6_correlation",
    with_(COVERAGE)
    + """SELECT count(CASE WHEN sedes_conectadas_a_internet IS NOT NULL AND cobertura_neta IS NOT NULL THEN 1 END) AS n,
      round(corr(sedes_conectadas_a_internet, cobertura_neta), 5) AS corr FROM coverage""",
)
def q6_correlation(spark, sf):
    return questions.sites_correlation(roles.coverage(spark, sf), DIGITS)


@query(
    "q6_completeness",
    with_(COVERAGE)
    + """SELECT count(*) AS n_total, n_known, n_known * 100.0::DOUBLE / count(*) AS pct_known
    FROM coverage, (SELECT count(*) AS n_known FROM coverage
      WHERE sedes_conectadas_a_internet IS NOT NULL AND cobertura_neta IS NOT NULL) GROUP BY n_known""",
)
def q6_completeness(spark, sf):
    return questions.sites_completeness(roles.coverage(spark, sf))


def _areas() -> str:
    parts = []
    for s in C.SUBJECTS:
        high = mean(f"CASE WHEN nivel_conectividad_municipio = 'alta' THEN {s} END", 6)
        low = mean(f"CASE WHEN nivel_conectividad_municipio = 'baja' THEN {s} END", 6)
        parts.append(f"SELECT '{s}' AS area, round({high}, 5) AS alta, round({low}, 5) AS baja FROM j")
    return " UNION ALL ".join(parts)


@query(
    "q7_gap_by_subject",
    with_(ALL_TABLES, f"j AS MATERIALIZED (SELECT * FROM {FANOUT})")
    + f"SELECT *, round(alta - baja, 5) AS brecha FROM ({_areas()})",
)
def q7_gap_by_subject(spark, sf):
    return questions.subject_gap(
        roles.students(spark, sf), roles.levels(spark, sf), digits=5, scale=6
    )


ZONED = """zoned AS (SELECT *, CASE WHEN cole_area_ubicacion IN ('URBANO', 'URBANA') THEN 'URBANO'
  WHEN cole_area_ubicacion = 'RURAL' THEN 'RURAL' END AS zone FROM students)"""


@query(
    "q8_two_factor",
    with_(STUDENTS, ZONED)
    + f"""SELECT zone AS cole_area_ubicacion, flag_internet_hogar, count(*) AS n_estudiantes,
      round({mean('punt_global')}, 5) AS punt_global_prom
    FROM zoned WHERE zone IS NOT NULL AND flag_internet_hogar IS NOT NULL GROUP BY ALL""",
)
def q8_two_factor(spark, sf):
    return questions.zone_and_household(roles.students(spark, sf), DIGITS, SCALE)


@query(
    "q8_zone_gap",
    with_(STUDENTS, ZONED)
    + f"""SELECT zone AS cole_area_ubicacion, round({mean('punt_global')}, 5) AS punt_global_prom
    FROM zoned WHERE zone IS NOT NULL GROUP BY 1""",
)
def q8_zone_gap(spark, sf):
    return questions.zone_gap(roles.students(spark, sf), DIGITS, SCALE)


YEARLY = ["cobertura_neta", "cobertura_bruta", "deserci_n", "sedes_conectadas_a_internet"]


@query(
    "yearly_means",
    with_(COVERAGE)
    + "SELECT year_int, "
    + ", ".join(f"round({mean(c, 5)}, 5) AS {c}" for c in YEARLY)
    + " FROM coverage GROUP BY 1 HAVING "
    + " OR ".join(f"count({c}) > 0" for c in YEARLY),
)
def yearly_means(spark, sf):
    return questions.yearly_means(roles.coverage(spark, sf), YEARLY, 5, 6)


@query(
    "join_inner_muni_year",
    with_(STUDENTS, LEVELS)
    + """SELECT estu_consecutivo, cod_municipio_norm, year_icfes, nivel_conectividad_municipio
    FROM students s JOIN levels l USING (cod_municipio_norm)
    WHERE s.year_icfes = l.year_int""",
)
def join_inner_muni_year(spark, sf):
    dim = roles.levels(spark, sf).select(C.KEY, C.YEAR, C.LEVEL)
    fact = roles.students(spark, sf).select("estu_consecutivo", C.KEY, C.STUDENT_YEAR)
    return fact_to_yearly(fact, dim, C.KEY, C.STUDENT_YEAR, C.YEAR, "same_year")


@query(
    "join_fanout",
    with_(STUDENTS, LEVELS)
    + f"""SELECT estu_consecutivo, cod_municipio_norm, year_icfes, year_int,
      nivel_conectividad_municipio FROM {FANOUT}""",
)
def join_fanout(spark, sf):
    dim = roles.levels(spark, sf).select(C.KEY, C.YEAR, C.LEVEL)
    fact = roles.students(spark, sf).select("estu_consecutivo", C.KEY, C.STUDENT_YEAR)
    return fact_to_yearly(fact, dim, C.KEY, C.STUDENT_YEAR, C.YEAR, "fanout")


@query(
    "join_latest_year",
    with_(STUDENTS, LEVELS)
    + """SELECT estu_consecutivo, cod_municipio_norm, year_icfes, year_int,
      nivel_conectividad_municipio
    FROM students JOIN (SELECT * FROM levels QUALIFY row_number() OVER (
      PARTITION BY cod_municipio_norm ORDER BY year_int DESC) = 1) USING (cod_municipio_norm)""",
)
def join_latest_year(spark, sf):
    dim = roles.levels(spark, sf).select(C.KEY, C.YEAR, C.LEVEL)
    fact = roles.students(spark, sf).select("estu_consecutivo", C.KEY, C.STUDENT_YEAR)
    return fact_to_yearly(fact, dim, C.KEY, C.STUDENT_YEAR, C.YEAR, "latest")


MODEL_ROWS = """model_rows AS (
  SELECT estu_consecutivo, cod_municipio_norm, year_icfes, punt_global, flag_internet_hogar,
    trim(cole_jornada) AS cole_jornada, trim(fami_estratovivienda) AS fami_estratovivienda,
    trim(nivel_conectividad_municipio) AS nivel_conectividad_municipio, total_accesos_internet,
    cobertura_neta, accesos_por_habitante, trim(departamento) AS departamento,
    accesos_por_habitante IS NOT NULL AS has_muni_features
  FROM students s LEFT JOIN (SELECT cod_municipio_norm, year_int AS year_icfes,
      total_accesos_internet, cobertura_neta, accesos_por_habitante,
      nivel_conectividad_municipio, departamento FROM levels)
    USING (cod_municipio_norm, year_icfes))"""
MODEL_COLUMNS = [
    "estu_consecutivo", C.KEY, C.STUDENT_YEAR, C.SCORE, C.HOUSEHOLD_FLAG, "cole_jornada",
    "fami_estratovivienda", C.LEVEL, "total_accesos_internet", "cobertura_neta", C.RATIO,
    "departamento", "has_muni_features",
]


@query("ml_dataset", with_(ALL_TABLES, MODEL_ROWS) + "SELECT * FROM model_rows")
def ml_dataset(spark, sf):
    table = dataset.model_table(
        roles.students(spark, sf), roles.levels(spark, sf), "estu_consecutivo"
    )
    return table.select(*MODEL_COLUMNS)


@query(
    "join_left_dim",
    with_(ALL_TABLES, MODEL_ROWS)
    + """SELECT estu_consecutivo, cod_municipio_norm, year_icfes, accesos_por_habitante,
      has_muni_features FROM model_rows""",
)
def join_left_dim(spark, sf):
    from ..operators.joins import left_with_flag

    dim = dataset.municipal_inputs(roles.levels(spark, sf)).select(C.KEY, C.STUDENT_YEAR, C.RATIO)
    fact = roles.students(spark, sf).select("estu_consecutivo", C.KEY, C.STUDENT_YEAR)
    return left_with_flag(fact, dim, [C.KEY, C.STUDENT_YEAR], "has_muni_features", C.RATIO)


@query(
    "join_match_rate",
    with_(ALL_TABLES, MODEL_ROWS)
    + """SELECT year_icfes, count(*) AS n_rows, sum(has_muni_features::INTEGER)::BIGINT AS n_matched,
      sum(has_muni_features::INTEGER) * 100.0::DOUBLE / count(*) AS pct_matched
    FROM model_rows GROUP BY 1""",
)
def join_match_rate(spark, sf):
    return match_rate(join_left_dim(spark, sf), "has_muni_features", [C.STUDENT_YEAR])


COMBINED = f"""combined AS MATERIALIZED (
  SELECT l.*, p.* EXCLUDE (cod_municipio_norm, year_int), round(velocidad, 5) AS velocidad_bajada
  FROM levels l JOIN profile p USING (cod_municipio_norm, year_int)
  LEFT JOIN (SELECT cod_municipio_norm, year_int, {mean('velocidad_bajada')} AS velocidad
    FROM access WHERE year_int IS NOT NULL GROUP BY ALL) USING (cod_municipio_norm, year_int))"""
COMBINED_COLUMNS = [
    C.KEY, C.YEAR, C.LEVEL, "n_estudiantes", "puntaje_global_promedio", "velocidad_bajada",
]


@query(
    "join_inner_then_left",
    with_(ALL_TABLES, PROFILE, COMBINED) + f"SELECT {_cols(COMBINED_COLUMNS)} FROM combined",
)
def join_inner_then_left(spark, sf):
    table = municipal.combined_features(
        roles.levels(spark, sf), roles.students(spark, sf), roles.access(spark, sf), DIGITS, SCALE
    )
    return table.withColumn("velocidad_bajada", F.round("velocidad_bajada", DIGITS)).select(
        *COMBINED_COLUMNS
    )


def features(spark, sf):
    """Anomaly feature table, with float columns at a fixed number of digits."""
    table = municipal.anomaly_features(
        roles.levels(spark, sf),
        roles.students(spark, sf),
        roles.access(spark, sf),
        error=None,
        digits=DIGITS,
        scale=SCALE,
    )
    return table.withColumns({c: F.round(c, DIGITS) for c in C.ANOMALY_FEATURES})


FEATURES = "features AS MATERIALIZED (SELECT {ids}, {cols} FROM combined)".format(
    ids=_cols(C.ANOMALY_IDS),
    cols=", ".join(
        f"round(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM combined), 0.0), 5) AS {c}"
        for c in C.ANOMALY_FEATURES
    ),
)
FEATURE_TABLES = f"{ALL_TABLES},\n{PROFILE},\n{COMBINED},\n{FEATURES}"

query("anomaly_features", with_(FEATURE_TABLES) + "SELECT * FROM features")(features)


@query(
    "unpivot_long",
    with_(COVERAGE)
    + " UNION ALL ".join(
        f"SELECT cod_municipio_norm, year_int, '{c}' AS feature, {c} AS value FROM coverage"
        for c in YEARLY
    ),
)
def unpivot_long(spark, sf):
    return to_long(roles.coverage(spark, sf), [C.KEY, C.YEAR], YEARLY)
