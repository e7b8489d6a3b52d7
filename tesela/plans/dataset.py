"""Model input: students with the features of their municipality and year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parse import normalize_code, parse_columns, period_year, yes_no_flag
from ..operators.columns import column_or, select_present
from ..operators.joins import left_with_flag
from ..operators.sampling import sample_rows
from . import contract as C

# Inputs of the score models and of the student profiles.
CATEGORICAL = [
    C.LEVEL,
    "fami_estratovivienda",
    "fami_educacionmadre",
    "fami_educacionpadre",
    "estu_genero",
    "cole_naturaleza",
    "cole_jornada",
    "cole_area_ubicacion",
    "cole_bilingue",
    "cole_calendario",
    "departamento",
]
PROFILE_CATEGORICAL = [
    *[c for c in CATEGORICAL if c != "departamento"],
    "fami_tienecomputador",
    "fami_tieneautomovil",
    "fami_cuartoshogar",
    "fami_personashogar",
]
NUMERIC = [
    C.HOUSEHOLD_FLAG,
    C.STUDENT_YEAR,
    C.RATIO,
    "total_accesos_internet",
    "cobertura_neta",
]


def municipal_inputs(levels: DataFrame) -> DataFrame:
    return levels.select(
        C.KEY,
        F.col(C.YEAR).alias(C.STUDENT_YEAR),
        "total_accesos_internet",
        "cobertura_neta",
        C.RATIO,
        C.LEVEL,
        "departamento",
    )


def model_table(
    students: DataFrame,
    levels: DataFrame,
    id_column: str,
    sample: int | None = None,
    categorical: list[str] = CATEGORICAL,
) -> DataFrame:
    """Students (all, or a repeatable sample) with municipal features and a match flag."""
    wanted = [id_column, C.KEY, C.STUDENT_YEAR, *C.SCORES, *categorical, *NUMERIC]
    rows = select_present(students, wanted)
    if sample is not None:
        rows = sample_rows(rows, sample, id_column)
    keys = [C.KEY, C.STUDENT_YEAR]
    joined = left_with_flag(rows, municipal_inputs(levels), keys, "has_muni_features", C.RATIO)
    trimmed = {c: F.trim(F.col(c).cast("string")) for c in categorical if c in joined.columns}
    return joined.withColumns(trimmed)


def raw_table(raw: DataFrame, levels: DataFrame, id_column: str) -> DataFrame:
    """The inputs of raw student rows, as `model_table` gives them for cleaned ones: code, year
    and household flag are derived, the municipal features looked up.  No row is left out."""
    derived = parse_columns(raw, C.SCORES).withColumns(
        {
            C.KEY: normalize_code(column_or(raw, "cole_cod_mcpio_ubicacion", "string")),
            C.STUDENT_YEAR: period_year(column_or(raw, "periodo", "string")),
            C.HOUSEHOLD_FLAG: yes_no_flag(column_or(raw, "fami_tieneinternet", "string")),
        }
    )
    return model_table(derived, levels, id_column)


def profiling_table(students: DataFrame, levels: DataFrame, id_column: str, **kw) -> DataFrame:
    """The same for clustering: only students with a score of zero or more."""
    table = model_table(students, levels, id_column, categorical=PROFILE_CATEGORICAL, **kw)
    return table.where(F.col(C.SCORE) >= 0)


def usable_inputs(
    available: list[str], categorical: list[str] = CATEGORICAL
) -> tuple[list[str], list[str]]:
    """Categorical and numeric inputs at hand; no score may help to predict a score."""
    leaks = set(C.SCORES)
    categorical = [c for c in categorical if c in available and c not in leaks]
    numeric = [c for c in dict.fromkeys(NUMERIC) if c in available and c not in leaks]
    return categorical, numeric
