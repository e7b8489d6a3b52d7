"""Cleaning of the three raw tables.  Every raw column is text.

The order of the steps is part of the result: a mean is taken after the filters, an outlier
fence before the segment filter.  Every text column is parsed once: the typed rows that pass the
filters on codes and states are written, and the passes for quartiles and means read one numeric
column of that table.  Ranges of parsed numbers are looked at there too, where a filter does not
parse its text again.  A statistic comes to the driver as one or two numbers, so the result is
one scan of the typed table whose fence is pushed into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.parse import normalize_code, parse_columns, period_year, year_or_null, yes_no_flag
from ..functions.classes import speed_class
from ..operators.columns import column_or
from ..operators.filters import (
    contains_or_null,
    drop_value,
    in_range_or_null,
    iqr_filter,
    keep_known,
    keep_status,
)
from ..operators.impute import impute_mean
from ..session import materialise
from . import contract as C


def _code(df: DataFrame, name: str):
    return normalize_code(column_or(df, name, "string"))


def clean_students(
    df: DataFrame,
    status: str = C.PUBLISHED,
    score_range: tuple[float, float] = (0, 500),
    outlier_error: float | None = C.RANK_ERROR,
    scale: int | None = None,
) -> DataFrame:
    """Published, free, located students with a plausible score; English filled by its mean."""
    out = parse_columns(df, C.SCORES).withColumns(
        {
            C.KEY: _code(df, "cole_cod_mcpio_ubicacion"),
            C.STUDENT_YEAR: period_year(column_or(df, "periodo", "string")),
        }
    )
    if "estu_estadoinvestigacion" in df.columns:
        out = keep_status(out, "estu_estadoinvestigacion", status)
    if "estu_privado_libertad" in df.columns:
        out = drop_value(out, "estu_privado_libertad", C.DETAINED)
    out = keep_known(out, C.KEY)
    if "fami_tieneinternet" in df.columns:
        out = out.withColumn(C.HOUSEHOLD_FLAG, yes_no_flag("fami_tieneinternet"))
    out = materialise(out, "typed")
    if C.SCORE in df.columns:
        out = in_range_or_null(out, C.SCORE, *score_range)
    out = iqr_filter(out, C.SCORE, error=outlier_error)
    return impute_mean(out, "punt_ingles", scale)


def clean_access(
    df: DataFrame,
    segment_words: tuple[str, ...] = (C.RESIDENTIAL,),
    outlier_error: float | None = C.RANK_ERROR,
) -> DataFrame:
    """Non-negative access counts without outliers, residential segment, speed class."""
    out = parse_columns(df, C.ACCESS_NUMBERS).withColumns(
        {C.KEY: _code(df, "cod_municipio"), C.YEAR: year_or_null(column_or(df, "anno", "string"))}
    )
    out = materialise(keep_known(out, C.KEY), "typed")
    if "no_de_accesos" in df.columns:
        out = in_range_or_null(out, "no_de_accesos", low=0)
    out = iqr_filter(out, "no_de_accesos", error=outlier_error)
    if "segmento" in df.columns:
        out = contains_or_null(out, "segmento", *segment_words)
    if "velocidad_bajada" in df.columns:
        out = out.withColumn("categoria_velocidad_bajada", speed_class("velocidad_bajada"))
    return out


def clean_coverage(df: DataFrame, scale: int | None = None) -> DataFrame:
    """Located coverage rows; net coverage filled by its mean."""
    out = parse_columns(df, C.COVERAGE_NUMBERS).withColumns(
        {C.KEY: _code(df, "c_digo_municipio"), C.YEAR: year_or_null(column_or(df, "a_o", "string"))}
    )
    return impute_mean(materialise(keep_known(out, C.KEY), "typed"), "cobertura_neta", scale)
