"""The cleaning pipeline from raw tables to four written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.columns import select_present
from ..operators.sampling import sample_rows
from ..sources.files import write_parquet
from . import contract as C
from .cleaning import clean_access, clean_coverage, clean_students
from .municipal import connectivity


def clean_table(
    name: str,
    raw: DataFrame,
    folder: str,
    outlier_error: float | None = C.RANK_ERROR,
    scale: int | None = None,
    columns: dict[str, list[str]] = C.RAW_COLUMNS,
    rows: int | None = None,
) -> DataFrame:
    """Clean one raw table (`students`, `access` or `coverage`), write it below `folder` and
    return it as read back."""
    if name in columns:
        raw = select_present(raw, columns[name])
    if rows is not None:
        raw = sample_rows(raw, rows)
    if name == "students":
        table = clean_students(raw, outlier_error=outlier_error, scale=scale)
    elif name == "access":
        table = clean_access(raw, outlier_error=outlier_error)
    else:
        table = clean_coverage(raw, scale=scale)
    return _written(table, f"{folder}/{name}")


def level_table(
    access: DataFrame,
    coverage: DataFrame,
    folder: str,
    outlier_error: float | None = C.RANK_ERROR,
    scale: int | None = None,
) -> DataFrame:
    """Write the connectivity table of the clean ones below `folder` and return it as read back."""
    return _written(connectivity(access, coverage, error=outlier_error, scale=scale), f"{folder}/levels")


def _written(table: DataFrame, path: str) -> DataFrame:
    return table.sparkSession.read.schema(table.schema).parquet(write_parquet(table, path))


def run_pipeline(
    students: DataFrame,
    access: DataFrame,
    coverage: DataFrame,
    folder: str,
    outlier_error: float | None = C.RANK_ERROR,
    scale: int | None = None,
    columns: dict[str, list[str]] = C.RAW_COLUMNS,
    rows: int | None = None,
) -> dict[str, DataFrame]:
    """Clean, write and return the tables as read back from `folder`.

    `columns` names the raw columns to keep of a table, of which the present ones are read (a
    table that it does not name keeps all); `rows` limits the raw rows of each table, for
    development: those with the smallest hashes, the same ones on any layout.  `outlier_error`
    is the rank error of fences and levels, None for exact ones.  Each table is written once; the
    connectivity table is computed from the written files, so no cleaning step runs twice."""
    raw = {"students": students, "access": access, "coverage": coverage}
    out = {name: clean_table(name, raw[name], folder, outlier_error, scale, columns, rows) for name in raw}
    out["levels"] = level_table(out["access"], out["coverage"], folder, outlier_error, scale)
    return out
