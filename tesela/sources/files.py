"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines.  Without a schema Spark reads everything once more to infer it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_compacted(df: DataFrame, path: str, files: int | None = None) -> str:
    """Write few, evenly sized files.

    With `files`, rows are dealt round robin into that number; upstream keeps its parallelism,
    unlike `coalesce`.  Without it, Spark sizes the files itself (rebalance)."""
    even = df.hint("rebalance") if files is None else df.repartition(files)
    even.write.mode("overwrite").parquet(path)
    return path


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """CSV with header.  A single file is for report-sized tables only."""
    out = df.repartition(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    rows = [
        df.agg(F.lit(name).alias("table"), F.count("*").alias("n_rows"))
        for name, df in tables.items()
    ]
    return _union(rows)


def table_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per table."""
    rows = [
        df.agg(
            F.lit(name).alias("table"),
            F.count("*").alias("n_rows"),
            F.lit(len(df.columns)).alias("n_columns"),
        )
        for name, df in tables.items()
    ]
    return _union(rows)


def preview(table: DataFrame, order: list[str], rows: int = 20) -> DataFrame:
    """The first rows of a table by `order`, for a summary to show beside the counts; columns that
    tell all rows apart make the same rows appear on any layout."""
    return table.orderBy(*order).limit(rows)


def schema_listing(tables: dict[str, DataFrame]) -> DataFrame:
    """Position, name, type and number of known values of every column of every table."""
    parts = []
    for name, df in tables.items():
        entries = [
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.count(F.col(f.name)).alias("n_known"),
            )
            for i, f in enumerate(df.schema.fields, start=1)
        ]
        parts.append(
            df.agg(F.array(*entries).alias("all"))
            .select(F.lit(name).alias("table"), F.explode("all").alias("e"))
            .select("table", "e.*")
        )
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
