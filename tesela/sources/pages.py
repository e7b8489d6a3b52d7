"""Page plans: which pages of a source exist, which have landed, which are due."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_SIZE = 5000


def page_plan(source: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """part, start and length of every page; the last page takes the remainder.

    The plan has one row per page and is generated in parallel from the source's row count."""
    total = source.agg(F.count("*").alias("total"))
    pages = F.ceil(F.col("total") / page_size)
    every = F.explode(F.sequence(F.lit(0).cast("long"), pages - 1)).alias("part")
    plan = total.where(F.col("total") > 0).select("total", every)
    start = F.col("part") * page_size
    return plan.select(
        "part",
        start.alias("start"),
        F.least(F.lit(page_size), F.col("total") - start).cast("long").alias("length"),
    )


def part_of(path: Column, pattern: str = r"part[_=](\d+)") -> Column:
    return F.regexp_extract(path, pattern, 1).try_cast("long")


def landed_parts(spark: SparkSession, folder: str, schema: str, pattern=r"part[_=](\d+)") -> DataFrame:
    """Part numbers found in the file names below `folder`, with the rows they hold."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).json(folder)
    part = part_of(F.col("_metadata.file_path"), pattern)
    found = rows.select(part.alias("part")).where(F.col("part").isNotNull())
    return found.groupBy("part").agg(F.count("*").alias("n_rows"))


def pending_pages(plan: DataFrame, landed: DataFrame) -> DataFrame:
    return plan.join(landed, ["part"], "left_anti")
