"""Helpers shared by the operators."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesela.session import fresh_path, materialise

__all__ = ["drop_folder", "fresh_name", "fresh_path", "give_back", "giving_back", "materialise", "read_table", "sized", "text_digest", "text_of", "whole_number"]

#: Up to so many rows of a few short columns are broadcast; more are joined by shuffling.
BROADCAST_ROWS = 500_000


def travels_by_value() -> None:
    """Send the functions of this subpackage to the workers by value, so that workers need
    neither the package nor a shared folder to import it from."""
    cloudpickle.register_pickle_by_value(sys.modules[__package__])


travels_by_value()


def give_back() -> None:
    """Return to the system what this process has freed and its allocators keep."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`run` for a worker that Spark uses again for later stages: memory that the task has freed
    goes back at its end."""

    def task(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return task


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, where null counts as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def whole_number(column: str = "doc_id") -> Column:
    return F.col(f"`{column}`").cast("long")


def text_digest(column: str = "text") -> Column:
    return F.sha2(text_of(column), 256)


def fresh_name(label: str) -> str:
    """A column name that no table of a caller has."""
    return f"_{label}_{uuid.uuid4().hex}"


def sized(table: DataFrame, rows: int | None = None) -> DataFrame:
    """A written table of short rows, to be broadcast if it has at most `rows` of them."""
    return F.broadcast(table) if table.count() <= (BROADCAST_ROWS if rows is None else rows) else table


def drop_folder(spark: SparkSession, table: DataFrame) -> None:
    """Delete the files of a table written by `materialise` that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
