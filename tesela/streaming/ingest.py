"""Resumable ingestion of JSON lines into Parquet."""

from __future__ import annotations

from threading import Event

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener


# How long to wait for the events of a finished query.
WAIT_SECONDS = 60


class _Counter(StreamingQueryListener):
    """Adds up the progress of all batches of each run."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.batches: dict[str, int] = {}
        self.ended: dict[str, Event] = {}

    def onQueryStarted(self, event) -> None:
        self.ended.setdefault(str(event.runId), Event())

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        self.rows[run] = self.rows.get(run, 0) + event.progress.numInputRows
        self.batches[run] = self.batches.get(run, 0) + 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), Event()).set()


def ingest_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType | str,
    max_files: int | None = None,
    run: int | None = None,
) -> dict[str, int]:
    """Read the files that no earlier run has read, append them to `target`, and stop.

    The stream's checkpoint is the record of finished files, so a failed run goes on where it
    stopped and a repeated one adds nothing.  Needs no pass for schema inference or counting: a
    listener adds up what every batch reports.
    """
    counter = _Counter()
    spark.streams.addListener(counter)
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.json(source)
    if run is not None:
        rows = rows.withColumn("run", F.lit(run))
    query = (
        rows.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    run_id = str(query.runId)
    try:
        query.awaitTermination()
        # Events come in order; the one that tells the end comes after those of all batches.
        if not counter.ended.setdefault(run_id, Event()).wait(WAIT_SECONDS):
            raise TimeoutError("the progress of the query did not arrive")
    finally:
        spark.streams.removeListener(counter)
    return {"new_rows": counter.rows.get(run_id, 0), "batches": counter.batches.get(run_id, 0)}
