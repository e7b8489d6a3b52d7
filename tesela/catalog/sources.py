"""Queries for readers, writers and source bookkeeping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exact import exact_mean
from ..session import fresh_path
from ..sources import files, pages
from ..sources.files import TABLES, read_table
from ..streaming.ingest import ingest_new_files
from .registry import query

EVENT_SCHEMA = "event_id long, user_id long, event_type string, value double, props string"
EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value", "props"]
EVENT_SQL = "SELECT event_id, user_id, event_type, value, props FROM events"
PAGE = 500


def _events(spark, sf):
    return read_table(spark, sf, "events").select(*EVENT_COLUMNS)


@query("scan_jsonl", EVENT_SQL)
def scan_jsonl(spark, sf):
    path = files.write_json(_events(spark, sf), fresh_path(spark, "jsonl"))
    return files.read_jsonl(spark, path, EVENT_SCHEMA)


@query("scan_parquet", "SELECT * FROM customer")
def scan_parquet(spark, sf):
    return read_table(spark, sf, "customer")


@query("sink_parquet_roundtrip", "SELECT * FROM orders")
def sink_parquet_roundtrip(spark, sf):
    orders = read_table(spark, sf, "orders")
    path = files.write_parquet(orders, fresh_path(spark, "parquet"), ["o_orderstatus"])
    return spark.read.schema(orders.schema).parquet(path)


@query("sink_compacted", "SELECT * FROM part")
def sink_compacted(spark, sf):
    part = read_table(spark, sf, "part")
    path = files.write_compacted(part, fresh_path(spark, "compacted"), 8)
    return spark.read.schema(part.schema).parquet(path)


@query("sink_csv_roundtrip", "SELECT * FROM supplier")
def sink_csv_roundtrip(spark, sf):
    supplier = read_table(spark, sf, "supplier")
    path = files.write_csv(supplier, fresh_path(spark, "csv"))
    return files.read_csv(spark, path, supplier.schema)


@query(
    "sink_json_metrics",
    """SELECT o_orderpriority AS target, count(*) AS n_test,
      sum(o_totalprice::DECIMAL(28,2))::DOUBLE / count(*) AS mean, max(o_totalprice) AS max
    FROM orders GROUP BY 1""",
)
def sink_json_metrics(spark, sf):
    """Metrics as nested JSON documents, one per class, written and read again."""
    metrics = (
        read_table(spark, sf, "orders")
        .groupBy(F.col("o_orderpriority").alias("target"))
        .agg(
            F.count("*").alias("n_test"),
            F.struct(
                exact_mean("o_totalprice", 2).alias("mean"), F.max("o_totalprice").alias("max")
            ).alias("metrics"),
        )
    )
    path = files.write_json(metrics, fresh_path(spark, "metrics"))
    return files.read_jsonl(spark, path, metrics.schema).select("target", "n_test", "metrics.*")


def _halves(spark, sf):
    """Events before and from the middle of the covered time."""
    events = read_table(spark, sf, "events")
    seconds = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(seconds), F.max(seconds)).first()
    early = seconds * 2 < low + high
    return (
        events.where(early).select(*EVENT_COLUMNS),
        events.where(~early).select(*EVENT_COLUMNS),
    )


EARLY_SQL = """(SELECT *, epoch_us(ts) * 2 < (SELECT min(epoch_us(ts)) + max(epoch_us(ts)) FROM events)
  AS early FROM events)"""


@query(
    "ingest_incremental",
    f"""SELECT event_id, user_id, event_type, value, props,
      CASE WHEN early THEN 1 ELSE 2 END::INTEGER AS run FROM {EARLY_SQL}""",
)
def ingest_incremental(spark, sf):
    """Two landings and three runs; every event is taken once, by the run that first saw it."""
    base = fresh_path(spark, "ingest")
    source, target, checkpoint = f"{base}/in", f"{base}/out", f"{base}/checkpoint"
    for run, landing in enumerate(_halves(spark, sf), start=1):
        landing.write.mode("append").json(source)
        ingest_new_files(spark, source, target, checkpoint, EVENT_SCHEMA, run=run)
    ingest_new_files(spark, source, target, checkpoint, EVENT_SCHEMA, run=3)
    return spark.read.schema(f"{EVENT_SCHEMA}, run int").parquet(target)


def _landed_pages(spark, sf):
    """Pages of the early events, as files in one folder per page."""
    early, _ = _halves(spark, sf)
    path = fresh_path(spark, "pages")
    paged = early.withColumn("part", F.floor(F.col("event_id") / PAGE))
    paged.write.partitionBy("part").json(path)
    return pages.landed_parts(spark, path, EVENT_SCHEMA)


@query(
    "existing_parts",
    f"""SELECT event_id // {PAGE} AS part, count(*) AS n_rows FROM {EARLY_SQL} WHERE early
    GROUP BY 1""",
)
def existing_parts(spark, sf):
    return _landed_pages(spark, sf)


PLAN_SQL = f"""(SELECT p AS part, p * {PAGE} AS start, least({PAGE}, n - p * {PAGE}) AS length
  FROM (SELECT count(*) AS n FROM events), range(0, 1000000) r(p) WHERE p * {PAGE} < n)"""


@query("page_plan", f"SELECT * FROM {PLAN_SQL}")
def page_plan(spark, sf):
    return pages.page_plan(read_table(spark, sf, "events"), PAGE)


@query(
    "pending_parts",
    f"""SELECT * FROM {PLAN_SQL} WHERE part NOT IN
      (SELECT event_id // {PAGE} FROM {EARLY_SQL} WHERE early)""",
)
def pending_parts(spark, sf):
    plan = pages.page_plan(read_table(spark, sf, "events"), PAGE)
    return pages.pending_pages(plan, _landed_pages(spark, sf))


def _all(spark, sf):
    return {name: read_table(spark, sf, name) for name in TABLES}


@query(
    "row_counts",
    " UNION ALL ".join(f"""SELECT '{t}' AS "table", count(*) AS n_rows FROM {t}""" for t in TABLES),
)
def row_counts(spark, sf):
    return files.row_counts(_all(spark, sf))


WIDTH = dict(
    region=2, nation=3, customer=5, supplier=4, part=6, orders=6, lineitem=11, events=6,
    documents=5, embeddings=3, pages=3, benchmark=2, labels=3, conversations=4,
)


@query(
    "table_summary",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", count(*) AS n_rows, {WIDTH[t]}::INTEGER AS n_columns FROM {t}"""
        for t in TABLES
    ),
)
def table_summary(spark, sf):
    return files.table_summary(_all(spark, sf))


@query("table_preview", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 20")
def table_preview(spark, sf):
    """The preview rows that the summary of a table shows."""
    return files.preview(_all(spark, sf)["orders"], ["o_orderkey"])


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def _schema_sql() -> str:
    parts = []
    for table, columns in SCHEMAS.items():
        for i, c in enumerate(columns.split(", "), start=1):
            name, kind = c.split(" ")
            parts.append(
                f"""SELECT '{table}' AS "table", {i}::INTEGER AS position, '{name}' AS "column",
                '{kind}' AS type, count({name}) AS n_known FROM {table}"""
            )
    return " UNION ALL ".join(parts)


@query("schema_listing", _schema_sql())
def schema_listing(spark, sf):
    return files.schema_listing({name: read_table(spark, sf, name) for name in SCHEMAS})

