"""Queries for the column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..operators.columns import column_or, feature_presence, select_present, with_defaults
from ..operators.impute import impute_mean, impute_median
from ..operators.quantiles import column_quantiles
from ..sources.files import read_table
from . import roles
from .registry import query
from .sql import RAW_ACCESS, RAW_STUDENTS, code, num, with_


@query(
    "parse_number",
    with_(RAW_ACCESS)
    + f"""SELECT l_orderkey, l_linenumber, no_de_accesos AS raw, {num('no_de_accesos')} AS accesos,
      {num('velocidad_bajada')} AS bajada, {num('velocidad_subida')} AS subida FROM raw_access""",
)
def parse_number(spark, sf):
    return roles.landed(spark, sf, "access").select(
        "l_orderkey",
        "l_linenumber",
        F.col("no_de_accesos").alias("raw"),
        fn.parse_number("no_de_accesos").alias("accesos"),
        fn.parse_number("velocidad_bajada").alias("bajada"),
        fn.parse_number("velocidad_subida").alias("subida"),
    )


@query(
    "cast_comma_decimal",
    with_(RAW_ACCESS)
    + """SELECT l_orderkey, l_linenumber,
      TRY_CAST(replace(velocidad_bajada, ',', '.') AS DOUBLE) AS bajada FROM raw_access""",
)
def cast_comma_decimal(spark, sf):
    return roles.landed(spark, sf, "access").select(
        "l_orderkey", "l_linenumber", fn.comma_decimal("velocidad_bajada").alias("bajada")
    )


@query(
    "try_cast_numeric",
    with_(RAW_STUDENTS)
    + """SELECT estu_consecutivo, TRY_CAST(punt_global AS DOUBLE) AS score,
      TRY_CAST(fami_personashogar AS INTEGER) AS persons FROM raw_students""",
)
def try_cast_numeric(spark, sf):
    return roles.landed(spark, sf, "students").select(
        "estu_consecutivo",
        fn.number_or_null("punt_global").alias("score"),
        fn.number_or_null("fami_personashogar", "int").alias("persons"),
    )


@query(
    "normalize_code",
    with_(RAW_STUDENTS)
    + f"""SELECT estu_consecutivo, {code('cole_cod_mcpio_ubicacion')} AS code,
      {code('estu_consecutivo')} AS id_code FROM raw_students""",
)
def normalize_code(spark, sf):
    return roles.landed(spark, sf, "students").select(
        "estu_consecutivo",
        fn.normalize_code("cole_cod_mcpio_ubicacion").alias("code"),
        fn.normalize_code("estu_consecutivo").alias("id_code"),
    )


@query(
    "period_year",
    with_(RAW_STUDENTS, RAW_ACCESS)
    + """SELECT 'student' AS kind, TRY_CAST(substr(trim(periodo), 1, 4) AS INTEGER) AS year,
      count(*) AS n FROM raw_students GROUP BY ALL
    UNION ALL SELECT 'access', TRY_CAST(trim(anno) AS INTEGER), count(*) FROM raw_access
    GROUP BY ALL""",
)
def period_year(spark, sf):
    a = roles.landed(spark, sf, "students").select(
        F.lit("student").alias("kind"), fn.period_year("periodo").alias("year")
    )
    b = roles.landed(spark, sf, "access").select(
        F.lit("access").alias("kind"), fn.year_or_null("anno").alias("year")
    )
    return a.unionByName(b).groupBy("kind", "year").agg(F.count("*").alias("n"))


@query(
    "flag_yes_no",
    with_(RAW_STUDENTS)
    + """SELECT estu_consecutivo, CASE upper(trim(fami_tieneinternet)) WHEN 'SI' THEN 1
      WHEN 'NO' THEN 0 END::INTEGER AS flag FROM raw_students""",
)
def flag_yes_no(spark, sf):
    return roles.landed(spark, sf, "students").select(
        "estu_consecutivo", fn.yes_no_flag("fami_tieneinternet").alias("flag")
    )


@query(
    "flag_like",
    with_(RAW_STUDENTS)
    + """SELECT estu_consecutivo,
      CASE WHEN fami_educacionmadre LIKE '%Superior%' THEN 1 ELSE 0 END::INTEGER AS superior,
      CASE WHEN cole_area_ubicacion IN ('URBANO', 'URBANA') THEN 1 ELSE 0 END::INTEGER AS urban
    FROM raw_students""",
)
def flag_like(spark, sf):
    return roles.landed(spark, sf, "students").select(
        "estu_consecutivo",
        fn.like_flag("fami_educacionmadre", "%Superior%").alias("superior"),
        fn.equals_flag("cole_area_ubicacion", "URBANO", "URBANA").alias("urban"),
    )


@query(
    "extract_number",
    """SELECT o_orderkey, TRY_CAST(regexp_extract(o_orderpriority, '([0-9]+)', 1) AS DOUBLE) AS stratum,
      TRY_CAST(regexp_extract(o_orderstatus, '([0-9]+)', 1) AS DOUBLE) AS none FROM orders""",
)
def extract_number(spark, sf):
    return read_table(spark, sf, "orders").select(
        "o_orderkey",
        fn.first_number("o_orderpriority").alias("stratum"),
        fn.first_number("o_orderstatus").alias("none"),
    )


@query(
    "bucket_fixed",
    """SELECT event_id, CASE WHEN v IS NULL THEN NULL WHEN v < 10 THEN 'baja'
      WHEN v <= 100 THEN 'media' ELSE 'alta' END AS class
    FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)""",
)
def bucket_fixed(spark, sf):
    v = F.when(F.col("event_type") != "error", F.col("value"))
    return read_table(spark, sf, "events").select("event_id", fn.speed_class(v).alias("class"))


@query(
    "safe_ratio",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_tax > 0 THEN l_discount / l_tax END AS ratio
    FROM lineitem""",
)
def safe_ratio(spark, sf):
    return read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", fn.safe_ratio("l_discount", "l_tax").alias("ratio")
    )


@query(
    "tercile_level",
    """SELECT event_id, CASE WHEN value <= lo THEN 'baja' WHEN value <= hi THEN 'media'
      ELSE 'alta' END AS level
    FROM events, (SELECT quantile_cont(value, 0.33) AS lo, quantile_cont(value, 0.66) AS hi
      FROM events)""",
)
def tercile_level(spark, sf):
    events = read_table(spark, sf, "events").select("event_id", "value")
    low, high = column_quantiles(events, "value", [0.33, 0.66]) or (None, None)
    return events.select("event_id", fn.by_cuts("value", low, high).alias("level"))


@query(
    "median_split",
    """SELECT o_orderkey, CASE WHEN o_totalprice >= m THEN 'high' ELSE 'low' END AS side
    FROM orders, (SELECT quantile_cont(o_totalprice, 0.5) AS m FROM orders)""",
)
def median_split(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    (median,) = column_quantiles(orders, "o_totalprice", [0.5])
    side = fn.median_side("o_totalprice", median, "high", "low")
    return orders.select("o_orderkey", side.alias("side"))


SEGMENT = """CASE WHEN segmento IS NULL THEN 'Sin clasificar'
  WHEN contains(lower(segmento), 'residencial') OR contains(lower(segmento), 'estrato')
    THEN 'Residencial'
  WHEN contains(lower(segmento), 'corporativo') OR contains(lower(segmento), 'empresa')
    THEN 'Corporativo' ELSE 'Otro' END"""


@query(
    "segment_class",
    with_(RAW_ACCESS) + f"SELECT l_orderkey, l_linenumber, {SEGMENT} AS segment FROM raw_access",
)
def segment_class(spark, sf):
    return roles.landed(spark, sf, "access").select(
        "l_orderkey", "l_linenumber", fn.segment_class("segmento").alias("segment")
    )


@query("log_error", "SELECT event_id, round(log10(value + 1e-10), 8) AS log_value FROM events")
def log_error(spark, sf):
    return read_table(spark, sf, "events").select(
        "event_id", F.round(fn.log10_floor("value"), 8).alias("log_value")
    )


@query(
    "clamp",
    """SELECT event_id, greatest(0.0::DOUBLE, least(500.0::DOUBLE, value * 3 - 50)) AS clamped
    FROM events""",
)
def clamp(spark, sf):
    return read_table(spark, sf, "events").select(
        "event_id", fn.clamp(F.col("value") * 3 - 50, 0, 500).alias("clamped")
    )


@query(
    "derive_columns",
    """SELECT o_orderkey AS id, o_totalprice / 1000 AS score, year(o_orderdate)::INTEGER AS year,
      upper(trim(o_orderpriority)) AS priority FROM orders""",
)
def derive_columns(spark, sf):
    orders = read_table(spark, sf, "orders").withColumns(
        {
            "score": F.col("o_totalprice") / 1000,
            "year": F.year("o_orderdate"),
            "priority": F.upper(F.trim("o_orderpriority")),
        }
    )
    return orders.withColumnRenamed("o_orderkey", "id").select("id", "score", "year", "priority")


@query("select_present", "SELECT o_orderkey, o_totalprice FROM orders")
def select_present_(spark, sf):
    wanted = ["o_orderkey", "o_totalprice", "not_there", "o_orderkey"]
    return select_present(read_table(spark, sf, "orders"), wanted)


@query(
    "schema_tolerant",
    """SELECT c_custkey, c_acctbal AS balance, 0.0::DOUBLE AS missing_number,
      NULL::VARCHAR AS missing_text FROM customer""",
)
def schema_tolerant(spark, sf):
    customer = read_table(spark, sf, "customer")
    tolerant = with_defaults(
        customer, {"missing_number": ("double", 0.0), "missing_text": ("string", None)}
    )
    return tolerant.select(
        "c_custkey",
        column_or(customer, "c_acctbal", "double").alias("balance"),
        "missing_number",
        "missing_text",
    )


@query(
    "feature_presence",
    """SELECT 'c_acctbal' AS feature, true AS present, count(c_acctbal) AS n_known FROM customer
    UNION ALL SELECT 'c_phone', false, count(NULL) FROM customer
    UNION ALL SELECT 'c_nationkey', true, count(c_nationkey) FROM customer""",
)
def feature_presence_(spark, sf):
    """Which wanted features a table has, and how many of its rows know them."""
    customer = read_table(spark, sf, "customer")
    wanted = ["c_acctbal", "c_phone", "c_nationkey"]
    known = customer.agg(
        *[F.count(column_or(customer, c, "double")).alias(c) for c in wanted]
    ).unpivot([], wanted, "feature", "n_known")
    return feature_presence(customer, wanted).join(known, "feature")


LABELS = {"F": "Finished", "O": "Open"}


@query(
    "label_map",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open'
      ELSE o_orderstatus END AS status FROM orders""",
)
def label_map(spark, sf):
    return read_table(spark, sf, "orders").select(
        "o_orderkey", fn.label_map("o_orderstatus", LABELS).alias("status")
    )


@query(
    "impute_mean",
    """WITH t AS (SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END
      AS v FROM orders)
    SELECT o_orderkey, coalesce(v, (SELECT sum(v::DECIMAL(28,2))::DOUBLE / count(v) FROM t)) AS v
    FROM t""",
)
def impute_mean_(spark, sf):
    v = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice"))
    table = read_table(spark, sf, "orders").select("o_orderkey", v.alias("v"))
    return impute_mean(table, "v", scale=2)


@query(
    "impute_median",
    """WITH t AS (SELECT o_orderkey,
        CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS price,
        CASE WHEN o_orderstatus <> 'P' THEN o_custkey::DOUBLE END AS cust,
        NULL::DOUBLE AS nothing FROM orders)
    SELECT o_orderkey, coalesce(price, (SELECT quantile_cont(price, 0.5) FROM t)) AS price,
      coalesce(cust, (SELECT quantile_cont(cust, 0.5) FROM t)) AS cust, 0.0::DOUBLE AS nothing
    FROM t""",
)
def impute_median_(spark, sf):
    table = read_table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("double")).alias("cust"),
        F.lit(None).cast("double").alias("nothing"),
    )
    return impute_median(table, ["price", "cust", "nothing"])
