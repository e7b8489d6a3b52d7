"""Queries for filters, aggregates, rankings, samples and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.classes import ordinal, segment_class
from ..operators import aggregates as agg
from ..operators import filters, ranking, sampling
from ..operators.quantiles import quantiles
from ..plans import contract as C
from ..sources.files import read_table
from . import roles
from .registry import query
from .scalars import SEGMENT
from .sql import ACCESS, COVERAGE, RAW_ACCESS, RAW_STUDENTS, mean, total, with_

# --- filters ---------------------------------------------------------------------------------


@query(
    "filter_status",
    with_(RAW_STUDENTS)
    + """SELECT estu_consecutivo FROM raw_students
    WHERE upper(trim(estu_estadoinvestigacion)) = 'PUBLICAR'""",
)
def filter_status(spark, sf):
    raw = roles.landed(spark, sf, "students")
    return filters.keep_status(raw, "estu_estadoinvestigacion", C.PUBLISHED).select(
        "estu_consecutivo"
    )


@query(
    "filter_exclude_nullsafe",
    with_(RAW_STUDENTS)
    + """SELECT estu_consecutivo FROM raw_students
    WHERE upper(trim(estu_privado_libertad)) <> 'S' OR estu_privado_libertad IS NULL""",
)
def filter_exclude_nullsafe(spark, sf):
    raw = roles.landed(spark, sf, "students")
    return filters.drop_value(raw, "estu_privado_libertad", C.DETAINED).select("estu_consecutivo")


@query(
    "filter_notnull",
    with_(RAW_STUDENTS)
    + """SELECT estu_consecutivo FROM raw_students WHERE cole_cod_mcpio_ubicacion IS NOT NULL""",
)
def filter_notnull(spark, sf):
    raw = roles.landed(spark, sf, "students")
    return filters.keep_known(raw, "cole_cod_mcpio_ubicacion").select("estu_consecutivo")


NULLED = "SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS v FROM events"


def _nulled(spark, sf):
    v = F.when(F.col("event_type") != "error", F.col("value"))
    return read_table(spark, sf, "events").select("event_id", v.alias("v"))


@query(
    "filter_range_nullpass",
    f"SELECT * FROM ({NULLED}) WHERE v IS NULL OR v BETWEEN 5 AND 100",
)
def filter_range_nullpass(spark, sf):
    return filters.in_range_or_null(_nulled(spark, sf), "v", 5, 100)


@query(
    "filter_contains",
    with_(RAW_ACCESS)
    + """SELECT l_orderkey, l_linenumber FROM raw_access
    WHERE segmento IS NULL OR contains(lower(trim(segmento)), 'residencial')
      OR contains(lower(trim(segmento)), 'estrato')""",
)
def filter_contains(spark, sf):
    raw = roles.landed(spark, sf, "access")
    kept = filters.contains_or_null(raw, "segmento", "residencial", "estrato")
    return kept.select("l_orderkey", "l_linenumber")


@query(
    "filter_isin",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')",
)
def filter_isin(spark, sf):
    orders = read_table(spark, sf, "orders")
    return filters.keep_members(orders, "o_orderpriority", "1-URGENT", "5-LOW").select(
        "o_orderkey", "o_orderpriority"
    )


@query("filter_label", f"SELECT * FROM ({NULLED}) WHERE v >= 0 AND v <= 50")
def filter_label(spark, sf):
    return filters.keep_label(_nulled(spark, sf), "v", 0, 50)


FENCE = "quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3"
INSIDE = "v IS NULL OR v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"


@query(
    "iqr_filter",
    f"WITH t AS ({NULLED}) SELECT event_id, v FROM t, (SELECT {FENCE} FROM t) WHERE {INSIDE}",
)
def iqr_filter(spark, sf):
    return filters.iqr_filter(_nulled(spark, sf), "v")


@query(
    "iqr_filter_grouped",
    f"""WITH t AS (SELECT event_id, event_type, value AS v FROM events)
    SELECT event_id, event_type, v FROM t JOIN
      (SELECT event_type, {FENCE} FROM t GROUP BY 1) USING (event_type) WHERE {INSIDE}""",
)
def iqr_filter_grouped(spark, sf):
    events = read_table(spark, sf, "events").select("event_id", "event_type", F.col("value").alias("v"))
    return filters.iqr_filter(events, "v", ["event_type"])


@query("iqr_filter_approx")
def iqr_filter_approx(spark, sf):
    return filters.iqr_filter(_nulled(spark, sf), "v", error=0.01)


@query(
    "dropna_any",
    with_(COVERAGE)
    + """SELECT cod_municipio_norm, year_int FROM coverage
    WHERE deserci_n IS NOT NULL AND sedes_conectadas_a_internet IS NOT NULL""",
)
def dropna_any(spark, sf):
    table = roles.coverage(spark, sf)
    kept = filters.drop_any_null(table, ["deserci_n", "sedes_conectadas_a_internet"])
    return kept.select(C.KEY, C.YEAR)


@query(
    "dropna_all",
    with_(COVERAGE)
    + """SELECT cod_municipio_norm, year_int FROM coverage
    WHERE deserci_n IS NOT NULL OR sedes_conectadas_a_internet IS NOT NULL""",
)
def dropna_all(spark, sf):
    table = roles.coverage(spark, sf)
    kept = filters.drop_all_null(table, ["deserci_n", "sedes_conectadas_a_internet"])
    return kept.select(C.KEY, C.YEAR)


# --- aggregates ------------------------------------------------------------------------------


@query(
    "group_count",
    "SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL",
)
def group_count(spark, sf):
    return agg.group_count(read_table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"])


@query(
    "group_sum",
    f"""SELECT l_suppkey, {total('l_quantity')} AS quantity, {total('l_extendedprice')} AS price
    FROM lineitem GROUP BY 1""",
)
def group_sum(spark, sf):
    sums = {"quantity": "l_quantity", "price": "l_extendedprice"}
    return agg.group_sums(read_table(spark, sf, "lineitem"), ["l_suppkey"], sums, 2)


MEANS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "group_mean_multi",
    "SELECT l_partkey, "
    + ", ".join(f"{mean(c)} AS {c}" for c in MEANS)
    + " FROM lineitem GROUP BY 1",
)
def group_mean_multi(spark, sf):
    line = read_table(spark, sf, "lineitem")
    return agg.group_means(line, ["l_partkey"], MEANS, digits=None, scale=2)


@query(
    "null_profile",
    with_(RAW_STUDENTS)
    + "SELECT *, round(n_null * 100.0::DOUBLE / (SELECT count(*) FROM raw_students), 2) AS pct_null FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS n_null FROM raw_students"""
        for c in ("punt_ingles", "fami_educacionmadre", "cole_naturaleza", "periodo")
    )
    + ") WHERE n_null > 0",
)
def null_profile(spark, sf):
    raw = roles.landed(spark, sf, "students")
    return agg.null_profile(
        raw, ["punt_ingles", "fami_educacionmadre", "cole_naturaleza", "periodo"]
    )


@query(
    "quantiles_exact",
    """SELECT "column", n, round(q[1], 6) AS p25, round(q[2], 6) AS p50, round(q[3], 6) AS p90 FROM (
      SELECT 'l_extendedprice' AS "column", count(*) AS n,
        quantile_cont(l_extendedprice, [0.25, 0.5, 0.9]) AS q FROM lineitem
      UNION ALL SELECT 'l_discount', count(*), quantile_cont(l_discount, [0.25, 0.5, 0.9])
      FROM lineitem)""",
)
def quantiles_exact(spark, sf):
    table = quantiles(
        read_table(spark, sf, "lineitem"), ["l_extendedprice", "l_discount"], [0.25, 0.5, 0.9]
    )
    return table.select(
        "column",
        "n",
        *[F.round(F.col("q")[i], 6).alias(n) for i, n in enumerate(("p25", "p50", "p90"))],
    )


@query("quantiles_approx")
def quantiles_approx(spark, sf):
    line = read_table(spark, sf, "lineitem")
    return quantiles(line, ["l_extendedprice", "l_discount"], [0.25, 0.5, 0.9], error=0.01)


def _describe_sql(table: str, columns: list[str], by: str = "") -> str:
    keys = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return " UNION ALL ".join(
        f"""SELECT {keys}'{c}' AS "column", count({c}) AS "count", round({mean(c)}, 6) AS mean,
          round(stddev_samp({c}), 6) AS std, min({c})::DOUBLE AS min,
          round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
          round(quantile_cont({c}, 0.75), 6) AS q75, max({c})::DOUBLE AS max
        FROM {table}{group}"""
        for c in columns
    )


@query("describe_numeric", _describe_sql("lineitem", MEANS))
def describe_numeric(spark, sf):
    return agg.describe(read_table(spark, sf, "lineitem"), MEANS, scale=2)


@query("describe_grouped", _describe_sql("orders", ["o_totalprice"], "o_orderpriority"))
def describe_grouped(spark, sf):
    orders = read_table(spark, sf, "orders")
    return agg.describe(orders, ["o_totalprice"], ["o_orderpriority"], scale=2)


@query(
    "corr_pair",
    f"""SELECT count(v) AS n, round(corr(v, event_id), 6) AS corr FROM ({NULLED})""",
)
def corr_pair(spark, sf):
    return agg.correlation(_nulled(spark, sf), "v", "event_id")


CORR = [
    "cobertura_neta", "cobertura_bruta", "deserci_n", "deserci_n_primaria",
    "deserci_n_secundaria", "aprobaci_n", "reprobaci_n", "repitencia",
    "sedes_conectadas_a_internet",
]


@query(
    "corr_matrix",
    with_(COVERAGE)
    + " UNION ALL ".join(
        f"SELECT '{b}' AS a, '{a}' AS b, round(corr({b}, {a}), 5) AS corr FROM coverage"
        for i, a in enumerate(CORR)
        for b in CORR[i + 1 :]
    ),
)
def corr_matrix(spark, sf):
    return agg.correlation_matrix(roles.coverage(spark, sf), CORR, digits=5)


@query(
    "share_lump_other",
    with_(ACCESS)
    + f""", sums AS (SELECT tecnologia, {total('no_de_accesos')} AS t FROM access GROUP BY 1),
    grand AS (SELECT {total('t')} AS g FROM sums)
    SELECT tecnologia, {total('t')} AS total, {total('t')} / any_value(g) AS share
    FROM (SELECT CASE WHEN t < g * 0.02 THEN 'Otros' ELSE tecnologia END AS tecnologia, t, g
      FROM sums, grand) GROUP BY 1""",
)
def share_lump_other(spark, sf):
    return agg.share_with_rest(roles.access(spark, sf), "tecnologia", "no_de_accesos", scale=2)


@query(
    "pivot_gap",
    f"""SELECT o_orderpriority, "F", "O", round("F" - "O", 5) AS gap FROM (
      SELECT o_orderpriority,
        round({mean("CASE WHEN o_orderstatus = 'F' THEN o_totalprice END")}, 5) AS "F",
        round({mean("CASE WHEN o_orderstatus = 'O' THEN o_totalprice END")}, 5) AS "O"
      FROM orders GROUP BY 1)""",
)
def pivot_gap(spark, sf):
    orders = read_table(spark, sf, "orders")
    table = agg.pivot_means(
        orders, "o_orderpriority", "o_orderstatus", ["F", "O"], "o_totalprice", digits=5, scale=2
    )
    return table.withColumn("gap", F.round(F.col("F") - F.col("O"), 5))


SEGMENTS = ["MACHINERY", "AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]


@query(
    "pivot_ordered",
    "SELECT c_mktsegment, "
    + ", ".join(
        f"""round({mean(f"CASE WHEN o_orderstatus = '{s}' THEN o_totalprice END")}, 5) AS "{s}" """
        for s in "FOP"
    )
    + " FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1",
)
def pivot_ordered(spark, sf):
    return agg.pivot_means(
        roles.orders_customers(spark, sf),
        "c_mktsegment",
        "o_orderstatus",
        ["F", "O", "P"],
        "o_totalprice",
        row_order=SEGMENTS,
        digits=5,
        scale=2,
    )


@query(
    "segment_summary",
    with_(ACCESS)
    + f"""SELECT {SEGMENT} AS segment, {total('no_de_accesos')} AS total,
      round({mean('no_de_accesos')}, 5) AS mean, count(no_de_accesos) AS n FROM access GROUP BY 1""",
)
def segment_summary(spark, sf):
    table = roles.access(spark, sf).withColumn("segment", segment_class("segmento"))
    return agg.value_summary(table, ["segment"], "no_de_accesos", 5, 2)


@query(
    "class_share",
    """SELECT event_type, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM events), 2)
      AS pct FROM events GROUP BY 1""",
)
def class_share(spark, sf):
    return agg.count_with_share(read_table(spark, sf, "events"), ["event_type"])


@query(
    "error_stats",
    """SELECT count(value) AS n, min(value) AS min, max(value) AS max, round(avg(value), 8) AS mean,
      round(stddev_pop(value), 8) AS std, round(quantile_cont(value, 0.25), 8) AS p25,
      round(quantile_cont(value, 0.75), 8) AS p75 FROM events""",
)
def error_stats(spark, sf):
    return agg.population_stats(read_table(spark, sf, "events"), "value")


BIN = "(least(floor((value - lo) * 50 / (hi - lo)), 49) + 1)::INTEGER"
RANGE = "(SELECT min(value) AS lo, max(value) AS hi FROM events)"


@query(
    "histogram",
    f"""SELECT b::INTEGER AS bin, round(lo + (hi - lo) / 50 * (b - 1), 8) AS bin_from,
      round(lo + (hi - lo) / 50 * b, 8) AS bin_to, count(value) AS n
    FROM range(1, 51) r(b) CROSS JOIN {RANGE} LEFT JOIN
      (SELECT value, {BIN} AS bin FROM events, {RANGE}) ON bin = b GROUP BY b, lo, hi""",
)
def histogram(spark, sf):
    table = agg.histogram(read_table(spark, sf, "events"), "value", 50)
    return table.withColumns({c: F.round(c, 8) for c in ("bin_from", "bin_to")})


@query(
    "histogram_by_class",
    f"""SELECT c.event_type, b::INTEGER AS bin, round(lo + (hi - lo) / 50 * (b - 1), 8) AS bin_from,
      round(lo + (hi - lo) / 50 * b, 8) AS bin_to, count(value) AS n
    FROM (SELECT DISTINCT event_type FROM events) c CROSS JOIN range(1, 51) r(b)
    CROSS JOIN {RANGE} LEFT JOIN (SELECT event_type, value, {BIN} AS bin FROM events, {RANGE}) e
      ON e.bin = b AND e.event_type = c.event_type GROUP BY c.event_type, b, lo, hi""",
)
def histogram_by_class(spark, sf):
    table = agg.histogram(read_table(spark, sf, "events"), "value", 50, "event_type")
    return table.withColumns({c: F.round(c, 8) for c in ("bin_from", "bin_to")})


@query(
    "histogram_2d",
    """SELECT (least(floor((l_quantity - x0) * 50 / (x1 - x0)), 49) + 1)::INTEGER AS x_bin,
      (least(floor((l_extendedprice - y0) * 50 / (y1 - y0)), 49) + 1)::INTEGER AS y_bin,
      count(*) AS n
    FROM lineitem, (SELECT min(l_quantity) AS x0, max(l_quantity) AS x1,
      min(l_extendedprice) AS y0, max(l_extendedprice) AS y1 FROM lineitem) GROUP BY ALL""",
)
def histogram_2d(spark, sf):
    return agg.histogram_2d(read_table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", 50)


@query(
    "boxplot_stats",
    """WITH f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM (
      SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
        quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1))
    SELECT event_type, count(*) AS n, round(any_value(q1), 6) AS q1,
      round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
      min(value) FILTER (value BETWEEN low AND high) AS whisker_low,
      max(value) FILTER (value BETWEEN low AND high) AS whisker_high,
      count(*) FILTER (value NOT BETWEEN low AND high) AS n_outliers
    FROM events JOIN f USING (event_type) GROUP BY 1""",
)
def boxplot_stats(spark, sf):
    table = agg.box_plot(read_table(spark, sf, "events"), ["event_type"], "value")
    return table.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@query(
    "mean_ci95",
    f"""SELECT o_orderpriority, count(*) AS n, round({mean('o_totalprice')}, 5) AS mean,
      round({mean('o_totalprice')} - 1.96 * stddev_samp(o_totalprice) / sqrt(count(*)), 5) AS ci_low,
      round({mean('o_totalprice')} + 1.96 * stddev_samp(o_totalprice) / sqrt(count(*)), 5) AS ci_high
    FROM orders GROUP BY 1""",
)
def mean_ci95(spark, sf):
    orders = read_table(spark, sf, "orders")
    return agg.mean_interval(orders, ["o_orderpriority"], "o_totalprice", digits=5, scale=2)


@query(
    "completeness",
    with_(COVERAGE)
    + """SELECT count(*) AS n_total,
      count(CASE WHEN sedes_conectadas_a_internet IS NOT NULL AND deserci_n IS NOT NULL THEN 1 END)
        AS n_known,
      count(CASE WHEN sedes_conectadas_a_internet IS NOT NULL AND deserci_n IS NOT NULL THEN 1 END)
        * 100.0::DOUBLE / count(*) AS pct_known FROM coverage""",
)
def completeness(spark, sf):
    return agg.completeness(
        roles.coverage(spark, sf), ["sedes_conectadas_a_internet", "deserci_n"]
    )


@query(
    "frequent_value",
    """WITH c AS (SELECT l_suppkey, l_returnflag AS v, count(*) AS n FROM lineitem GROUP BY ALL),
    d AS (SELECT l_suppkey, l_linestatus AS v, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT l_suppkey, (SELECT v FROM c WHERE c.l_suppkey = k.l_suppkey ORDER BY n DESC, v LIMIT 1)
      AS l_returnflag,
      (SELECT v FROM d WHERE d.l_suppkey = k.l_suppkey ORDER BY n DESC, v LIMIT 1) AS l_linestatus
    FROM (SELECT DISTINCT l_suppkey FROM lineitem) k""",
)
def frequent_value(spark, sf):
    line = read_table(spark, sf, "lineitem")
    return agg.frequent_value(line, ["l_suppkey"], ["l_returnflag", "l_linestatus"])


# --- rankings and samples --------------------------------------------------------------------


@query(
    "rank_pct_avg",
    """SELECT event_id, round((rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1)
      / 2.0::DOUBLE) / count(*) OVER () * 100, 6) AS pct FROM events""",
)
def rank_pct_avg(spark, sf):
    events = read_table(spark, sf, "events").select("event_id", "value")
    return ranking.average_rank_pct(events, "value", "pct", digits=6).select("event_id", "pct")


@query(
    "global_row_number",
    """SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (
      ORDER BY l_discount, id) AS rn, ntile(7) OVER (ORDER BY l_discount, id)::INTEGER AS tile
    FROM (SELECT *, l_orderkey * 1000000 + l_partkey * 100 + l_linenumber AS id FROM lineitem)""",
)
def global_row_number(spark, sf):
    """Numbering of all line items by discount, a column of few values, each very frequent."""
    line = read_table(spark, sf, "lineitem")
    unique = F.col("l_orderkey") * 1000000 + F.col("l_partkey") * 100 + F.col("l_linenumber")
    keyed = line.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_discount", unique.alias("id")
    )
    tiles = ranking.global_ntile(keyed, 7, "l_discount", "id", "tile", row_number="rn")
    return tiles.select("l_orderkey", "l_linenumber", "l_partkey", "rn", "tile")


@query(
    "topn_per_class",
    """SELECT event_type, event_id, value, position FROM (
      SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id)::INTEGER
        AS position FROM events) WHERE position <= 20""",
)
def topn_per_class(spark, sf):
    events = read_table(spark, sf, "events").select("event_type", "event_id", "value")
    return ranking.top_n_per_group(
        events, ["event_type"], 20, [F.desc("value"), F.asc("event_id")]
    )


@query(
    "topk_groups",
    f"""SELECT l_suppkey, {total('l_quantity')} AS quantity FROM lineitem GROUP BY 1
    ORDER BY 2 DESC, 1 LIMIT 10""",
)
def topk_groups(spark, sf):
    sums = agg.group_sums(
        read_table(spark, sf, "lineitem"), ["l_suppkey"], {"quantity": "l_quantity"}, 2
    )
    return ranking.top_k(sums, 10, F.desc("quantity"), F.asc("l_suppkey"))


@query(
    "ordinal_sort",
    with_(ACCESS) + "SELECT categoria_velocidad_bajada, count(*) AS n FROM access GROUP BY 1",
)
def ordinal_sort(spark, sf):
    access = roles.access(spark, sf)
    return agg.group_count(access, ["categoria_velocidad_bajada"]).orderBy(
        ordinal("categoria_velocidad_bajada")
    )


WORST = f"""SELECT p_brand, {mean('l_tax * 100')} AS tax FROM lineitem
  JOIN part ON l_partkey = p_partkey GROUP BY 1"""


@query(
    "best_worst_k",
    f"""WITH t AS ({WORST}),
    r AS (SELECT *, row_number() OVER (ORDER BY tax, p_brand)::INTEGER AS up,
      row_number() OVER (ORDER BY tax DESC, p_brand DESC)::INTEGER AS down FROM t)
    SELECT 'lowest' AS side, up AS position, p_brand, tax FROM r WHERE up <= 15
    UNION ALL SELECT 'highest', down, p_brand, tax FROM r WHERE down <= 15""",
)
def best_worst_k(spark, sf):
    line = read_table(spark, sf, "lineitem").select("l_partkey", "l_tax")
    part = read_table(spark, sf, "part").select("p_partkey", "p_brand")
    joined = line.join(part, line.l_partkey == part.p_partkey)
    tax = joined.withColumn("tax", F.col("l_tax") * 100)
    return ranking.best_and_worst(
        agg.group_means(tax, ["p_brand"], ["tax"], None, 2), 15, "tax", "p_brand"
    )


MD5 = "('0x' || substr(md5('42' || o_orderkey::VARCHAR), 1, 8))::BIGINT"
MD5_7 = MD5.replace("'42'", "'7'")


@query("sample_n", f"SELECT * FROM orders ORDER BY {MD5_7}, o_orderkey LIMIT 1000")
def sample_n(spark, sf):
    number = sampling.md5_number("o_orderkey", "7")
    return sampling.sample_rows(read_table(spark, sf, "orders"), 1000, "o_orderkey", number)


@query(
    "sample_n_md5",
    f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {MD5}, o_orderkey LIMIT 1000",
)
def sample_n_md5(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    number = sampling.md5_number("o_orderkey", "42")
    return sampling.sample_rows(orders, 1000, "o_orderkey", number)


@query("sample_fraction", f"SELECT * FROM orders WHERE {MD5} < {int(0.05 * 2**32)}")
def sample_fraction(spark, sf):
    number = sampling.md5_number("o_orderkey", "42")
    return sampling.sample_share(read_table(spark, sf, "orders"), 0.05, "o_orderkey", number=number)


@query(
    "argmax_by",
    """SELECT l_suppkey, l_partkey, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_suppkey
      ORDER BY l_extendedprice DESC, l_partkey) = 1""",
)
def argmax_by(spark, sf):
    line = read_table(spark, sf, "lineitem")
    return ranking.arg_max(line, "l_partkey", "l_extendedprice", ["l_suppkey"]).select(
        "l_suppkey", "l_partkey", "l_extendedprice"
    )


@query(
    "limit_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5000",
)
def limit_rows(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return sampling.first_rows(orders, 5000, "o_orderkey")


@query(
    "union_by_name",
    """SELECT 'customer' AS kind, c_nationkey AS nation, c_acctbal AS balance FROM customer
    UNION ALL SELECT 'supplier', s_nationkey, s_acctbal FROM supplier""",
)
def union_by_name(spark, sf):
    a = read_table(spark, sf, "customer").select(
        F.lit("customer").alias("kind"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
    )
    b = read_table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("balance"),
        F.lit("supplier").alias("kind"),
        F.col("s_nationkey").alias("nation"),
    )
    return a.unionByName(b)


@query(
    "split_tagged",
    f"""SELECT o_orderkey, split, split = 'val' AS is_val FROM (SELECT o_orderkey,
      CASE WHEN {MD5} < 3006477107 THEN 'train' WHEN {MD5} < 3650722202 THEN 'val' ELSE 'test' END
        AS split FROM orders)""",
)
def split_tagged(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey")
    return sampling.tag_split(orders, "o_orderkey")


@query(
    "split_random",
    f"""SELECT 'train' AS part, count(*) AS n FROM orders WHERE {MD5_7} < {round(0.8 * 2**32)}
    UNION ALL SELECT 'test', count(*) FROM orders WHERE {MD5_7} >= {round(0.8 * 2**32)}""",
)
def split_random(spark, sf):
    orders = read_table(spark, sf, "orders")
    number = sampling.md5_number("o_orderkey", "7")
    parts = sampling.split_frames(
        orders, "o_orderkey", (0.8, 0.2), ("train", "test"), number=number
    )
    sizes = [
        df.agg(F.lit(name).alias("part"), F.count("*").alias("n")) for name, df in parts.items()
    ]
    return sizes[0].unionByName(sizes[1])
