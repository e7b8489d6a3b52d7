"""The driver tables in the roles of the three source tables.

Orders with their customers stand for students, line items with supplier and part for internet
accesses, and orders per nation and year for education coverage.  All raw columns are text with
the irregularities that the cleaning has to cope with: blanks, both decimal marks, grouping
points, junk and nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import contract as C
from ..plans.pipeline import clean_table, level_table
from ..session import fresh_path, materialise
from ..sources.files import read_table

SCALE = 2

# The roles' raw columns; line items keep their keys.
COLUMNS = {**C.RAW_COLUMNS, "access": ["l_orderkey", "l_linenumber", *C.RAW_COLUMNS["access"]]}


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("long")


def div(a: Column, b: int | Column) -> Column:
    """Whole-number division of non-negative numbers."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def hundredths(c: Column, mark: str = ".") -> Column:
    """12345 -> '123.45'."""
    whole = div(c, 100).cast("string")
    return F.concat(whole, F.lit(mark), F.lpad((c % 100).cast("string"), 2, "0"))


def grouped(c: Column) -> Column:
    """1234567 -> '1.234.567'."""
    tail = F.lpad((c % 1000).cast("string"), 3, "0")
    middle = div(c, 1000)
    middle_tail = F.lpad((middle % 1000).cast("string"), 3, "0")
    return (
        F.when(c < 1000, c.cast("string"))
        .when(c < 1_000_000, F.concat_ws(".", middle.cast("string"), tail))
        .otherwise(F.concat_ws(".", div(c, 1_000_000).cast("string"), middle_tail, tail))
    )


def orders_customers(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders")
    customer = read_table(spark, sf, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    return orders.join(customer, orders.o_custkey == customer.c_custkey)


def raw_students(spark: SparkSession, sf: str) -> DataFrame:
    status, rank, segment = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("c_mktsegment")
    date, balance, key = F.col("o_orderdate"), F.col("c_acctbal"), F.col("c_nationkey")
    h = F.col("h")
    base = orders_customers(spark, sf).withColumn("h", div(cents("o_totalprice"), 1000))
    half = F.when(F.month(date) <= 6, "1").otherwise("2")
    period = F.concat(F.year(date).cast("string"), half)
    mark_comma = rank == "2-HIGH"
    return base.select(
        F.col("o_orderkey").cast("string").alias("estu_consecutivo"),
        F.when((F.month(date) == 2) & (segment == "BUILDING"), "")
        .when(status == "O", F.concat(F.lit(" "), period, F.lit(" ")))
        .otherwise(period)
        .alias("periodo"),
        F.when(status == "F", "PUBLICAR")
        .when(status == "O", "publicar ")
        .otherwise("PENDIENTE")
        .alias("estu_estadoinvestigacion"),
        F.when((rank == "1-URGENT") & (segment == "MACHINERY"), "s ")
        .when(~((rank == "5-LOW") & (segment == "BUILDING")), "N")
        .alias("estu_privado_libertad"),
        F.when(balance >= 5000, "F").when(balance >= -900, "M").otherwise("-").alias("estu_genero"),
        F.when(balance < -950, F.lit(None).cast("string"))
        .when(key < 5, F.concat(F.lit(" "), key.cast("string")))
        .otherwise(key.cast("string"))
        .alias("cole_cod_mcpio_ubicacion"),
        F.when(segment.isin("AUTOMOBILE", "BUILDING"), "OFICIAL")
        .when(segment.isin("FURNITURE", "HOUSEHOLD"), "NO OFICIAL")
        .alias("cole_naturaleza"),
        F.when(rank.isin("1-URGENT", "5-LOW"), "URBANO")
        .when(rank == "2-HIGH", "URBANA")
        .when(rank == "3-MEDIUM", "RURAL")
        .alias("cole_area_ubicacion"),
        F.when(F.quarter(date) == 1, "MANANA")
        .when(F.quarter(date) == 2, "TARDE")
        .when(F.quarter(date) == 3, "NOCHE")
        .otherwise(" COMPLETA ")
        .alias("cole_jornada"),
        F.when(h >= 40000, "S").otherwise("N").alias("cole_bilingue"),
        F.when(F.month(date) <= 6, "A").otherwise("B").alias("cole_calendario"),
        F.when(rank == "4-NOT SPECIFIED", "Sin Estrato")
        .otherwise(F.concat(F.lit("Estrato "), F.substring(rank, 1, 1)))
        .alias("fami_estratovivienda"),
        F.when(balance > 7000, "Profesional Superior")
        .when(balance > 4000, "secundaria superior")
        .when(balance > 0, "Primaria")
        .alias("fami_educacionmadre"),
        F.when(h > 30000, "Superior completa")
        .when(h > 10000, "Secundaria")
        .alias("fami_educacionpadre"),
        F.when(balance < 0, F.lit(None).cast("string"))
        .when(balance < 3000, "No")
        .when(balance < 6000, "SI ")
        .otherwise("Si")
        .alias("fami_tieneinternet"),
        F.when(h >= 20000, "Si").when(h >= 5000, "No").alias("fami_tienecomputador"),
        F.when(F.dayofmonth(date) > 15, "Si").otherwise("No").alias("fami_tieneautomovil"),
        F.when(F.month(date) >= 10, "9 o mas")
        .otherwise(F.month(date).cast("string"))
        .alias("fami_personashogar"),
        F.quarter(date).cast("string").alias("fami_cuartoshogar"),
        F.when((segment == "MACHINERY") & (rank == "3-MEDIUM"), "")
        .when((rank == "5-LOW") & (h < 2000), "x")
        .when((status == "F") & (h > 49000), "501")
        .when(mark_comma, hundredths(h, ","))
        .otherwise(hundredths(h))
        .alias("punt_global"),
        hundredths(div(h * 3, 4)).alias("punt_matematicas"),
        hundredths(50000 - h).alias("punt_lectura_critica"),
        hundredths(div(h, 2) + 5000, ",").alias("punt_c_naturales"),
        hundredths(div(h + 12500, 2)).alias("punt_sociales_ciudadanas"),
        F.when((rank == "1-URGENT") & (status == "F"), F.lit(None).cast("string"))
        .otherwise(hundredths(div(h * 4, 5)))
        .alias("punt_ingles"),
    )


def raw_access(spark: SparkSession, sf: str) -> DataFrame:
    line = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    supplier = read_table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    part = read_table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    base = line.join(supplier, line.l_suppkey == supplier.s_suppkey).join(
        part, line.l_partkey == part.p_partkey
    )
    date, flag, state = F.col("l_shipdate"), F.col("l_returnflag"), F.col("l_linestatus")
    year = F.year(date).cast("string")
    v = div(cents("l_extendedprice"), 500)
    n = F.col("l_quantity").cast("long") * 53
    many = (F.col("l_quantity") == 50) & (F.col("l_discount") >= 0.1)
    return base.select(
        F.col("l_orderkey"),
        F.col("l_linenumber"),
        F.when((F.col("l_linenumber") == 7) & (flag == "R"), "")
        .when(flag == "A", F.concat(F.lit(" "), year))
        .otherwise(year)
        .alias("anno"),
        F.quarter(date).cast("string").alias("trimestre"),
        F.when(F.col("s_acctbal") >= -900, F.col("s_nationkey").cast("string")).alias(
            "cod_municipio"
        ),
        F.col("p_brand").alias("proveedor"),
        F.when((F.col("p_type") == "PROMO") & (F.col("p_size") <= 2), "SATELITAL")
        .otherwise(F.col("p_type"))
        .alias("tecnologia"),
        F.when(
            flag == "A", F.concat(F.lit("Residencial - Estrato "), F.col("l_linenumber").cast("string"))
        )
        .when((flag == "N") & (state == "O"), "ESTRATO 2")
        .when((flag == "R") & (F.col("l_quantity") < 10), "Uso propio")
        .when((flag == "R") & (state == "F"), "Corporativo")
        .when(flag == "R", "Empresas")
        .alias("segmento"),
        F.when((F.col("l_discount") > 0) | (F.col("l_tax") > 0), hundredths(v, ",")).alias(
            "velocidad_bajada"
        ),
        hundredths(div(v, 4)).alias("velocidad_subida"),
        F.when((F.col("l_linenumber") == 1) & (F.col("l_quantity") == 1), "-5")
        .when(many, grouped(n * 1000))
        .otherwise(grouped(n))
        .alias("no_de_accesos"),
    )


def raw_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Orders are summed per customer and year before the join, so that a customer with very
    many orders brings few rows to it."""
    orders = read_table(spark, sf, "orders")
    per_customer = orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        F.count("*").alias("n"), F.sum(cents("o_totalprice")).alias("s")
    )
    customer = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    per_nation = (
        per_customer.join(customer, per_customer.o_custkey == customer.c_custkey)
        .groupBy("c_nationkey", "year")
        .agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    )
    nation = read_table(spark, sf, "nation")
    region = read_table(spark, sf, "region")
    named = per_nation.join(nation, per_nation.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    n, s, key, year, area = (F.col(c) for c in ("n", "s", "c_nationkey", "year", "r_name"))
    net = div(s, n * 5000)
    drop = div(s, 1000) % 1500
    known = area.isin("AMERICA", "EUROPE", "MIDDLE EAST")
    return named.select(
        key.cast("string").alias("c_digo_municipio"),
        F.when(year == 1999, F.concat(F.lit(" "), year.cast("string")))
        .otherwise(year.cast("string"))
        .alias("a_o"),
        F.col("n_name").alias("municipio"),
        area.alias("departamento"),
        F.when(key == 3, "0").when(key != 4, grouped(n * 10)).alias("poblaci_n_5_16"),
        F.when((area == "AFRICA") & (year == 1996), "").otherwise(hundredths(net, ",")).alias(
            "cobertura_neta"
        ),
        hundredths(net + n % 100).alias("cobertura_bruta"),
        F.when(year != 2001, hundredths(drop)).alias("deserci_n"),
        hundredths(div(drop, 2)).alias("deserci_n_primaria"),
        hundredths(div(drop, 3)).alias("deserci_n_secundaria"),
        hundredths(10000 - drop).alias("aprobaci_n"),
        hundredths(n * 7 % 900).alias("reprobaci_n"),
        hundredths(n * 13 % 700).alias("repitencia"),
        F.when(known, hundredths(div(s, 777) % 10000)).alias("sedes_conectadas_a_internet"),
        hundredths(n % 4000).alias("tama_o_promedio_de_grupo"),
    )


_RAW: dict[tuple[str, str, str], DataFrame] = {}
_LAYERS: dict[tuple[str, str], dict[str, DataFrame]] = {}
_FOLDERS: dict[tuple[str, str], str] = {}

_BUILDERS = {"students": raw_students, "access": raw_access, "coverage": raw_coverage}


def landed(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A raw text table as Parquet, written once per application.

    Cleaning reads some columns of it several times (quartiles, mean, result)."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _RAW:
        _RAW[key] = materialise(_BUILDERS[name](spark, sf), f"raw-{name}")
    return _RAW[key]


def clean(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table of the clean layer, written once per application and read by every question.

    This is the layout of the work: raw tables are cleaned once, and the analyses read the
    clean Parquet tables.  A table is made when the first question asks for it, so a question
    about coverage does not wait for the accesses."""
    key = (spark.sparkContext.applicationId, sf)
    layer = _LAYERS.setdefault(key, {})
    if name not in layer:
        folder = _FOLDERS.setdefault(key, fresh_path(spark, "clean"))
        if name == "levels":
            tables = clean(spark, sf, "access"), clean(spark, sf, "coverage")
            layer[name] = level_table(*tables, folder, outlier_error=None, scale=SCALE)
        else:
            raw = landed(spark, sf, name)
            layer[name] = clean_table(name, raw, folder, outlier_error=None, scale=SCALE, columns=COLUMNS)
    return layer[name]


def clean_layer(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The four clean tables."""
    return {name: clean(spark, sf, name) for name in (*_BUILDERS, "levels")}


def students(spark: SparkSession, sf: str) -> DataFrame:
    return clean(spark, sf, "students")


def access(spark: SparkSession, sf: str) -> DataFrame:
    return clean(spark, sf, "access")


def coverage(spark: SparkSession, sf: str) -> DataFrame:
    return clean(spark, sf, "coverage")


def levels(spark: SparkSession, sf: str) -> DataFrame:
    return clean(spark, sf, "levels")
