"""SQL fragments from which the reference SQL of the named queries is put together."""

from __future__ import annotations

DOTS = "·∙⋅•․・"


def num(x: str) -> str:
    """Tolerant number parsing of a text expression."""
    t = f"translate(trim({x}), '{DOTS}', '......')"
    plain = (
        f"CASE WHEN contains({t}, ',') THEN replace(replace({t}, '.', ''), ',', '.') "
        f"WHEN regexp_matches({t}, '^[0-9]{{1,3}}\\.[0-9]{{3}}$') OR "
        f"length({t}) - length(replace({t}, '.', '')) >= 2 THEN replace({t}, '.', '') "
        f"ELSE {t} END"
    )
    shape = "^[-+]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][-+]?[0-9]+)?$"
    value = f"TRY_CAST(({plain}) AS DOUBLE)"
    return f"(CASE WHEN regexp_matches(({plain}), '{shape}') AND isfinite({value}) THEN {value} END)"


def code(x: str) -> str:
    return f"lpad(nullif(trim({x}), ''), 5, '0')"


def mean(x: str, scale: int = 2) -> str:
    return f"(sum(CAST({x} AS DECIMAL(28,{scale})))::DOUBLE / nullif(count({x}), 0))"


def total(x: str, scale: int = 2) -> str:
    return f"sum(CAST({x} AS DECIMAL(28,{scale})))::DOUBLE"


def corr(a: str, b: str) -> str:
    return f"corr({a}, {b})"


def hundredths(x: str, mark: str = ".") -> str:
    return f"concat(({x}) // 100, '{mark}', lpad((({x}) % 100)::VARCHAR, 2, '0'))"


def grouped(x: str) -> str:
    tail = f"lpad((({x}) % 1000)::VARCHAR, 3, '0')"
    return (
        f"CASE WHEN ({x}) < 1000 THEN ({x})::VARCHAR "
        f"WHEN ({x}) < 1000000 THEN concat(({x}) // 1000, '.', {tail}) "
        f"ELSE concat(({x}) // 1000000, '.', lpad(((({x}) // 1000) % 1000)::VARCHAR, 3, '0'), "
        f"'.', {tail}) END"
    )


RAW_STUDENTS = f"""raw_students AS (
  SELECT o_orderkey::VARCHAR AS estu_consecutivo,
    CASE WHEN month(o_orderdate) = 2 AND c_mktsegment = 'BUILDING' THEN ''
         WHEN o_orderstatus = 'O' THEN concat(' ', period, ' ') ELSE period END AS periodo,
    CASE o_orderstatus WHEN 'F' THEN 'PUBLICAR' WHEN 'O' THEN 'publicar ' ELSE 'PENDIENTE' END
      AS estu_estadoinvestigacion,
    CASE WHEN o_orderpriority = '1-URGENT' AND c_mktsegment = 'MACHINERY' THEN 's '
         WHEN o_orderpriority = '5-LOW' AND c_mktsegment = 'BUILDING' THEN NULL
         ELSE 'N' END AS estu_privado_libertad,
    CASE WHEN c_acctbal >= 5000 THEN 'F' WHEN c_acctbal >= -900 THEN 'M' ELSE '-' END
      AS estu_genero,
    CASE WHEN c_acctbal < -950 THEN NULL WHEN c_nationkey < 5 THEN concat(' ', c_nationkey)
         ELSE c_nationkey::VARCHAR END AS cole_cod_mcpio_ubicacion,
    CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'OFICIAL'
         WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'NO OFICIAL' END AS cole_naturaleza,
    CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') THEN 'URBANO'
         WHEN o_orderpriority = '2-HIGH' THEN 'URBANA'
         WHEN o_orderpriority = '3-MEDIUM' THEN 'RURAL' END AS cole_area_ubicacion,
    CASE quarter(o_orderdate) WHEN 1 THEN 'MANANA' WHEN 2 THEN 'TARDE' WHEN 3 THEN 'NOCHE'
         ELSE ' COMPLETA ' END AS cole_jornada,
    CASE WHEN h >= 40000 THEN 'S' ELSE 'N' END AS cole_bilingue,
    CASE WHEN month(o_orderdate) <= 6 THEN 'A' ELSE 'B' END AS cole_calendario,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Sin Estrato'
         ELSE concat('Estrato ', substr(o_orderpriority, 1, 1)) END AS fami_estratovivienda,
    CASE WHEN c_acctbal > 7000 THEN 'Profesional Superior'
         WHEN c_acctbal > 4000 THEN 'secundaria superior'
         WHEN c_acctbal > 0 THEN 'Primaria' END AS fami_educacionmadre,
    CASE WHEN h > 30000 THEN 'Superior completa' WHEN h > 10000 THEN 'Secundaria' END
      AS fami_educacionpadre,
    CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 3000 THEN 'No'
         WHEN c_acctbal < 6000 THEN 'SI ' ELSE 'Si' END AS fami_tieneinternet,
    CASE WHEN h >= 20000 THEN 'Si' WHEN h >= 5000 THEN 'No' END AS fami_tienecomputador,
    CASE WHEN day(o_orderdate) > 15 THEN 'Si' ELSE 'No' END AS fami_tieneautomovil,
    CASE WHEN month(o_orderdate) >= 10 THEN '9 o mas' ELSE month(o_orderdate)::VARCHAR END
      AS fami_personashogar,
    quarter(o_orderdate)::VARCHAR AS fami_cuartoshogar,
    CASE WHEN c_mktsegment = 'MACHINERY' AND o_orderpriority = '3-MEDIUM' THEN ''
         WHEN o_orderpriority = '5-LOW' AND h < 2000 THEN 'x'
         WHEN o_orderstatus = 'F' AND h > 49000 THEN '501'
         WHEN o_orderpriority = '2-HIGH' THEN {hundredths('h', ',')}
         ELSE {hundredths('h')} END AS punt_global,
    {hundredths('h * 3 // 4')} AS punt_matematicas,
    {hundredths('50000 - h')} AS punt_lectura_critica,
    {hundredths('h // 2 + 5000', ',')} AS punt_c_naturales,
    {hundredths('(h + 12500) // 2')} AS punt_sociales_ciudadanas,
    CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN NULL
         ELSE {hundredths('h * 4 // 5')} END AS punt_ingles
  FROM (SELECT *, round(o_totalprice * 100)::BIGINT // 1000 AS h,
          concat(year(o_orderdate), CASE WHEN month(o_orderdate) <= 6 THEN '1' ELSE '2' END)
            AS period
        FROM orders JOIN customer ON o_custkey = c_custkey))"""

RAW_ACCESS = f"""raw_access AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN ''
         WHEN l_returnflag = 'A' THEN concat(' ', year(l_shipdate))
         ELSE year(l_shipdate)::VARCHAR END AS anno,
    quarter(l_shipdate)::VARCHAR AS trimestre,
    CASE WHEN s_acctbal >= -900 THEN s_nationkey::VARCHAR END AS cod_municipio,
    p_brand AS proveedor,
    CASE WHEN p_type = 'PROMO' AND p_size <= 2 THEN 'SATELITAL' ELSE p_type END AS tecnologia,
    CASE WHEN l_returnflag = 'A' THEN concat('Residencial - Estrato ', l_linenumber)
         WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'ESTRATO 2'
         WHEN l_returnflag = 'R' AND l_quantity < 10 THEN 'Uso propio'
         WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'Corporativo'
         WHEN l_returnflag = 'R' THEN 'Empresas' END AS segmento,
    CASE WHEN l_discount > 0 OR l_tax > 0 THEN {hundredths('v', ',')} END AS velocidad_bajada,
    {hundredths('v // 4')} AS velocidad_subida,
    CASE WHEN l_linenumber = 1 AND l_quantity = 1 THEN '-5'
         WHEN l_quantity = 50 AND l_discount >= 0.1 THEN {grouped('n * 1000')}
         ELSE {grouped('n')} END AS no_de_accesos
  FROM (SELECT *, round(l_extendedprice * 100)::BIGINT // 500 AS v, l_quantity::BIGINT * 53 AS n
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        JOIN part ON l_partkey = p_partkey))"""

RAW_COVERAGE = f"""raw_coverage AS (
  SELECT c_nationkey::VARCHAR AS c_digo_municipio,
    CASE WHEN year = 1999 THEN concat(' ', year) ELSE year::VARCHAR END AS a_o,
    n_name AS municipio, r_name AS departamento,
    CASE WHEN c_nationkey = 3 THEN '0' WHEN c_nationkey = 4 THEN NULL
         ELSE {grouped('n * 10')} END AS poblaci_n_5_16,
    CASE WHEN r_name = 'AFRICA' AND year = 1996 THEN '' ELSE {hundredths('net', ',')} END
      AS cobertura_neta,
    {hundredths('net + n % 100')} AS cobertura_bruta,
    CASE WHEN year = 2001 THEN NULL ELSE {hundredths('d')} END AS deserci_n,
    {hundredths('d // 2')} AS deserci_n_primaria,
    {hundredths('d // 3')} AS deserci_n_secundaria,
    {hundredths('10000 - d')} AS aprobaci_n,
    {hundredths('n * 7 % 900')} AS reprobaci_n,
    {hundredths('n * 13 % 700')} AS repitencia,
    CASE WHEN r_name IN ('AMERICA', 'EUROPE', 'MIDDLE EAST')
         THEN {hundredths('s // 777 % 10000')} END AS sedes_conectadas_a_internet,
    {hundredths('n % 4000')} AS tama_o_promedio_de_grupo
  FROM (SELECT *, s // (n * 5000) AS net, s // 1000 % 1500 AS d FROM
        (SELECT c_nationkey, year(o_orderdate) AS year, count(*) AS n,
           sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS s
         FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey))"""

SCORES = [
    "punt_global", "punt_matematicas", "punt_lectura_critica", "punt_c_naturales",
    "punt_sociales_ciudadanas", "punt_ingles",
]
COVERAGE_NUMBERS = [
    "cobertura_neta", "cobertura_bruta", "deserci_n", "deserci_n_primaria",
    "deserci_n_secundaria", "aprobaci_n", "reprobaci_n", "repitencia",
    "sedes_conectadas_a_internet", "poblaci_n_5_16", "tama_o_promedio_de_grupo",
]


def _replaced(columns: list[str]) -> str:
    return ", ".join(f"{num(c)} AS {c}" for c in columns)


STUDENTS = f"""{RAW_STUDENTS},
parsed_students AS (
  SELECT * REPLACE ({_replaced(SCORES)}),
    {code('cole_cod_mcpio_ubicacion')} AS cod_municipio_norm,
    TRY_CAST(substr(trim(periodo), 1, 4) AS INTEGER) AS year_icfes
  FROM raw_students),
kept_students AS (
  SELECT * FROM parsed_students
  WHERE upper(trim(estu_estadoinvestigacion)) = 'PUBLICAR'
    AND (upper(trim(estu_privado_libertad)) <> 'S' OR estu_privado_libertad IS NULL)
    AND cod_municipio_norm IS NOT NULL
    AND (punt_global IS NULL OR punt_global BETWEEN 0 AND 500)),
student_fence AS (
  SELECT quantile_cont(punt_global, 0.25) AS q1, quantile_cont(punt_global, 0.75) AS q3
  FROM kept_students),
inner_students AS (
  SELECT k.* FROM kept_students k, student_fence
  WHERE punt_global IS NULL
     OR punt_global BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)),
students AS MATERIALIZED (
  SELECT * REPLACE (coalesce(punt_ingles, (SELECT {mean('punt_ingles')} FROM inner_students))
                    AS punt_ingles),
    CASE upper(trim(fami_tieneinternet)) WHEN 'SI' THEN 1 WHEN 'NO' THEN 0 END::INTEGER
      AS flag_internet_hogar
  FROM inner_students)"""

ACCESS = f"""{RAW_ACCESS},
parsed_access AS (
  SELECT * REPLACE ({_replaced(['no_de_accesos', 'velocidad_bajada', 'velocidad_subida'])}),
    {code('cod_municipio')} AS cod_municipio_norm,
    TRY_CAST(trim(anno) AS INTEGER) AS year_int
  FROM raw_access),
kept_access AS (
  SELECT * FROM parsed_access WHERE cod_municipio_norm IS NOT NULL
    AND (no_de_accesos IS NULL OR no_de_accesos >= 0)),
access_fence AS (
  SELECT quantile_cont(no_de_accesos, 0.25) AS q1, quantile_cont(no_de_accesos, 0.75) AS q3
  FROM kept_access),
access AS MATERIALIZED (
  SELECT k.*, CASE WHEN velocidad_bajada IS NULL THEN NULL WHEN velocidad_bajada < 10 THEN 'baja'
      WHEN velocidad_bajada <= 100 THEN 'media' ELSE 'alta' END AS categoria_velocidad_bajada
  FROM kept_access k, access_fence
  WHERE (no_de_accesos IS NULL
     OR no_de_accesos BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))
    AND (segmento IS NULL OR contains(lower(trim(segmento)), 'residencial')))"""

COVERAGE = f"""{RAW_COVERAGE},
parsed_coverage AS (
  SELECT * REPLACE ({_replaced(COVERAGE_NUMBERS)}),
    {code('c_digo_municipio')} AS cod_municipio_norm,
    TRY_CAST(trim(a_o) AS INTEGER) AS year_int
  FROM raw_coverage),
coverage AS MATERIALIZED (
  SELECT * REPLACE (coalesce(cobertura_neta, (SELECT {mean('cobertura_neta')}
      FROM parsed_coverage WHERE cod_municipio_norm IS NOT NULL)) AS cobertura_neta)
  FROM parsed_coverage WHERE cod_municipio_norm IS NOT NULL)"""

LEVELS = f"""{ACCESS},
{COVERAGE},
ratios AS (
  SELECT *, CASE WHEN poblaci_n_5_16 > 0 THEN total_accesos_internet / poblaci_n_5_16 END
    AS accesos_por_habitante
  FROM (SELECT cod_municipio_norm, year_int, {total('no_de_accesos')} AS total_accesos_internet
        FROM access WHERE year_int IS NOT NULL GROUP BY ALL)
  JOIN (SELECT cod_municipio_norm, year_int, poblaci_n_5_16, cobertura_neta, municipio,
          departamento FROM coverage WHERE year_int IS NOT NULL)
  USING (cod_municipio_norm, year_int)),
levels AS MATERIALIZED (
  SELECT r.*, CASE WHEN accesos_por_habitante IS NULL THEN NULL
      WHEN accesos_por_habitante <= p33 THEN 'baja'
      WHEN accesos_por_habitante <= p66 THEN 'media' ELSE 'alta' END
      AS nivel_conectividad_municipio
  FROM ratios r, (SELECT quantile_cont(accesos_por_habitante, 0.33) AS p33,
      quantile_cont(accesos_por_habitante, 0.66) AS p66 FROM ratios))"""

PROFILE = f"""profile AS MATERIALIZED (
  SELECT cod_municipio_norm, year_icfes AS year_int,
    round({mean('estrato')}, 5) AS prom_estrato_hogar,
    sum(flag_internet_hogar) * 100.0::DOUBLE / count(*) AS pct_internet_hogar,
    sum(CASE WHEN fami_educacionmadre LIKE '%Superior%' THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*)
      AS pct_educacion_madre_superior,
    sum(CASE WHEN fami_educacionpadre LIKE '%Superior%' THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*)
      AS pct_educacion_padre_superior,
    sum(CASE WHEN cole_naturaleza = 'NO OFICIAL' THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*)
      AS pct_colegio_privado,
    sum(CASE WHEN cole_area_ubicacion IN ('URBANO', 'URBANA') THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*)
      AS pct_area_urbana,
    round({mean('personas')}, 5) AS promedio_personas_hogar,
    sum(CASE WHEN fami_tienecomputador = 'Si' THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*)
      AS pct_hogar_computador,
    round({mean('punt_global')}, 5) AS puntaje_global_promedio,
    count(*) AS n_estudiantes
  FROM (SELECT *,
      TRY_CAST(regexp_extract(fami_estratovivienda, '([0-9]+)', 1) AS DOUBLE) AS estrato,
      TRY_CAST(regexp_extract(fami_personashogar, '([0-9]+)', 1) AS DOUBLE) AS personas
    FROM students WHERE year_icfes IS NOT NULL AND cod_municipio_norm IS NOT NULL)
  GROUP BY ALL)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


# Students together with the connectivity levels.
ALL_TABLES = f"{STUDENTS},\n{LEVELS}"
