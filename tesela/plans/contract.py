"""Column names and values of the data contract (fixed values)."""

KEY = "cod_municipio_norm"
YEAR = "year_int"
STUDENT_YEAR = "year_icfes"
LEVEL = "nivel_conectividad_municipio"
RATIO = "accesos_por_habitante"
SCORE = "punt_global"
HOUSEHOLD_FLAG = "flag_internet_hogar"

SUBJECTS = [
    "punt_matematicas",
    "punt_lectura_critica",
    "punt_c_naturales",
    "punt_sociales_ciudadanas",
    "punt_ingles",
]
SCORES = [SCORE, *SUBJECTS]

ACCESS_NUMBERS = ["no_de_accesos", "velocidad_bajada", "velocidad_subida"]

COVERAGE_NUMBERS = [
    "cobertura_neta",
    "cobertura_neta_primaria",
    "cobertura_neta_secundaria",
    "cobertura_neta_media",
    "cobertura_bruta",
    "deserci_n",
    "deserci_n_primaria",
    "deserci_n_secundaria",
    "aprobaci_n",
    "reprobaci_n",
    "repitencia",
    "sedes_conectadas_a_internet",
    "tasa_matriculaci_n_5_16",
    "poblaci_n_5_16",
    "tama_o_promedio_de_grupo",
]

# Raw columns that the cleaning and the analyses read.
RAW_COLUMNS = {
    "students": [
        "periodo",
        "estu_consecutivo",
        "estu_estadoinvestigacion",
        "estu_privado_libertad",
        "estu_genero",
        "cole_cod_mcpio_ubicacion",
        "cole_naturaleza",
        "cole_area_ubicacion",
        "cole_jornada",
        "cole_bilingue",
        "cole_calendario",
        "fami_estratovivienda",
        "fami_educacionmadre",
        "fami_educacionpadre",
        "fami_tieneinternet",
        "fami_tienecomputador",
        "fami_tieneautomovil",
        "fami_personashogar",
        "fami_cuartoshogar",
        *SCORES,
    ],
    "access": [
        "anno",
        "trimestre",
        "cod_municipio",
        "municipio",
        "departamento",
        "proveedor",
        "tecnologia",
        "segmento",
        *ACCESS_NUMBERS,
    ],
    "coverage": ["a_o", "c_digo_municipio", "municipio", "departamento", *COVERAGE_NUMBERS],
}

# Rank error of the quantiles behind fences, levels and fill values.
RANK_ERROR = 0.01

# Inputs of the anomaly model.
ANOMALY_FEATURES = [
    "accesos_por_habitante",
    "total_accesos_internet",
    "cobertura_neta",
    "poblaci_n_5_16",
    "prom_estrato_hogar",
    "pct_internet_hogar",
    "pct_educacion_madre_superior",
    "pct_educacion_padre_superior",
    "pct_colegio_privado",
    "pct_area_urbana",
    "promedio_personas_hogar",
    "pct_hogar_computador",
    "velocidad_bajada",
]
ANOMALY_IDS = [KEY, YEAR, "municipio", "departamento", LEVEL, "puntaje_global_promedio"]

# Values of the source columns.
PUBLISHED = "PUBLICAR"
DETAINED = "S"
RESIDENTIAL = "residencial"
HIGHER_EDUCATION = "%Superior%"
PRIVATE_SCHOOL = "NO OFICIAL"
PUBLIC_SCHOOL = "OFICIAL"
URBAN = ("URBANO", "URBANA")
RURAL = "RURAL"
HAS_COMPUTER = "Si"
