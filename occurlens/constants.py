"""Fixed values that must equal the behaviour being reproduced.

Fixed values: these literals define results (patterns, maps, labels,
thresholds). They are kept together, in their natural order, as text.
"""

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

# Source columns kept from each yearly report file, in output order.
REQUIRED_COLUMNS = [
    "ANO_BO", "NUM_BO", "NOME_MUNICIPIO_CIRC", "DATA_OCORRENCIA_BO",
    "HORA_OCORRENCIA", "RUBRICA", "FLAG_STATUS", "DESCR_TIPOLOCAL", "CIDADE",
    "BAIRRO", "LATITUDE", "LONGITUDE", "MARCA_OBJETO", "MES", "ANO",
]
LINEAGE_COLUMN = "ARQUIVO_ORIGEM"
SOURCE_FILE_GLOB = "CelularesSubtraidos_*"

# Text columns that are trimmed and null-token mapped.
TEXT_COLUMNS = [
    "NOME_MUNICIPIO_CIRC", "RUBRICA", "FLAG_STATUS", "DESCR_TIPOLOCAL",
    "CIDADE", "BAIRRO", "MARCA_OBJETO",
]
# Upper-cased values that mean "no value".
NULL_TOKENS = ["NULL", "N/D", ""]

# Lower bound of the raw date filter, compared as a string.
MIN_DATE_STRING = "1900-01-01"
# Date formats tried in order.
DATE_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy"]
# The same as patterns: the last is brought to the form of the others. Years may be 0 or negative (with
# four digits or more), as in the parser of these formats; times end at 23:59:59.
DAY_FIRST_DATE = r"^([0-9]{2})/([0-9]{2})/([0-9]{4})\z"
ISO_DATE = r"^((?:[0-9]{4}|-(?!0+-)[0-9]{4,6})-[0-9]{2}-[0-9]{2})(?: (?:[01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9])?\z"
# Hour text must start like H:MM or HH:MM.
HOUR_PATTERN = r"^\d{1,2}:\d{2}"
HOUR_CAPTURE = r"^(\d{1,2}):\d{2}"  # the same, with the hour captured

CONSUMMATED = "CONSUMADO"

# Crime type: first match wins (checked on the lower-cased RUBRICA).
CRIME_ROBBERY = "Roubo"
CRIME_THEFT = "Furto"
CRIME_OTHER = "Outros"
CRIME_RULES = [("roubo", CRIME_ROBBERY), ("furto", CRIME_THEFT)]

# Brand normalisation: ordered regexes, first match wins, else BRAND_OTHER.
BRAND_RULES = [
    (r"(?i)(apple|iphone|i[\s-]?phone)", "Apple"),
    (r"(?i)(samsung|galaxy)", "Samsung"),
    (r"(?i)(motorola|moto[\s-])", "Motorola"),
    (r"(?i)xiaomi", "Xiaomi"),
    (r"(?i)lg\b", "LG"),
    (r"(?i)positivo", "Positivo"),
    (r"(?i)lenovo", "Lenovo"),
    (r"(?i)asus", "Asus"),
    (r"(?i)nokia", "Nokia"),
    (r"(?i)huawei", "Huawei"),
    (r"(?i)tcl", "TCL"),
    (r"(?i)realme", "Realme"),
    (r"(?i)oppo", "Oppo"),
    (r"(?i)multilaser", "Multilaser"),
]
BRAND_OTHER = "Outras"

# Accent folding for neighbourhood names (character i maps to character i).
ACCENTS_FROM = "ÀÁÂÃÄÈÉÊËÌÍÎÏÒÓÔÕÖÙÚÛÜÇàáâãäèéêëìíîïòóôõöùúûüç"
ACCENTS_TO = "AAAAAEEEEIIIIOOOOOUUUUCAAAAAEEEEIIIIOOOOOUUUUC"
# Abbreviation expansion, applied in order after folding and upper-casing.
ABBREVIATIONS = [
    (r"\bJD\b", "JARDIM"),
    (r"\bPQ\b", "PARQUE"),
    (r"\bVL\b", "VILA"),
    (r"\bCH\b", "CHACARA"),
    (r"\bST\b", "SETOR"),
]

# Period of day: [low, high] inclusive hour bounds.
PERIODS = [
    (0, 5, "Madrugada"),
    (6, 11, "Manhã"),
    (12, 17, "Tarde"),
    (18, 23, "Noite"),
]

# KPI parameters.
CAPITAL = "S.PAULO"
NOT_INFORMED = "NAO INFORMADO"
TOP_MUNICIPALITIES = 30
TOP_BAIRROS = 50
TOP_BRANDS = 15

# Dashboard view parameters.
VIEW_TOP_BRANDS = 10
VIEW_TOP_LOCATIONS = 8
VIEW_TOP_MUNICIPALITIES = 20
VIEW_TOP_BAIRROS = 20
MONTH_LABELS = ["Jan", "Fev", "Mar", "Abr", "Mai", "Jun",
                "Jul", "Ago", "Set", "Out", "Nov", "Dez"]
FIRST_YEAR_LABEL = 2017
COVERAGE_LABEL = "Dados: {first}–{last} | Fonte: SSP-SP"

# KPI table names.
KPI_ANNUAL = "kpi_annual_summary"
KPI_MONTHLY = "kpi_monthly"
KPI_MUNICIPALITY = "kpi_by_municipality"
KPI_BAIRRO = "kpi_by_bairro"
KPI_LOCATION = "kpi_by_location_type"
KPI_BRAND = "kpi_by_brand"
KPI_HOUR = "kpi_by_hour"
KPI_PERIOD = "kpi_by_period"

# Sink parameters.
SINK_BATCH_SIZE = 500
YOY_PRECISION = (6, 2)

# Text that a lenient integer cast accepts: sign, digits, optional fraction.
INTEGER_TEXT = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)\s*$"
