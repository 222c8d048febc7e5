"""Fixed values that must equal the reference's for results to match.

Everything here is data, not logic: the alias catalogue that maps free header
text to the nine canonical fields, the ministry classification rules, the
transliteration table and the Excel epochs.  Users may extend the alias and
rule tables; the defaults below are the reference behaviour.
"""

# --- fixed values: canonical fields and their header aliases, priority order ---
COLUMN_ALIASES = {
    "rut": ["rut", "r_u_t", "nro_rut", "numero_rut", "documento"],
    "codigo": [
        "codigo", "expediente", "nro_expediente", "numero_expediente", "archivo", "carpeta",
    ],
    "empresa": ["empresa", "razon_social", "nombre_empresa", "denominacion", "titular"],
    "ministerio_evaluador": [
        "ministerio_evaluador", "ministerio", "evaluador", "organismo", "inciso",
        "ministerio_eval",
    ],
    "fecha_presentado": [
        "fecha_presentado", "fecha_presentacion", "fecha_de_presentacion",
        "presentado", "fecha_ingreso", "fecha_registro", "fecha",
    ],
    "fecha_recomendado": [
        "fecha_recomendado", "fecha_recomendacion", "fecha_de_recomendacion",
        "recomendado", "fecha_aprobacion", "fecha_resolucion",
    ],
    "regimen": ["regimen", "decreto", "normativa", "marco_normativo"],
    "tramo": ["tramo", "ampliacion", "tipo_tramo", "etapa"],
    "monto_ui": [
        "monto_ui", "monto_en_ui", "monto_ui_total", "inversion_ui",
        "inversion_total_ui", "monto_inversion_ui", "ui",
    ],
}

# --- fixed values: ministry rules, first matching pattern wins ---
MINISTRY_RULES = [
    ("MEF", "mef"),
    ("MIEM", "miem"),
    ("MINTUR", "mintur|turismo"),
    ("MGAP", "mgap|ganaderia|agricultura|pesca"),
]

# --- fixed values: transliteration to ASCII (after replacing sharp s by "ss") ---
TRANSLIT_FROM = "ÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇáàâäãåéèêëíìîïóòôöõúùûüñçºª"
TRANSLIT_TO = "AAAAAAEEEEIIIIOOOOOUUUUNCaaaaaaeeeeiiiiooooouuuuncoa"

# --- fixed values: dataset name patterns on normalised file names ---
DATASET_PATTERNS = {"presentados": "presentad", "recomendados": "recomend"}

# --- fixed values: the field each dataset does not expect in its sheet score ---
DATASET_EXCLUDED_FIELD = {
    "presentados": "fecha_recomendado",
    "recomendados": "fecha_presentado",
}

# --- fixed values: Excel serial day epochs ---
EXCEL_EPOCH_1900 = "1899-12-30"
EXCEL_EPOCH_1904 = "1904-01-01"

# --- fixed values: Spanish month names and abbreviations, January first ---
MONTH_NAMES = [
    ["enero", "ene"], ["febrero", "feb"], ["marzo", "mar"], ["abril", "abr"], ["mayo", "may"], ["junio", "jun"],
    ["julio", "jul"], ["agosto", "ago"], ["septiembre", "setiembre", "sept", "sep", "set"], ["octubre", "oct"],
    ["noviembre", "nov"], ["diciembre", "dic"],
]

# Key fields: a row with all of these missing is dropped (regimen and tramo do not count).
KEY_FIELDS = [
    "rut", "codigo", "empresa", "ministerio_evaluador",
    "fecha_presentado", "fecha_recomendado", "monto_ui",
]

CANONICAL_FIELDS = list(COLUMN_ALIASES)

PREVIEW_ROWS = 25          # header search window
MIN_HEADER_SCORE = 2       # below this the first non-empty row is the header
ROW_BITS = 32             # row slot of the (file, row) order key; a sheet has <= 2**20 rows
