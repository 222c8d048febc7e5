from regfuse.functions.text import (  # noqa: F401
    as_text,
    blank_to_null,
    composite_key,
    es_ampliacion,
    normalize_codigo,
    normalize_ministerio,
    normalize_name,
    normalize_rut,
    num_to_text,
    tramo_clean,
)
from regfuse.functions.numbers import parse_number, parse_number_with_vote  # noqa: F401
from regfuse.functions.dates import parse_date_text, cell_date  # noqa: F401
