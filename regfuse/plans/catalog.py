"""The registered query catalogue: Spark builders and their DuckDB oracles.

Every builder takes ``(spark, sf_dir)``, reads the driver's tables (whole
tables, no sampling) and returns a DataFrame; ``ORACLE`` holds the equivalent
DuckDB SQL over the same tables, with identical column names.
"""

from __future__ import annotations

from regfuse.plans import queries_deck, queries_forms, queries_functions, queries_headers, queries_linkage  # noqa: F401
from regfuse.plans.registry import ORACLE, QUERIES  # noqa: F401
