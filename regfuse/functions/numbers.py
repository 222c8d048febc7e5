"""Amount parsing: first number in a text, in comma- or dot-decimal locale.

``parse_number`` mirrors a "first number in the string" parser: leading and
trailing text is ignored, grouping marks inside the number are dropped.

The locale of a text column is decided by a vote over the whole column: dot
decimal wins only when it parses strictly more cells than comma decimal.  In
Spark the column is a group (file, sheet, field), so the vote is a small
aggregate joined back - never a window over one file, which would put a hot
file into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PATTERNS = {
    # decimal mark ',', grouping '.'
    "comma": r"^[^-0-9,]*(-?[0-9.]*(?:[,][0-9.]*)?(?:[eE][+-]?[0-9]+)?)",
    # decimal mark '.', grouping ','
    "dot": r"^[^-0-9.]*(-?[0-9,]*(?:[.][0-9,]*)?(?:[eE][+-]?[0-9]+)?)",
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_number(c, locale: str = "comma") -> Column:
    """First number in ``c`` as double under ``locale`` ('comma' or 'dot')."""
    raw = F.nullif(F.regexp_extract(_col(c), _PATTERNS[locale], 1), F.lit(""))
    if locale == "comma":
        clean = F.replace(F.replace(raw, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    elif locale == "dot":
        clean = F.replace(raw, F.lit(","), F.lit(""))
    else:
        raise ValueError(f"unknown locale {locale!r}")
    return clean.try_cast("double")


def locale_vote(df: DataFrame, group_cols, text_col: str) -> DataFrame:
    """Per group: how many cells each locale parses and which locale wins."""
    comma = parse_number(text_col, "comma")
    dot = parse_number(text_col, "dot")
    return (
        df.groupBy(*group_cols)
        .agg(
            F.count(comma).alias("n_comma"),
            F.count(dot).alias("n_dot"),
        )
        .withColumn(
            "locale",
            F.when(F.col("n_dot") > F.col("n_comma"), F.lit("dot")).otherwise(F.lit("comma")),
        )
    )


def parse_number_with_vote(text_col, locale_col) -> Column:
    """Parse with the locale named in ``locale_col`` ('dot' or anything else -> comma)."""
    return F.when(F.col(locale_col) == "dot", parse_number(text_col, "dot")).otherwise(
        parse_number(text_col, "comma")
    )
