"""Text normalisers as Column -> Column functions.

All of them are plain Catalyst expressions (translate, regexp_replace, lower,
...), so they stay inside whole-stage codegen and never leave the JVM.
Every function accepts a Column or a column name.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regfuse.functions.constants import MINISTRY_RULES, TRANSLIT_FROM, TRANSLIT_TO


# --- fixed values: Unicode White_Space (what Java's (?U)\s matches) ---
WHITESPACE = "\t\n\u000b\f\r \u0085\u00a0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + \
    "\u2028\u2029\u202f\u205f\u3000"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _is_ascii(x: Column) -> Column:
    # characters == bytes only for pure ASCII (no scan through a Java String)
    return F.length(x) == F.octet_length(x)


def _fold_whitespace(x: Column) -> Column:
    """Every Unicode whitespace character -> a space.  ``translate`` copies the
    value through a Java String, so ASCII values without control whitespace
    (the common case) skip it."""
    plain = _is_ascii(x) & ~(x.contains("\t") | x.contains("\n") | x.contains("\r")
                             | x.contains("\u000b") | x.contains("\f"))
    return F.when(plain, x).otherwise(F.translate(x, WHITESPACE, " " * len(WHITESPACE)))


def normalize_name(c) -> Column:
    """ASCII-fold, lower-case, collapse runs of non ``[a-z0-9]`` into ``_``,
    strip one leading and one trailing ``_``.  NULL stays NULL."""
    x = _col(c)
    folded = F.translate(F.replace(x, F.lit("ß"), F.lit("ss")), TRANSLIT_FROM, TRANSLIT_TO)
    x = F.lower(F.when(_is_ascii(x), x).otherwise(folded))
    x = F.regexp_replace(x, "[^a-z0-9]+", "_")
    # runs are collapsed, so at most one '_' sits at each end
    return F.btrim(x, F.lit("_"))


def as_text(c) -> Column:
    """Trim and squish whitespace (Unicode aware, so NBSP counts).

    Whitespace characters become spaces; only values that then hold a double
    space pay for a regex."""
    x = _fold_whitespace(_col(c))
    squeezed = F.when(x.contains("  "), F.regexp_replace(x, " {2,}", " ")).otherwise(x)
    return F.trim(squeezed)


def blank_to_null(c) -> Column:
    return F.nullif(_col(c), F.lit(""))


def num_to_text(c) -> Column:
    """Shortest text that reads back as the same number, in plain notation at
    any magnitude (``2.1e11`` -> ``210000000000``, ``1e-12`` -> ``0.000000000001``).

    Whole numbers below 10^15 (nearly all) are printed as integers; the rest
    goes through a lambda, which keeps the generated code short."""
    x = _col(c).cast("double")
    whole = (F.abs(x) < 1e15) & (F.floor(x) == x)
    return F.when(whole, x.cast("bigint").cast("string")).otherwise(F.transform(F.array(x.cast("string")), _plain_number)[0])


def _plain_number(t: Column) -> Column:
    """A double as Spark prints it, ``d.ddd`` or ``d.dddE<exp>``; the digits of the latter are moved to their places."""
    sign = F.when(t.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    mantissa, power = F.substring_index(F.ltrim(t, F.lit("-")), "E", 1), F.substring_index(t, "E", -1).try_cast("int")
    fraction = F.nullif(F.substring_index(mantissa, ".", -1), F.lit("0"))
    digits = F.concat(F.substring_index(mantissa, ".", 1), F.coalesce(fraction, F.lit("")))
    places = F.coalesce(F.length(fraction), F.lit(0))  # the first digit stands before the point
    large = F.when(places <= power, F.concat(digits, F.repeat(F.lit("0"), power - places))).otherwise(
        F.concat(F.left(digits, power + 1), F.lit("."), F.substring(digits, power + 2, F.length(digits)))
    )
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    return F.when(t.contains("E"), F.concat(sign, F.when(power >= 0, large).otherwise(small))).otherwise(t)


def normalize_rut(c) -> Column:
    """Keep digits only; empty -> NULL.

    A number as it is printed (the common case) is taken as it is, without a regex."""
    x = _col(c)
    plain = (x.try_cast("bigint").cast("string") == x) & ~x.startswith("-")
    return F.nullif(F.when(plain, x).otherwise(F.regexp_replace(x, "[^0-9]", "")), F.lit(""))


def normalize_codigo(c) -> Column:
    """Squish, strip one trailing ``.0``; empty -> NULL."""
    x = as_text(c)
    stripped = F.when(x.endswith(".0"), F.left(x, F.length(x) - 2)).otherwise(x)
    return F.nullif(stripped, F.lit(""))


def _pattern_test(n: Column, pattern: str) -> Column:
    """``n rlike pattern``; an alternation of plain words is tested with
    ``contains`` (no regex engine per row)."""
    words = pattern.split("|")
    if all(w and all(ch.isalnum() or ch == "_" for ch in w) for w in words):
        cond = None
        for w in words:
            cond = n.contains(w) if cond is None else cond | n.contains(w)
        return cond
    return n.rlike(pattern)


def classify_ministerio(normalized, squished, rules=MINISTRY_RULES) -> Column:
    """Rule classification over a precomputed ``normalize_name(as_text(x))``
    (``normalized``) and ``as_text(x)`` (``squished``).

    Split from ``normalize_ministerio`` so a DataFrame pipeline can compute
    the normalised text once in a projection and test every rule against it
    (``CollapseProject`` does not inline a costly expression that is used
    more than once)."""
    n = _col(normalized)
    out = None
    for label, pattern in rules:
        cond = _pattern_test(n, pattern)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    fallback = F.upper(_col(squished))
    return fallback if out is None else out.otherwise(fallback)


def normalize_ministerio(c, rules=MINISTRY_RULES) -> Column:
    """Ordered substring rules on the normalised text, else upper-cased text.

    ``rules`` is a list of (label, regex) pairs; the first match wins."""
    return classify_ministerio(normalize_name(as_text(c)), as_text(c), rules)


def has_text(c) -> Column:
    """True when ``as_text(c)`` would be non-blank (NULL -> False)."""
    return F.coalesce(F.length(F.trim(_fold_whitespace(_col(c)))) > 0, F.lit(False))


def tramo_clean(c) -> Column:
    """Normalised tranche; the one column where NULL folds to ``''``."""
    return normalize_name(F.coalesce(_col(c), F.lit("")))


def es_ampliacion(tramo_clean_col) -> Column:
    """A tranche is an extension when its clean text contains ``ampl``."""
    return _col(tramo_clean_col).contains("ampl")


def composite_key(a, b, sep: str = "::") -> Column:
    """``a || sep || b``; NULL when either part is NULL (``concat`` propagates)."""
    return F.concat(_col(a), F.lit(sep), _col(b))
