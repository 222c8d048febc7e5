"""Date parsing for workbook cells and free text.

Typed cells dispatch on their type: a date cell is its date, a numeric cell is
an Excel serial day (floored), a text cell is tried in day-month-year,
year-month-day, then month-day-year order, with the month as a number or a
Spanish name.  Two-digit years pivot at 69 (69..99 -> 19xx, 00..68 -> 20xx).
A bare 5-digit text is read as a serial.  Serials count from the workbook's
epoch (the 1900 or the 1904 system).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regfuse.functions.constants import EXCEL_EPOCH_1900, EXCEL_EPOCH_1904, MONTH_NAMES
from regfuse.functions.text import as_text


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_of(date1904) -> Column:
    """Day zero of a workbook's serials; NULL counts as the 1900 system."""
    first, second = (F.lit(e).cast("date") for e in (EXCEL_EPOCH_1900, EXCEL_EPOCH_1904))
    return F.when(_col(date1904), second).otherwise(first)


def serial_to_date(n, epoch=None) -> Column:
    """Excel serial day -> date (fractional part = time of day, dropped)."""
    days = F.floor(_col(n)).cast("int")
    return F.date_add(F.lit(EXCEL_EPOCH_1900).cast("date") if epoch is None else epoch, days)


def _valid(y: Column, m: Column, d: Column) -> Column:
    """(y, m, d) is a calendar day - pure integer arithmetic, no exceptions."""
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    last = F.when(m == 2, F.when(leap, F.lit(29)).otherwise(F.lit(28))).when(m.isin(4, 6, 9, 11), F.lit(30)).otherwise(F.lit(31))
    return F.coalesce(y.between(1, 9999) & m.between(1, 12) & (d >= 1) & (d <= last), F.lit(False))


def _pivot(yy: Column) -> Column:
    """Two-digit year: 69..99 -> 19xx, 00..68 -> 20xx."""
    return F.when(yy >= 69, yy + 1900).otherwise(yy + 2000)


def _months_as_numbers(t: Column) -> Column:
    """A Spanish month name or abbreviation becomes its number, after the day
    if it stood before it; texts without letters are left as they are (the
    others go through a lambda, so that they alone pay for it)."""
    any_name = "|".join(n for names in MONTH_NAMES for n in names)
    numbers = F.create_map(*[F.lit(x) for i, names in enumerate(MONTH_NAMES, start=1) for n in names for x in (n, f"/{i}/")])

    def named(x):
        low = F.lower(x)
        low = F.when(F.left(low, F.lit(1)) >= "a", F.regexp_replace(low, rf"^({any_name})[. ]+([0-9]{{1,2}})\b", "$2 $1")).otherwise(low)
        number = F.try_element_at(numbers, F.regexp_extract(low, rf"\b({any_name})\b", 1))
        return F.coalesce(F.regexp_replace(low, rf"\b({any_name})\b", number), low)

    return F.when(t.rlike("[A-Za-z]{3}"), F.transform(F.array(t), named)[0]).otherwise(t)


def _numbers_only(squished: Column) -> Column:
    """Runs of non-digits become one ``/``, ends trimmed."""
    return F.btrim(F.regexp_replace(_months_as_numbers(squished), "[^0-9]+", "/"), F.lit("/"))


def _without_time(v: Column) -> Column:
    """A time of day behind the three numbers of a date is dropped."""
    slashes = F.length(v) - F.length(F.replace(v, F.lit("/"), F.lit("")))
    return F.when(slashes > 3, F.regexp_replace(v, r"^([0-9]+/[0-9]+/[0-9]+)(/[0-9]{1,2}){2,3}$", "$1")).otherwise(v)


def date_text_shape(c) -> Column:
    """Digits-and-slashes form of a date text: runs of non-digits become one
    ``/``, ends trimmed, a trailing time of day dropped."""
    squished = F.transform(F.array(as_text(c)), _numbers_only)
    return F.transform(squished, _without_time)[0]


# How a shape reads, by the digits of its three numbers or the length of its one run of digits.  _kind: 1 d/m/yyyy,
# 2 d/m/yy, 3 yyyy/m/d, 4 yy/m/d that ends in one digit, 5 eight digits, 6 six digits; its numbers are _a, _b and _c.
_PART_COLS = ["_kind", "_a", "_b", "_c", "_la"]


def _shape_parts(shape: Column, parts: Column) -> dict[str, Column]:
    """``parts``: the shape split at its slashes."""
    three, one = F.size(parts) == 3, F.size(parts) == 1
    la, lb, lc = (F.length(F.get(parts, F.lit(i))) for i in range(3))
    eight, six = one & (F.length(shape) == 8), one & (F.length(shape) == 6)
    short = la.between(1, 2) & lb.between(1, 2)
    by_digits = (
        F.when(short & (lc == 4), 1).when(short & (lc == 2), 2).when((la == 4) & lb.between(1, 2) & lc.between(1, 2), 3)
        .when((la == 2) & lb.between(1, 2) & (lc == 1), 4)
    )

    def number(i, eight_at, six_at):
        text = F.when(three, F.get(parts, F.lit(i))).when(eight, F.substring(shape, *eight_at)).when(six, F.substring(shape, *six_at))
        return text.try_cast("int")

    return {
        "_kind": F.when(three, by_digits).when(eight, 5).when(six, 6),
        "_a": number(0, (1, 4), (1, 2)), "_b": number(1, (5, 2), (3, 2)), "_c": number(2, (5, 4), (5, 2)),
        "_la": F.when(three, la).when(six, 2),
    }


def _readings(kind: Column, a: Column, b: Column, c: Column, la: Column) -> dict[str, Column]:
    """Up to three (year, month, day) of a shape, in the order in which they are tried: day first, year first, month first.
    An eight-digit run is read as ddmmyyyy (_a is ddmm, _c the year), then as yyyymmdd (_a the year, _b the month)."""
    return {
        "_y1": F.when(kind.isin(1, 5), c).when(kind.isin(2, 6), _pivot(c)).when(kind == 3, a).when(kind == 4, _pivot(a)),
        "_m1": F.when(kind == 5, a % 100).otherwise(b),
        "_d1": F.when(kind.isin(3, 4), c).when(kind == 5, (a / 100).cast("int")).otherwise(a),
        "_y2": F.when(kind == 1, c).when(kind.isin(2, 6) & (la == 2), _pivot(a)).when(kind == 5, a),
        "_m2": F.when(kind == 1, a).otherwise(b),
        "_d2": F.when(kind == 1, b).when(kind == 5, c % 100).otherwise(c),
        "_y3": F.when(kind.isin(2, 6), _pivot(c)),
        "_m3": a,
        "_d3": b,
    }


_READING_COLS = ["_y1", "_m1", "_d1", "_y2", "_m2", "_d2", "_y3", "_m3", "_d3"]


def _date_of(y: Column, m: Column, d: Column) -> Column:
    return F.when(_valid(y, m, d), F.make_date(y, m, d))


def _first_valid(y1, m1, d1, y2, m2, d2, y3, m3, d3, la, squished, epoch=None) -> Column:
    """The first reading that is a calendar day; a run of five digits is a serial.

    Nearly all texts have a valid first reading: the rest goes through a lambda, since generated code of all of them is
    too long to be compiled to machine code."""
    serial = la.isNull() & squished.rlike("^[0-9]{5}(\\.[0-9]+)?$")  # not for texts of three numbers

    def others(r):
        at_serial = F.when(serial, serial_to_date(squished.try_cast("double"), epoch))
        return F.coalesce(_date_of(r["y2"], r["m2"], r["d2"]), _date_of(r["y3"], r["m3"], r["d3"]), at_serial)

    rest = F.struct(y2.alias("y2"), m2.alias("m2"), d2.alias("d2"), y3.alias("y3"), m3.alias("m3"), d3.alias("d3"))
    return F.coalesce(_date_of(y1, m1, d1), F.transform(F.array(rest), others)[0])


def parse_date_text(c, epoch=None) -> Column:
    """Free-text date -> date, or NULL when no order yields a valid date.

    Every step is bound once through a lambda so the expression stays
    small wherever it is used.  Pipelines should prefer ``with_parsed_date``,
    which materialises them in projections and stays in generated code."""

    def read(sq):
        shaped = F.transform(F.transform(F.array(sq), _numbers_only), lambda v: F.struct(_without_time(v).alias("v")))
        split = F.transform(shaped, lambda s: F.struct(s["v"].alias("v"), F.split(s["v"], "/").alias("p")))
        parts = F.transform(split, lambda s: F.struct(*[v.alias(k) for k, v in _shape_parts(s["v"], s["p"]).items()]))
        readings = F.transform(parts, lambda r: F.struct(
            r["_la"].alias("_la"), *[v.alias(k) for k, v in _readings(*[r[k] for k in _PART_COLS]).items()]))
        return F.transform(readings, lambda r: _first_valid(*[r[k] for k in _READING_COLS], r["_la"], sq, epoch))[0]

    return F.transform(F.array(as_text(c)), read)[0]


def with_parsed_date(df, text_col: str, out_col: str, epoch=None):
    """``df`` plus ``out_col`` = date parsed from ``text_col``, in small
    projections (text -> numbers -> shape -> parts -> readings -> date)."""
    pre = f"_{out_col}"
    staged = df.withColumn(f"{pre}_sq", as_text(text_col))
    staged = staged.withColumn(f"{pre}_v", _numbers_only(F.col(f"{pre}_sq")))
    staged = staged.withColumn(f"{pre}_v", _without_time(F.col(f"{pre}_v")))
    staged = staged.withColumn(f"{pre}_p", F.split(F.col(f"{pre}_v"), "/"))
    staged = staged.withColumns({f"{pre}{k}": v for k, v in _shape_parts(F.col(f"{pre}_v"), F.col(f"{pre}_p")).items()})
    staged = staged.withColumns({f"{pre}{k}": v for k, v in _readings(*[F.col(f"{pre}{k}") for k in _PART_COLS]).items()})
    names = [F.col(f"{pre}{k}") for k in [*_READING_COLS, "_la", "_sq"]]
    staged = staged.withColumn(out_col, _first_valid(*names, epoch))
    return staged.drop(*[f"{pre}{k}" for k in ["_sq", "_v", "_p", *_PART_COLS, *_READING_COLS]])


def cell_date(cell_type, text, num, ts, epoch=None) -> Column:
    """Typed cell -> date."""
    ct = _col(cell_type)
    return (
        F.when(ct == "date", F.to_date(_col(ts)))
        .when(ct == "number", serial_to_date(num, epoch))
        .when(ct == "text", parse_date_text(text, epoch))
    )
