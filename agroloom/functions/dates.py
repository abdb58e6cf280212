"""Date detection, parsing and the day-of-year code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_Y, _M, _D = r"\d{4}", r"(0?[1-9]|1[0-2])", r"(0?[1-9]|[12]\d|3[01])"

# Accepted layouts, tried in this order (year-first, month-first, day-first), with
# the pattern a value must have.
DATE_LAYOUTS = {
    "yyyy-MM-dd": rf"^{_Y}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])$",
    "yyyy-MM-dd'T'HH:mm:ss": rf"^{_Y}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])T\d\d:\d\d:\d\d$",
    "yyyy/M/d": rf"^{_Y}/{_M}/{_D}$",
    "yyyyMMdd": rf"^{_Y}(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])$",
    "M/d/yyyy": rf"^{_M}/{_D}/{_Y}$",
    "M-d-yyyy": rf"^{_M}-{_D}-{_Y}$",
    "d.M.yyyy": rf"^{_D}\.{_M}\.{_Y}$",
    "d/M/yyyy": rf"^{_D}/{_M}/{_Y}$",
    "d-M-yyyy": rf"^{_D}-{_M}-{_Y}$",
}

# Patterns of the 70 % rule for text columns.
DATE_PATTERNS = (r"^\d{4}-\d{2}-\d{2}$", r"^\d{2}/\d{2}/\d{4}$", r"^\d{2}\.\d{2}\.\d{4}$")
DATE_SHARE = 0.7


def _shapes(layout: str) -> list[str]:
    """Texts of a layout with every digit as 9: ``M`` and ``d`` stand for one digit or two."""
    base = layout.replace("'", "").replace("yyyy", "9999")
    for two in ("MM", "dd", "HH", "mm", "ss"):
        base = base.replace(two, "99")
    out = [base]
    for one in "Md":
        out = [s.replace(one, w) for s in out for w in ("9", "99")] if one in base else out
    return out


def parse_date(c: Column, layout: str) -> Column:
    """Date of ``c`` under one layout, null where it does not fit."""
    text = c.cast("string")
    if layout == "yyDDD":
        return from_doy(text)
    parsed = F.try_to_timestamp(text, F.lit(layout)).cast("date")
    if layout not in DATE_LAYOUTS:
        return parsed
    # the cheap look at the shape spares the pattern, and the pattern spares most failing parses
    shape = F.translate(text, "012345678", "999999999")
    return F.when(shape.isin(_shapes(layout)) & text.rlike(DATE_LAYOUTS[layout]), parsed)


def misfits(c: Column, layout: str) -> Column:
    """Aggregate: number of values the layout cannot read."""
    return F.count_if(c.isNotNull() & parse_date(c, layout).isNull())


def date_share(c: Column) -> Column:
    """Aggregate: best share of non-empty strings matching one date pattern."""
    filled = F.when(c != "", c)
    return F.greatest(*[F.avg(filled.rlike(p).cast("double")) for p in DATE_PATTERNS])


def to_doy(c: Column) -> Column:
    """Date to two-digit year and three-digit day of year."""
    return F.date_format(c, "yyDDD")


def from_doy(c: Column) -> Column:
    """Inverse of :func:`to_doy`; years 69-99 are 19xx, 00-68 are 20xx."""
    text = F.lpad(c.cast("string"), 5, "0")
    century = F.when(F.substring(text, 1, 2) < "69", "20").otherwise("19")
    return F.try_to_timestamp(F.concat(century, text), F.lit("yyyyDDD")).cast("date")


def is_leap(year: Column) -> Column:
    return ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)


def archive_period(first_day: Column, today: Column | None = None) -> Column:
    """'historical' when the start lies 18 months back or more, else 'recent'."""
    now = today if today is not None else F.current_date()
    return F.when(first_day <= F.add_months(now, -18), "historical").otherwise("recent")
