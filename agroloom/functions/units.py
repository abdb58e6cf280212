"""Unit conversion: any product of powers of known units, as a factor and a vector of base dimensions."""

from __future__ import annotations

import re
from dataclasses import dataclass
from fractions import Fraction
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Base dimensions, in the order of a unit's exponents.
DIMENSIONS = ("m", "kg", "s", "K", "mol", "A", "cd")

# Unit -> (factor, the unit it is a multiple of); "1" has no dimension.
UNITS: dict[str, tuple[str, str]] = {
    "g": ("0.001", "kg"),
    "t": ("1000", "kg"),
    "dt": ("100", "kg"),
    "lb": ("0.45359237", "kg"),
    "in": ("0.0254", "m"),
    "ft": ("0.3048", "m"),
    "ha": ("10000", "m2"),
    "l": ("0.001", "m3"),
    "L": ("0.001", "m3"),
    "min": ("60", "s"),
    "h": ("3600", "s"),
    "hour": ("3600", "s"),
    "d": ("86400", "s"),
    "day": ("86400", "s"),
    "week": ("604800", "s"),
    "Hz": ("1", "s-1"),
    "N": ("1", "kg m s-2"),
    "Pa": ("1", "N m-2"),
    "bar": ("100000", "Pa"),
    "J": ("1", "N m"),
    "cal": ("4.184", "J"),
    "W": ("1", "J s-1"),
    "%": ("0.01", "1"),
    "percent": ("0.01", "1"),
    "ppm": ("0.000001", "1"),
    "ppb": ("0.000000001", "1"),
    "number": ("1", "1"),
    "count": ("1", "1"),
}

# Temperatures with a zero of their own -> (factor, kelvin at zero). In products they are differences.
TEMPERATURES: dict[str, tuple[str, str]] = {
    "degree_C": ("1", "273.15"),
    "degC": ("1", "273.15"),
    "°C": ("1", "273.15"),
    "degree_F": ("5/9", "45967/180"),
    "degF": ("5/9", "45967/180"),
    "°F": ("5/9", "45967/180"),
}

# Prefix -> power of ten, and the units that take one.
PREFIXES = {
    "da": 1, "h": 2, "k": 3, "M": 6, "G": 9, "T": 12, "d": -1, "c": -2, "m": -3, "u": -6, "µ": -6, "μ": -6, "n": -9, "p": -12,
}
PREFIXED = ("m", "g", "s", "K", "mol", "A", "cd", "t", "l", "L", "Hz", "N", "Pa", "bar", "J", "cal", "W")

# Target units that mean "not a measurement"
NO_CONVERSION = ("", "date", "code", "text", "yyyy")

_RAISED = str.maketrans("⁰¹²³⁴⁵⁶⁷⁸⁹⁻⁺", "0123456789-+")
_POWER = r"(?:\^|\*\*)(?P<{}>[+-]?\d+)"
_TOKEN = re.compile(
    rf"\s*(?:(?P<number>\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)(?:{_POWER.format('p1')})?"
    rf"|(?P<name>[A-Za-zµμ°%_]+)(?:{_POWER.format('p2').replace('(?:', '(?:|', 1)})?"
    rf"|(?P<close>\))(?:{_POWER.format('p3')})?|(?P<times>[*·×.])|(?P<per>/)|(?P<open>\())"
)


@dataclass(frozen=True)
class Unit:
    """A unit as ``factor`` times base units with these exponents; ``zero`` is where its scale begins, in base units."""

    factor: Fraction
    dims: tuple[int, ...]
    zero: Fraction = Fraction(0)

    def __mul__(self, other: Unit) -> Unit:
        return Unit(self.factor * other.factor, tuple(a + b for a, b in zip(self.dims, other.dims)))

    def __pow__(self, n: int) -> Unit:
        return Unit(self.factor**n, tuple(a * n for a in self.dims))


NONE = Unit(Fraction(1), (0,) * len(DIMENSIONS))


@lru_cache(maxsize=4096)
def named(name: str) -> Unit:
    """A unit by its name, with or without a prefix; whole names go first."""
    if name in DIMENSIONS:
        return Unit(Fraction(1), tuple(int(name == d) for d in DIMENSIONS))
    if name in UNITS:
        factor, base = UNITS[name]
        return Unit(Fraction(factor), NONE.dims) * parsed(base)
    if name in TEMPERATURES:
        factor, zero = TEMPERATURES[name]
        return Unit(Fraction(factor), named("K").dims, Fraction(zero))
    for prefix, power in PREFIXES.items():
        if name.startswith(prefix) and name[len(prefix) :] in PREFIXED:
            return Unit(Fraction(10) ** power, NONE.dims) * named(name[len(prefix) :])
    raise ValueError(f"unknown unit {name!r}")


@lru_cache(maxsize=4096)
def parsed(text: str) -> Unit:
    """The unit of an expression such as ``kg ha-1``, ``g m^-2 d^-1``, ``mmol/l`` or ``J/(cm2 d)``.

    Factors stand side by side or with a point or star between them; a slash divides by the next factor only. Exponents follow
    their unit, with or without ``^`` or ``**``, or raised.
    """
    text = re.sub("[⁰¹²³⁴⁵⁶⁷⁸⁹⁻⁺]+", lambda m: "^" + m[0].translate(_RAISED), text.strip())
    open_: list[tuple[Unit, int]] = []  # value and sign before each bracket
    value, sign, at, count, last = NONE, 1, 0, 0, None

    def take(unit: Unit, power: str | None) -> None:
        nonlocal value, sign, last
        n = int(power) if power else 1
        # a scale of its own only counts for a unit that stands alone
        last = unit if n * sign == 1 else unit**n
        value, sign = value * (unit ** (n * sign)), 1

    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m or m.end() == at:
            raise ValueError(f"no unit: {text!r}")
        at, count = m.end(), count + 1
        if m["number"]:
            take(Unit(Fraction(m["number"]), NONE.dims), m["p1"])
        elif m["name"]:
            take(named(m["name"]), m["p2"])
        elif m["open"]:
            open_.append((value, sign))
            value, sign = NONE, 1
        elif m["close"]:
            if not open_:
                raise ValueError(f"no unit: {text!r}")
            inner, (value, sign) = value, open_.pop()
            take(inner, m["p3"])
        elif m["per"]:
            sign = -sign
    if open_ or sign < 0 or count == 0:
        raise ValueError(f"no unit: {text!r}")
    return last if count == 1 and last is not None else value


def conversion(source: str, target: str) -> tuple[float, float]:
    """Scale and offset so that ``target = source * scale + offset``."""
    if source == target:
        return 1.0, 0.0
    if not source or not target:
        raise ValueError(f"no conversion from {source!r} to {target!r}")
    a, b = parsed(source), parsed(target)
    if a.dims != b.dims:
        raise ValueError(f"no conversion from {source!r} to {target!r}")
    return float(a.factor / b.factor), float((a.zero - b.zero) / b.factor)


def convert_unit(c: Column, source: str, target: str) -> Column:
    scale, offset = conversion(source, target)
    out = c.cast("double") * F.lit(scale)
    return out + F.lit(offset) if offset else out
