"""Ratio, rounding, percent-text and growth expressions.

Two conventions exist side by side and are kept apart on purpose:

* **report flavour** (attainment reports R6-R8): a ratio with a zero
  denominator is null, numbers are rounded and then rendered as text with a
  trailing ``%``.
* **sheet flavour** (target status, week comparisons R9-R12): ``x/0`` is
  ``+inf``/``-inf`` by the sign of ``x``; ``0/0`` and missing operands become
  0; percents are the ratio x 100 with two decimals.

Ratios are computed in double precision and rounded through ``decimal(38,6)``
so that half-up / half-even rounding acts on decimal digits, not on binary
fractions; only the sheet flavour's percent text rounds the double itself, as a
float formatter does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import MONEY_TYPE

# Doubles are rounded through this decimal. 32 integer digits hold any ratio
# of money values (at most 1e16 / 0.01 x 100); a value beyond that (only
# from a near-zero double denominator) becomes null instead of failing.
_DEC6 = "decimal(38,6)"


def _to_dec6(c: Column) -> Column:
    return c.try_cast(_DEC6)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Cast to the money type, decimal(18,2)."""
    return _c(c).cast(MONEY_TYPE)


def as_double(c) -> Column:
    return _c(c).cast("double")


def round_half_up(c, scale: int) -> Column:
    """Half-up rounding on decimal digits (``round`` in SQL)."""
    return F.round(_to_dec6(_c(c)), scale)


def round_half_even(c, scale: int) -> Column:
    """Banker's rounding on decimal digits (``bround``)."""
    return F.bround(_to_dec6(_c(c)), scale)


def safe_ratio(num, den) -> Column:
    """num / den as double; null when den is 0 or either side is null."""
    return F.try_divide(as_double(num), as_double(den))


def sheet_ratio(num, den) -> Column:
    """Sheet-flavour ratio: x/0 -> +/-inf by sign, 0/0 and nulls -> 0."""
    n, d = as_double(num), as_double(den)
    return (
        F.when(n.isNull() | d.isNull(), F.lit(0.0))
        .when((d == 0) & (n > 0), F.lit(float("inf")))
        .when((d == 0) & (n < 0), F.lit(float("-inf")))
        .when(d == 0, F.lit(0.0))
        .otherwise(n / d)
    )


def decimal_text(c) -> Column:
    """Decimal rendered as text with a trailing zero of a 2-place value cut
    (120.00 -> 120.0, 93.30 -> 93.3, 93.33 stays), i.e. how a rounded double
    prints. Values are never shown in exponent notation."""
    return F.regexp_replace(_c(c).cast("string"), r"(\.\d)0$", "$1")


def report_pct_text(c) -> Column:
    """Report flavour: rounded number followed by ``%``; null stays null."""
    return F.concat(decimal_text(c), F.lit("%"))


#: from here on, where doubles are 1/64 apart, the JVM's number format may print fewer digits than the double has; up to the second value its whole part is a long
_SHORTEST_FROM, _LONG_TO = 2.0 ** 46, 9e18


def float_fixed(c) -> Column:
    """A double printed with two decimals the way ``%.2f`` prints it: the value
    that the double really has (1.015 is 1.01499...) rounded half-even once,
    and a negative zero with its sign. The JVM's number format decides ties by
    the exact binary value; from 2**46 to 9e18 a double has at most six decimals,
    so its two parts are exact decimals. Beyond, the shortest digits that give
    the double are printed, then zeros. Null stays null."""
    x = as_double(c)
    size = F.abs(x)
    whole = F.floor(size).cast("decimal(20,0)")
    rest = (size - F.floor(size).cast("double")).cast("decimal(10,6)")
    large = F.concat(F.when(x < 0, F.lit("-")).otherwise(F.lit("")), F.bround(whole + rest, 2).cast("string"))
    return F.when((size >= _SHORTEST_FROM) & (size < _LONG_TO), large).otherwise(F.call_function("format_number", x, F.lit("0.00")))


def sheet_pct_text(ratio) -> Column:
    """Sheet flavour: ratio x 100 with exactly two decimals and ``%``, rounded
    as the double that it is (:func:`float_fixed`); infinities print as
    ``inf%`` / ``-inf%``."""
    r = as_double(ratio) * 100
    return (
        F.when(r == float("inf"), F.lit("inf%"))
        .when(r == float("-inf"), F.lit("-inf%"))
        .otherwise(F.concat(float_fixed(r), F.lit("%")))
    )


def growth(new, old) -> Column:
    """Difference of the two periods, each rounded to 2 places first (F22), a
    missing side counting as 0."""
    return F.bround(F.coalesce(_c(new), F.lit(0)), 2) - F.bround(F.coalesce(_c(old), F.lit(0)), 2)


def growth_rate(new, old) -> Column:
    """(new - old) / old in sheet flavour: a missing side gives 0."""
    n, o = _c(new), _c(old)
    return F.when(n.isNull() | o.isNull(), F.lit(0.0)).otherwise(sheet_ratio(n - o, o))
