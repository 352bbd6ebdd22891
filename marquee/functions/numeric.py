"""Numeric coercion, rounding and exact averages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal literal accepted by pandas.to_numeric(errors='coerce'); Java's
# double parser alone would also accept '12d', '12f' and 'NaN'.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tolerant_double(c: Column | str) -> Column:
    """Text -> double; anything that is not a plain decimal number is NULL.

    A number outside the double range ('1e400') is NULL too, as in pandas
    (Java's parser would give infinity)."""
    c = _col(c)
    d = F.trim(c).try_cast("double")
    return F.when(c.rlike(NUMBER_PATTERN) & (F.abs(d) < F.lit(float("inf"))), d)


def round_half_up_int(c: Column | str, to: str = "bigint") -> Column:
    """Float -> integer column as a database assignment cast does: round to
    the nearest integer (halves away from zero), NULL when out of range."""
    return F.round(_col(c), 0).try_cast(to)


def to_decimal(c: Column | str, precision: int = 10, scale: int = 2) -> Column:
    """Half-even round to ``scale`` places, then a range-checked decimal cast
    (NULL when it does not fit)."""
    return F.bround(_col(c), scale).try_cast(f"decimal({precision},{scale})")


def round_float(c: Column | str, scale: int = 2) -> Column:
    """pandas/numpy ``round(scale)`` on a double: scale up, round half to
    even on the binary value (``rint``), scale down. Unlike ``bround`` (which
    rounds the shortest decimal text), 1.015 -> 1.01 here, as in numpy,
    because the double 1.015 is 1.01499..."""
    f = float(10 ** scale)
    return F.rint(_col(c) * F.lit(f)) / F.lit(f)


def percent_return(gain: Column | str, cost: Column | str, scale: int = 2) -> Column:
    """(gain - cost) / cost * 100 in double, rounded like numpy to ``scale``
    places; NULL for a zero or missing cost."""
    gain, cost = _col(gain), _col(cost)
    return round_float(F.try_divide(gain - cost, cost) * F.lit(100.0), scale)


def _half_up_quotient(total: Column, n: Column) -> Column:
    """round(total / n), halves away from zero, in exact integer arithmetic:
    sign(total) * ((2|total| + n) div 2n). Decimal(38,0) throughout; the
    remainder is subtracted first so the division is exact (no scale-6
    rounding before the floor)."""
    total = total.cast("decimal(38,0)")
    n = n.cast("decimal(38,0)")
    x = F.abs(total) * 2 + n
    d = n * 2
    q = ((x - x % d) / d).cast("decimal(38,0)")
    return F.when(n > 0, F.when(total < 0, -q).otherwise(q))


def exact_avg_int(total: Column | str, n: Column | str) -> Column:
    """Exact round(sum / count) for integer sums, as bigint.

    Spark's avg(bigint) is a double; this gives the database's exact numeric
    answer at any row count."""
    return _half_up_quotient(_col(total), _col(n)).cast("bigint")


def exact_avg_cents(total_cents: Column | str, n: Column | str,
                    precision: int = 12, scale: int = 2) -> Column:
    """Exact round(avg(x), 2) given the integer sum of x * 100."""
    cents = _half_up_quotient(_col(total_cents), _col(n))
    return (cents / F.lit(100)).cast(f"decimal({precision},{scale})")
