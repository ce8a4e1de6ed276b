"""Scalar column functions for panel metrics.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``, so
it stays inside whole-stage codegen.  Two conventions hold throughout:

* Division never raises: a zero or NULL denominator gives NULL (the SQL
  ``a / NULLIF(b, 0)`` idiom).  Spark 4 runs in ANSI mode, where a plain ``/``
  by zero is an error.
* Rounding is HALF_UP on the value fixed to ``n + 7`` decimals
  (``round(cast(x as decimal(38, n+7)), n)``), computed in double arithmetic
  with exact remainders.  This gives the same digits as DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / NULLIF(den, 0)``: NULL when ``den`` is 0 or NULL."""
    return F.try_divide(col(num), col(den))


def round_half_up(c: ColumnOrName, scale: int = 2) -> Column:
    """``ROUND(x, scale)`` on the decimal value of ``x``, returned as double.

    Equal to ``ROUND(CAST(x AS DECIMAL(38, scale+7)), scale)`` in SQL while
    ``|x| * 10**(scale+7) < 2**53`` (``|x|`` below 9e6 for 2 decimals);
    above that the digits it rounds are those of the binary value.  The
    fraction ``|x| % 1`` (exact) is fixed to ``scale + 7`` digits as a long
    and rounded half up in integer steps; the result is recombined with the
    whole part in one rounding.  No branches and no decimal objects, so a
    projection with many rounded columns stays fast in generated code.
    """
    x = col(c)
    a = F.abs(x)
    inner = scale + 7
    step = 10 ** (inner - scale)
    frac = a % F.lit(1.0)
    fixed = F.floor(frac * F.lit(10.0**inner) + 0.5)
    t = fixed + F.lit(step // 2)
    q = (t - F.pmod(t, F.lit(step))).cast("double") / F.lit(float(step))
    total = (a - frac) * F.lit(10.0**scale) + q
    return F.signum(x) * total / F.lit(10.0**scale) + F.lit(0.0)


# Bits of the low limb of a value in cents.
_LOW_BITS = 24
# What an aggregation may have met besides finite values.
_POS_INF, _NEG_INF, _NAN = 1, 2, 4


def _is_finite(x: Column) -> Column:
    # NaN is above infinity in Spark's order.
    return F.abs(x) < F.lit(float("inf"))


def exact_sum_decimal(c: ColumnOrName, scale: int = 9) -> Column:
    """Sum of the finite values of a double column as DECIMAL(38, scale); see ``nonfinite_seen`` for the others.

    Every value enters with the decimal digits it prints with, of which those
    behind ``scale`` are rounded off (half up), so the sum does not depend on
    the order of rows, and so not on partitioning or on AQE coalescing.
    Values below 1e13 with at most two decimals are added as whole cents in
    two limbs, ``high * 2**24 + low``, both longs that stay in generated code:
    each limb holds some 1e11 rows of the largest values.  The others are added
    as decimals.  A value of 1e28 or more, or a sum beyond its type, is an
    error, never a wrong number.
    """
    x = col(c).cast("double")
    cents = F.rint(x * F.lit(100.0))
    is_cents = (F.abs(x) < F.lit(1e13)) & (cents / F.lit(100.0) == x)
    whole = cents.cast("long")
    high = F.sum(F.when(is_cents, F.shiftright(whole, _LOW_BITS)))
    low = F.sum(F.when(is_cents, whole.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))))
    # One digit less than the most there are: then the two sums add without losing a decimal.
    kind = f"decimal(37,{scale})"
    others = F.sum(F.when(~is_cents & _is_finite(x), x.cast(kind)))
    limb = F.lit(1 << _LOW_BITS).cast("decimal(8,0)")
    in_cents = high.cast("decimal(19,0)") * limb + low.cast("decimal(19,0)")
    zero = F.lit(0).cast(kind)
    both = F.coalesce((in_cents * F.expr("0.01BD")).cast(kind), zero) + F.coalesce(others.cast(kind), zero)
    return F.when(F.count(x) > 0, both)


def nonfinite_seen(c: ColumnOrName) -> Column:
    """Aggregate: which of NaN, infinity and minus infinity a column holds, as bits (NULL for no rows)."""
    x = col(c).cast("double")
    inf = float("inf")
    return F.bit_or(
        F.when(F.isnan(x), _NAN).when(x == F.lit(inf), _POS_INF).when(x == F.lit(-inf), _NEG_INF).otherwise(0)
    )


def sum_with_nonfinite(total: Column, seen: Column) -> Column:
    """A finite sum as a double, or what SQL makes of it where ``seen`` (see ``nonfinite_seen``) is not 0."""
    return (
        F.when(F.coalesce(seen, F.lit(0)) == 0, total.cast("double"))
        .when(seen == _POS_INF, F.lit(float("inf")))
        .when(seen == _NEG_INF, F.lit(float("-inf")))
        .otherwise(F.lit(float("nan")))
    )


def exact_sum(c: ColumnOrName, scale: int = 9) -> Column:
    """``exact_sum_decimal`` as the nearest double; NaN and infinities make it NaN or infinite, as in SQL."""
    return sum_with_nonfinite(exact_sum_decimal(c, scale), nonfinite_seen(c))


def exact_avg(c: ColumnOrName, scale: int = 9) -> Column:
    """Average over non-NULL values, independent of row order (exact sum by count)."""
    return F.try_divide(exact_sum(c, scale), F.count(col(c)).cast("double"))


def money_cents(c: ColumnOrName) -> Column:
    """Money with two decimals as whole cents (long): exact and fast to sum."""
    return F.rint(col(c) * 100).cast("long")


def share_pct(part: ColumnOrName, total: ColumnOrName) -> Column:
    """``part / NULLIF(total, 0) * 100``."""
    return safe_divide(part, total) * 100


def share_pct_or_zero(part: ColumnOrName, total: ColumnOrName) -> Column:
    """``part / total * 100`` when ``total > 0``, else 0 (also for NULL total)."""
    return F.when(col(total) > 0, col(part) / col(total) * 100).otherwise(F.lit(0.0))


def pct_change(cur: ColumnOrName, prev: ColumnOrName) -> Column:
    """``(cur - prev) / NULLIF(prev, 0) * 100`` (unrounded)."""
    return safe_divide(col(cur) - col(prev), prev) * 100


def pct_diff_from(value: ColumnOrName, reference: ColumnOrName) -> Column:
    """``(value / NULLIF(reference, 0) - 1) * 100``."""
    return (safe_divide(value, reference) - 1) * 100


def per_capita(value: ColumnOrName, population: ColumnOrName) -> Column:
    return safe_divide(value, population)


def total_gdp(gdp_per_capita: ColumnOrName, population: ColumnOrName) -> Column:
    return col(gdp_per_capita) * col(population)


def intensity_guarded(
    value: ColumnOrName,
    gdp_per_capita: ColumnOrName,
    population: ColumnOrName,
    unit: float = 1_000_000.0,
) -> Column:
    """``value / (gdp * pop / unit)`` only when gdp > 0 and pop > 0, else NULL."""
    g, p = col(gdp_per_capita), col(population)
    return F.when((g > 0) & (p > 0), col(value) / (g * p / F.lit(unit)))


def intensity_nullif(
    value: ColumnOrName,
    gdp_per_capita: ColumnOrName,
    population: ColumnOrName,
    unit: float = 1_000_000.0,
) -> Column:
    """``value / NULLIF(gdp * pop / unit, 0)``: no sign guard."""
    return safe_divide(value, col(gdp_per_capita) * col(population) / F.lit(unit))


def cagr_pct(
    value: ColumnOrName,
    base_value: ColumnOrName,
    period: ColumnOrName,
    base_period: ColumnOrName,
) -> Column:
    """Compound growth in percent from the base period, NULL at or before it.

    ``(POWER(v / NULLIF(base, 0), 1.0 / NULLIF(t - t0, 0)) - 1) * 100``.
    """
    t, t0 = col(period), col(base_period)
    ratio = safe_divide(value, base_value)
    exponent = safe_divide(F.lit(1.0), (t - t0).cast("double"))
    return F.when(t > t0, (F.pow(ratio, exponent) - 1) * 100)


def sum_all(*cols: ColumnOrName) -> Column:
    """``a + b + ...``: NULL if any input is NULL."""
    out = col(cols[0])
    for c in cols[1:]:
        out = out + col(c)
    return out


def year_to_date(c: ColumnOrName) -> Column:
    """Integer year to 1 January of that year."""
    return F.make_date(col(c).cast("int"), F.lit(1), F.lit(1))


def date_to_year(c: ColumnOrName) -> Column:
    return F.year(col(c))
