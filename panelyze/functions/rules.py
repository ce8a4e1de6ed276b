"""Threshold classification as rule tables.

A rule table is an ordered list of ``(condition, label)`` pairs; ``classify``
folds it into one ``CASE WHEN`` expression.  The first matching rule wins and
a NULL input falls through every comparison to the default label.

Each ladder below is a function of the input column names and thresholds.
The default thresholds and all label texts are the fixed values the model
outputs must carry, so they are kept together here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelyze.functions.numeric import ColumnOrName, col, safe_divide

Rule = tuple[Column, str]


def classify(rules: Sequence[Rule], default: str | None = None) -> Column:
    """``CASE WHEN c1 THEN l1 WHEN c2 THEN l2 ... ELSE default END``."""
    if not rules:
        return F.lit(default)
    cond, label = rules[0]
    expr = F.when(cond, F.lit(label))
    for cond, label in rules[1:]:
        expr = expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def between(c: ColumnOrName, lo: float, hi: float) -> Column:
    """SQL ``BETWEEN``: both ends included."""
    c = col(c)
    return (c >= lo) & (c <= hi)


# ---------------------------------------------------------------------------
# Labels and default thresholds of the model ladders.
# ---------------------------------------------------------------------------
UNKNOWN = "Unknown"

INCOME_LABELS = ("High income", "Upper-middle income", "Lower-middle income", "Low income")
INCOME_BOUNDS = (1146.0, 4515.0, 4516.0, 14005.0)

INEQUALITY_LABELS = ("High inequality", "Moderate or low inequality")
INEQUALITY_BOUND = 40.0

POVERTY_LABELS = ("Low Poverty", "Moderate Poverty", "Severe Poverty")
POVERTY_BOUNDS = (5.0, 20.0)

EMPLOYMENT_LABELS = ("Low Unemployment", "Moderate Unemployment", "High Unemployment")
EMPLOYMENT_BOUNDS = (5.0, 15.0)

EDUCATION_LABELS = ("Low enrollment", "Medium enrollment", "High enrollment")
EDUCATION_BOUNDS = (60.0, 90.0)

LIFE_LABELS = ("Low life Expectancy", "Medium life expectancy", "High life expectancy")
LIFE_BOUNDS = (60.0, 75.0)

INTENSITY_LABELS = ("Low Emitters", "Medium Emitters", "High Emitters")
INTENSITY_BOUNDS = (1_000_000.0, 100_000_000.0)

COMPOSITION_LABELS = ("CO₂-Dominant", "Methane-Dominant", "Mixed Emissions")
COMPOSITION_BOUNDS = (70.0, 50.0)  # CO2 share above, CH4 share above

IMPACT_LABELS = ("Fast Warming Country", "Balanced Warming", "Slow Warming Country")
IMPACT_TOLERANCE = 0.05

TREND_LABELS = (
    "Rapid decrease",
    "Moderate decrease",
    "Stable",
    "Moderate increase",
    "Rapid increase",
)
TREND_BOUNDS = (-2.0, -0.5, 0.5, 2.0)
TREND_DEFAULT = "Insufficient data"

DECOUPLING_LABELS = (
    "Absolute decoupling",
    "Relative decoupling",
    "No decoupling",
    "Recession with larger emissions reduction",
    "Recession with smaller emissions reduction",
)
RELATIONSHIP_LABELS = ("Decoupling", "Relative decoupling", "No decoupling")
OTHER = "Other"

MATCH_LABELS = ("Found match", "No match")
# ---------------------------------------------------------------------------


def income_rules(gdp: ColumnOrName, bounds: Sequence[float] = INCOME_BOUNDS) -> list[Rule]:
    """>top: High; [upper_lo, top]: Upper-middle; [lo, lower_hi]: Lower-middle; <lo: Low.

    Values strictly between ``lower_hi`` and ``upper_lo`` match nothing.
    """
    lo, lower_hi, upper_lo, top = bounds
    g = col(gdp)
    high, upper, lower, low = INCOME_LABELS
    return [
        (g > top, high),
        (between(g, upper_lo, top), upper),
        (between(g, lo, lower_hi), lower),
        (g < lo, low),
    ]


def inequality_rules(gini: ColumnOrName, bound: float = INEQUALITY_BOUND) -> list[Rule]:
    g = col(gini)
    high, moderate = INEQUALITY_LABELS
    return [(g > bound, high), (g < bound, moderate)]


def _three_band(c: ColumnOrName, bounds: Sequence[float], labels: Sequence[str]) -> list[Rule]:
    """``< lo``; ``>= lo and < hi``; ``>= hi``."""
    lo, hi = bounds
    x = col(c)
    return [
        (x < lo, labels[0]),
        ((x >= lo) & (x < hi), labels[1]),
        (x >= hi, labels[2]),
    ]


def poverty_rules(gap: ColumnOrName, bounds: Sequence[float] = POVERTY_BOUNDS) -> list[Rule]:
    return _three_band(gap, bounds, POVERTY_LABELS)


def employment_rules(rate: ColumnOrName, bounds: Sequence[float] = EMPLOYMENT_BOUNDS) -> list[Rule]:
    return _three_band(rate, bounds, EMPLOYMENT_LABELS)


def education_rules(enrollment: ColumnOrName, bounds: Sequence[float] = EDUCATION_BOUNDS) -> list[Rule]:
    return _three_band(enrollment, bounds, EDUCATION_LABELS)


def life_expectancy_rules(years: ColumnOrName, bounds: Sequence[float] = LIFE_BOUNDS) -> list[Rule]:
    return _three_band(years, bounds, LIFE_LABELS)


def intensity_rules(total: ColumnOrName, bounds: Sequence[float] = INTENSITY_BOUNDS) -> list[Rule]:
    return _three_band(total, bounds, INTENSITY_LABELS)


def composition_rules(
    co2: ColumnOrName,
    ch4: ColumnOrName,
    total: ColumnOrName,
    bounds: Sequence[float] = COMPOSITION_BOUNDS,
) -> list[Rule]:
    """CO2 share above the first bound, else CH4 share above the second.

    Use with default ``COMPOSITION_LABELS[2]``; a zero total gives NULL shares
    and so the default.
    """
    co2_bound, ch4_bound = bounds
    return [
        (safe_divide(co2, total) * 100 > co2_bound, COMPOSITION_LABELS[0]),
        (safe_divide(ch4, total) * 100 > ch4_bound, COMPOSITION_LABELS[1]),
    ]


def impact_rules(
    short_horizon: ColumnOrName,
    long_horizon: ColumnOrName,
    tolerance: float = IMPACT_TOLERANCE,
) -> list[Rule]:
    """Short- vs long-horizon warming potential.

    ``Balanced`` is tested after ``Fast``, so it is only reachable when the
    short-horizon value is not above the long-horizon one.
    """
    s, l = col(short_horizon), col(long_horizon)
    fast, balanced, slow = IMPACT_LABELS
    return [
        (s > l, fast),
        (F.abs(s - l) <= F.lit(tolerance) * l, balanced),
        (s < l, slow),
    ]


def trend_rules(cagr: ColumnOrName, bounds: Sequence[float] = TREND_BOUNDS) -> list[Rule]:
    """CAGR ladder; shared bounds go to the earlier label (BETWEEN is inclusive)."""
    b1, b2, b3, b4 = bounds
    g = col(cagr)
    rapid_dec, mod_dec, stable, mod_inc, rapid_inc = TREND_LABELS
    return [
        (g < b1, rapid_dec),
        (between(g, b1, b2), mod_dec),
        (between(g, b2, b3), stable),
        (between(g, b3, b4), mod_inc),
        (g > b4, rapid_inc),
    ]


def decoupling_rules(gdp_growth: ColumnOrName, emissions_growth: ColumnOrName, with_recession: bool = True) -> list[Rule]:
    """GDP growth vs emissions growth.

    With ``with_recession=False`` only the first three (growth) cases apply,
    as in the 5-year status.
    """
    g, e = col(gdp_growth), col(emissions_growth)
    absolute, relative, none, larger, smaller = DECOUPLING_LABELS
    rules = [
        ((g > 0) & (e < 0), absolute),
        ((g > 0) & (e > 0) & (g > e), relative),
        ((g > 0) & (e > 0) & (g <= e), none),
    ]
    if with_recession:
        rules += [
            ((g < 0) & (e < 0) & (F.abs(g) < F.abs(e)), larger),
            ((g < 0) & (e < 0) & (F.abs(g) >= F.abs(e)), smaller),
        ]
    return rules


def relationship_rules(emissions_growth: ColumnOrName, gdp_growth: ColumnOrName) -> list[Rule]:
    """Emissions growth vs per-head GDP growth (country profile)."""
    e, g = col(emissions_growth), col(gdp_growth)
    decoupling, relative, none = RELATIONSHIP_LABELS
    return [
        ((e < 0) & (g > 0), decoupling),
        ((e > 0) & (g > 0) & (e < g), relative),
        ((e > 0) & (g > 0) & (e >= g), none),
    ]


def match_status(matched: Column) -> Column:
    found, missing = MATCH_LABELS
    return F.when(matched, F.lit(found)).otherwise(F.lit(missing))
