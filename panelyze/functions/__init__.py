"""Column-level functions: safe arithmetic, rounding, growth and classification."""

from panelyze.functions.rules import (  # noqa: F401
    classify,
    composition_rules,
    decoupling_rules,
    education_rules,
    employment_rules,
    impact_rules,
    income_rules,
    inequality_rules,
    intensity_rules,
    life_expectancy_rules,
    match_status,
    poverty_rules,
    relationship_rules,
    trend_rules,
)
from panelyze.functions.numeric import (  # noqa: F401
    cagr_pct,
    exact_avg,
    exact_sum,
    intensity_guarded,
    intensity_nullif,
    money_cents,
    pct_change,
    pct_diff_from,
    per_capita,
    round_half_up,
    safe_divide,
    share_pct,
    share_pct_or_zero,
    sum_all,
    total_gdp,
    year_to_date,
)
