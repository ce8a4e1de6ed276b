"""The panel models: staging -> dimensions -> facts and dashboards.

Every model is a function of lazy DataFrames and returns a lazy DataFrame;
nothing is collected.

Plan shape.  All dimensions derive from one staged frame whose key
``(country, year)`` is unique (checked by ``quality.unique_violations``).
Joining two projections of that frame on its own key is the same as keeping
one frame and masking the columns of the side whose filter fails (LEFT JOIN)
or filtering on both sides' conditions (INNER JOIN).  ``sovereign_panel``
builds that frame once, with one availability flag per dimension, so the
models need no self-joins: the only shuffles are the one dimension join, the
per-entity window and the aggregations.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from panelyze.functions import rules as C
from panelyze.functions.rules import classify
from panelyze.functions.numeric import (
    cagr_pct,
    exact_avg,
    exact_sum,
    exact_sum_decimal,
    intensity_guarded,
    intensity_nullif,
    nonfinite_seen,
    pct_change,
    pct_diff_from,
    round_half_up,
    safe_divide,
    share_pct,
    share_pct_or_zero,
    sum_all,
    sum_with_nonfinite,
    year_to_date,
)
from panelyze.operators.aggregate import count_labels, mode_of_labels, sample_values
from panelyze.operators.combine import enrich, restrict_to_dim
from panelyze.operators.filters import NON_SOVEREIGN_PATTERNS, not_like_any, nonempty
from panelyze.operators.ordinals import top_row_numbers
from panelyze.operators.quality import unique_violations
from panelyze.operators.windows import (
    attach_group_stats,
    baseline_value,
    exact_lag_present,
    exact_lag_value,
    lag_value,
)


@dataclass(frozen=True)
class ModelParams:
    """Ladder bounds and model constants (defaults are the reference values)."""

    income: tuple[float, float, float, float] = C.INCOME_BOUNDS
    inequality: float = C.INEQUALITY_BOUND
    poverty: tuple[float, float] = C.POVERTY_BOUNDS
    employment: tuple[float, float] = C.EMPLOYMENT_BOUNDS
    education: tuple[float, float] = C.EDUCATION_BOUNDS
    life: tuple[float, float] = C.LIFE_BOUNDS
    intensity: tuple[float, float] = C.INTENSITY_BOUNDS
    composition: tuple[float, float] = C.COMPOSITION_BOUNDS
    impact_tolerance: float = C.IMPACT_TOLERANCE
    trend: tuple[float, float, float, float] = C.TREND_BOUNDS
    # emissions per this much GDP
    gdp_unit: float = 1_000_000.0
    # rank cut of the top-emitter report
    top_n: int = 50
    # True: the caller has checked that the panel holds one row per (country,
    # year) (``checked_unique``), so the number of countries in a group of one
    # year is a plain count, aggregated before its shuffle.  By default the
    # countries are counted distinct.
    key_unique: bool = False


# Source column -> staged name.
STAGED_COLUMNS = (
    ("sp_pop_totl", "population"),
    ("ny_gdp_pcap_cd", "gdp_per_capita"),
    ("sp_dyn_le00_in", "life_expectancy"),
    ("se_sec_enrr", "school_enrollment"),
    ("sl_uem_totl_zs", "unemployment_rate"),
    ("si_pov_gini", "gini_index"),
    ("si_pov_gaps", "poverty_gap_2_15_usd"),
    ("co2", "co2_emissions"),
    ("ch4", "ch4_emissions"),
    ("n2o", "n2o_emissions"),
    ("co2e_100yr", "co2e_100yr_global_warming_potential"),
    ("co2e_20yr", "co2e_20yr_global_warming_potential"),
)
REQUIRED_SOURCE = ("country", "year", "co2", "ny_gdp_pcap_cd", "sp_pop_totl")

GASES = ("co2_emissions", "ch4_emissions", "n2o_emissions")
TOTAL = "calculated_total_emissions"

# Availability flags of the three dimensions inside the sovereign panel.
HAS_EMISSIONS = "_has_emissions"
HAS_SOCIO = "_has_socio"

DIM_EMISSIONS_COLUMNS = (
    "country",
    "year",
    "co2_emissions",
    "ch4_emissions",
    "n2o_emissions",
    "co2e_100yr_global_warming_potential",
    "co2e_20yr_global_warming_potential",
    TOTAL,
    "co2_percentage",
    "ch4_percentage",
    "n2o_percentage",
    "emission_intensity_category",
    "ghg_composition",
    "climate_impact_category",
)
DIM_SOCIO_COLUMNS = (
    "country",
    "year",
    "population",
    "gdp_per_capita",
    "gini_index",
    "poverty_gap_2_15_usd",
    "unemployment_rate",
    "school_enrollment",
    "life_expectancy",
    "income_category",
    "inequality_category",
    "poverty_intensity",
    "employment_status",
)
DIM_WELLBEING_COLUMNS = (
    "country",
    "year",
    "school_enrollment",
    "life_expectancy",
    "education_access_category",
    "life_expectancy_group",
)


def country_count(p: ModelParams) -> Column:
    """Countries in a group of one year (see ``ModelParams.key_unique``)."""
    return F.count("country") if p.key_unique else F.count_distinct("country")


def checked_unique(panel: DataFrame, p: ModelParams) -> ModelParams:
    """``p`` for a panel without repeated keys; raises if a key repeats (one aggregation)."""
    if unique_violations(panel, ["country", "year"]).limit(1).count():
        raise ValueError("the panel repeats a (country, year) key")
    return replace(p, key_unique=True)


def with_key_seen(panel: DataFrame, p: ModelParams) -> ModelParams:
    """``p`` with ``key_unique`` as the panel has it (one aggregation); a repeated key is no error."""
    return replace(p, key_unique=not unique_violations(panel, ["country", "year"]).limit(1).count())


# ---------------------------------------------------------------- staging


def stg_combined(combined: DataFrame) -> DataFrame:
    """Typed panel of the rows with both sources present.

    A column that no source delivered is an error, not a column of NULLs.
    """
    needed = dict.fromkeys([*REQUIRED_SOURCE, *[c for c, _ in STAGED_COLUMNS]])
    missing = [c for c in needed if c not in set(combined.columns)]
    if missing:
        raise ValueError(f"the combined panel lacks {', '.join(missing)}")
    base = combined.where(F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in REQUIRED_SOURCE)))
    return base.select(
        F.col("country"),
        F.col("year").cast("int").alias("year"),
        *[F.col(s).try_cast("double").alias(d) for s, d in STAGED_COLUMNS],
    )


def stg_countries(seed: DataFrame, patterns: Sequence[str] = NON_SOVEREIGN_PATTERNS) -> DataFrame:
    """Sovereign-country dimension from the seed (hyphenated names renamed)."""
    sel = seed.select(
        F.col("name").alias("country_name"),
        F.col("`alpha-2`").alias("alpha_2"),
        F.col("`alpha-3`").alias("alpha_3"),
        F.col("`country-code`").alias("country_code"),
        F.col("region"),
        F.col("`sub-region`").alias("sub_region"),
    )
    key_ok = F.col("alpha_3").isNotNull()
    if isinstance(sel.schema["alpha_3"].dataType, StringType):
        key_ok = key_ok & (F.col("alpha_3") != F.lit(""))
    return sel.where(key_ok & F.col("country_code").isNotNull() & not_like_any("country_name", patterns))


def stg_sovereign(staged: DataFrame, countries: DataFrame) -> DataFrame:
    """Staged panel rows whose country is in the sovereign dimension."""
    return restrict_to_dim(staged, countries, "country", "alpha_3")


def sovereign_panel(staged: DataFrame, countries: DataFrame, p: ModelParams = ModelParams()) -> DataFrame:
    """The staged sovereign panel with every dimension column and category.

    One inner join to the dimension (equal to the semi join of
    ``stg_sovereign`` because ``alpha_3`` is unique) also brings the name,
    region and sub-region every later model needs.
    """
    df = enrich(staged, countries, "country", "alpha_3", ["country_name", "region", "sub_region"], "inner")
    co2, ch4, n2o = (F.col(g) for g in GASES)
    total = F.col(TOTAL)
    gdp, pop = F.col("gdp_per_capita"), F.col("population")
    df = df.withColumns(
        {
            "year_num": F.col("year"),
            "year": year_to_date("year"),
            TOTAL: sum_all(co2, ch4, n2o),
        }
    )
    return df.withColumns(
        {
            "co2_percentage": share_pct_or_zero(co2, total),
            "ch4_percentage": share_pct_or_zero(ch4, total),
            "n2o_percentage": share_pct_or_zero(n2o, total),
            "emission_intensity_category": classify(C.intensity_rules(total, p.intensity), C.UNKNOWN),
            "ghg_composition": classify(C.composition_rules(co2, ch4, total, p.composition), C.COMPOSITION_LABELS[2]),
            "climate_impact_category": classify(
                C.impact_rules(
                    "co2e_20yr_global_warming_potential", "co2e_100yr_global_warming_potential", p.impact_tolerance
                ),
                C.UNKNOWN,
            ),
            "income_category": classify(C.income_rules(gdp, p.income), C.UNKNOWN),
            "inequality_category": classify(C.inequality_rules("gini_index", p.inequality), C.UNKNOWN),
            "poverty_intensity": classify(C.poverty_rules("poverty_gap_2_15_usd", p.poverty), C.UNKNOWN),
            "employment_status": classify(C.employment_rules("unemployment_rate", p.employment), C.UNKNOWN),
            "education_access_category": classify(C.education_rules("school_enrollment", p.education), C.UNKNOWN),
            "life_expectancy_group": classify(C.life_expectancy_rules("life_expectancy", p.life), C.UNKNOWN),
            HAS_EMISSIONS: F.col("country").isNotNull() & (total > 0),
            HAS_SOCIO: (pop > 0) & gdp.isNotNull(),
        }
    )


def socio(name: str) -> Column:
    """A socioeconomic column as seen through ``LEFT JOIN dim_socio``."""
    return F.when(F.col(HAS_SOCIO), F.col(name)).alias(name)


# -------------------------------------------------------------- dimensions


def dim_emissions(panel: DataFrame) -> DataFrame:
    return panel.where(F.col(HAS_EMISSIONS)).select(*DIM_EMISSIONS_COLUMNS)


def dim_socio(panel: DataFrame) -> DataFrame:
    return panel.where(F.col(HAS_SOCIO)).select(*DIM_SOCIO_COLUMNS)


def dim_wellbeing(panel: DataFrame) -> DataFrame:
    return panel.where(F.col("country").isNotNull()).select(*DIM_WELLBEING_COLUMNS)


# ------------------------------------------------------------------- facts


def fct_region(panel: DataFrame, p: ModelParams = ModelParams()) -> DataFrame:
    """Emissions, population and income mix by region and year."""
    rows = panel.where(F.col(HAS_EMISSIONS) & nonempty("region")).select(
        "region", "year", "country", TOTAL, *GASES, socio("population"), socio("gdp_per_capita"), socio("income_category")
    )
    counts = count_labels("income_category", C.INCOME_LABELS)
    return rows.groupBy("region", "year").agg(
        country_count(p).alias("country_count"),
        exact_sum(TOTAL).alias("total_emissions"),
        *[exact_sum(g).alias(g) for g in GASES],
        exact_sum("population").alias("total_population"),
        round_half_up(exact_avg("gdp_per_capita"), 2).alias("avg_gdp_per_capita"),
        round_half_up(safe_divide(exact_sum(TOTAL), exact_sum("population")), 2).alias("emissions_per_capita"),
        counts[0].alias("high_income_count"),
        counts[1].alias("upper_middle_income_count"),
        counts[2].alias("lower_middle_income_count"),
        counts[3].alias("low_income_count"),
    )


def fct_subregion(panel: DataFrame, p: ModelParams = ModelParams()) -> DataFrame:
    """Region / sub-region / year summary with gas shares and the dominant profile.

    The dominant composition is the mode over the known label set, taken
    from per-label counts in the same aggregation (ties: later label).
    """
    rows = panel.where(F.col(HAS_EMISSIONS) & nonempty("sub_region")).select(
        "region",
        "sub_region",
        "year",
        "country",
        TOTAL,
        *GASES,
        "ghg_composition",
        socio("population"),
        socio("gdp_per_capita"),
    )
    rows = rows.withColumn(
        "emissions_per_gdp", intensity_guarded(TOTAL, "gdp_per_capita", "population", unit=1.0)
    )
    tot = exact_sum(TOTAL)
    comp_counts = count_labels("ghg_composition", C.COMPOSITION_LABELS)
    out = rows.groupBy("region", "sub_region", "year").agg(
        country_count(p).alias("country_count"),
        tot.alias("total_emissions"),
        *[exact_sum(g).alias(g) for g in GASES],
        exact_sum("population").alias("total_population"),
        round_half_up(exact_avg("gdp_per_capita"), 2).alias("avg_gdp_per_capita"),
        round_half_up(share_pct(exact_sum("co2_emissions"), tot), 2).alias("co2_percentage"),
        round_half_up(share_pct(exact_sum("ch4_emissions"), tot), 2).alias("ch4_percentage"),
        round_half_up(share_pct(exact_sum("n2o_emissions"), tot), 2).alias("n2o_percentage"),
        round_half_up(safe_divide(tot, exact_sum("population")), 2).alias("emissions_per_capita"),
        round_half_up(exact_avg("emissions_per_gdp", 18), 8).alias("avg_emissions_per_gdp"),
        mode_of_labels(comp_counts, C.COMPOSITION_LABELS).alias("dominant_ghg_composition"),
    )
    return out.orderBy(F.col("year").desc(), F.col("total_emissions").desc())


# --------------------------------------------------------------- dashboards


def by_development(panel: DataFrame, p: ModelParams = ModelParams()) -> DataFrame:
    """Emissions by income category and year with shares of the yearly total.

    The yearly total is a window over the already aggregated rows (a few per
    year), with the sums kept as decimals so the shares are exact.
    """
    rows = panel.where(F.col(HAS_EMISSIONS) & F.col(HAS_SOCIO) & (F.col("population") > 0)).select(
        "year",
        "income_category",
        "country",
        TOTAL,
        *GASES,
        "population",
        "gdp_per_capita",
        safe_divide(TOTAL, "population").alias("emissions_per_capita"),
        intensity_guarded(TOTAL, "gdp_per_capita", "population", p.gdp_unit).alias("emissions_per_million_gdp"),
    )
    g = rows.groupBy("year", "income_category").agg(
        country_count(p).alias("country_count"),
        exact_sum_decimal(TOTAL).alias("_total"),
        nonfinite_seen(TOTAL).alias("_total_seen"),
        *[exact_sum(c).alias(c) for c in GASES],
        round_half_up(exact_avg("emissions_per_capita"), 2).alias("avg_emissions_per_capita"),
        round_half_up(exact_avg("emissions_per_million_gdp"), 2).alias("avg_emissions_per_million_gdp"),
        exact_sum_decimal("population").alias("_population"),
        nonfinite_seen("population").alias("_population_seen"),
        round_half_up(exact_avg("gdp_per_capita"), 2).alias("avg_gdp_per_capita"),
    )
    yearly = Window.partitionBy("year")
    own = {c: sum_with_nonfinite(F.col(c), F.col(f"{c}_seen")) for c in ("_total", "_population")}
    share = {
        c: v / sum_with_nonfinite(F.sum(c).over(yearly), F.bit_or(f"{c}_seen").over(yearly)) for c, v in own.items()
    }
    e_share, p_share = share["_total"], share["_population"]
    return g.select(
        "year",
        "income_category",
        "country_count",
        own["_total"].alias("total_emissions"),
        *GASES,
        "avg_emissions_per_capita",
        "avg_emissions_per_million_gdp",
        own["_population"].alias("total_population"),
        "avg_gdp_per_capita",
        round_half_up(e_share * 100, 2).alias("percentage_of_global_emissions"),
        round_half_up(p_share * 100, 2).alias("percentage_of_global_population"),
        round_half_up(safe_divide(e_share, p_share), 2).alias("emissions_to_population_ratio"),
    )


def time_series(panel: DataFrame, p: ModelParams = ModelParams()) -> DataFrame:
    """Per-country trend: year-over-year change, baseline comparison, CAGR.

    Lag and baseline use one window specification (country, ordered by
    year), so Spark evaluates them in a single window pass after one
    exchange on ``country``.
    """
    rows = panel.where(F.col(HAS_EMISSIONS)).select(
        "country",
        "country_name",
        "year",
        "year_num",
        "region",
        "sub_region",
        TOTAL,
        *GASES,
        "ghg_composition",
        socio("population"),
        socio("gdp_per_capita"),
        socio("income_category"),
    )
    rows = rows.withColumn("_epc", safe_divide(TOTAL, "population"))
    prev_total = lag_value(TOTAL, "country", "year")
    prev_co2 = lag_value("co2_emissions", "country", "year")
    rows = rows.withColumns(
        {
            "_prev_total": prev_total,
            "_prev_co2": prev_co2,
            "baseline_year": baseline_value("year_num", "country", "year"),
            "baseline_emissions": baseline_value(TOTAL, "country", "year"),
            "baseline_emissions_per_capita": baseline_value("_epc", "country", "year"),
        }
    )
    cagr = round_half_up(cagr_pct(TOTAL, "baseline_emissions", "year_num", "baseline_year"), 2)
    rows = rows.withColumn("emissions_cagr", cagr)
    return rows.select(
        "country",
        "country_name",
        "year",
        "region",
        "sub_region",
        TOTAL,
        *GASES,
        *[round_half_up(share_pct(g, TOTAL), 2).alias(g.replace("_emissions", "_percentage")) for g in GASES],
        "ghg_composition",
        "population",
        "gdp_per_capita",
        "income_category",
        round_half_up("_epc", 2).alias("emissions_per_capita"),
        (F.col(TOTAL) - F.col("_prev_total")).alias("absolute_emissions_change"),
        round_half_up(pct_change(TOTAL, "_prev_total"), 2).alias("yoy_emissions_change_pct"),
        (
            round_half_up(share_pct("co2_emissions", TOTAL), 2)
            - round_half_up(share_pct("_prev_co2", "_prev_total"), 2)
        ).alias("co2_percentage_point_change"),
        "baseline_year",
        "baseline_emissions",
        "baseline_emissions_per_capita",
        round_half_up(pct_change(TOTAL, "baseline_emissions"), 2).alias("pct_change_from_baseline"),
        "emissions_cagr",
        classify(C.trend_rules("emissions_cagr", p.trend), C.TREND_DEFAULT).alias("long_term_trend"),
    )


def gdp_correlation(panel: DataFrame, p: ModelParams = ModelParams()) -> DataFrame:
    """Country vs regional average, exact 1- and 5-year growth, decoupling status.

    Regional averages come from a ``groupBy(year, region)`` joined back
    behind a size check.  Growth over exactly 1 and 5 years uses range
    frames on the integer year, so a country with a gap gets NULL growth
    instead of growth from the previous available year.
    """
    rows = panel.where(
        F.col(HAS_EMISSIONS) & F.col(HAS_SOCIO) & (F.col("gdp_per_capita") > 0) & (F.col("population") > 0)
    ).select(
        "country",
        "country_name",
        "year",
        "year_num",
        "region",
        "sub_region",
        "gdp_per_capita",
        "population",
        (F.col("gdp_per_capita") * F.col("population")).alias("total_gdp"),
        TOTAL,
        safe_divide(TOTAL, "population").alias("_epc"),
        intensity_guarded(TOTAL, "gdp_per_capita", "population", p.gdp_unit).alias("_epmg"),
    )
    # Window values first, as columns, so each is evaluated once.
    lagged = rows.withColumns(
        {
            "_gdp_1": exact_lag_value("total_gdp", "country", "year_num", 1),
            "_tot_1": exact_lag_value(TOTAL, "country", "year_num", 1),
            "_gdp_5": exact_lag_value("total_gdp", "country", "year_num", 5),
            "_tot_5": exact_lag_value(TOTAL, "country", "year_num", 5),
            "_has_5": exact_lag_present("country", "year_num", 5),
        }
    )
    windowed = lagged.withColumns(
        {
            "gdp_growth_pct": round_half_up(pct_change("total_gdp", "_gdp_1"), 2),
            "emissions_growth_pct": round_half_up(pct_change(TOTAL, "_tot_1"), 2),
            "gdp_growth_5yr_pct": F.when(F.col("_has_5"), round_half_up(pct_change("total_gdp", "_gdp_5"), 2)),
            "emissions_growth_5yr_pct": F.when(F.col("_has_5"), round_half_up(pct_change(TOTAL, "_tot_5"), 2)),
        }
    )
    with_avg = attach_group_stats(
        windowed,
        ["year", "region"],
        {
            "_avg_gdp": exact_avg("gdp_per_capita"),
            "_avg_epc": exact_avg("_epc"),
            "_avg_ci": exact_avg("_epmg"),
        },
        source=rows,
    )
    return with_avg.select(
        "country",
        "country_name",
        "year",
        "region",
        "sub_region",
        "gdp_per_capita",
        "population",
        "total_gdp",
        TOTAL,
        round_half_up("_epc", 2).alias("emissions_per_capita"),
        round_half_up("_epmg", 2).alias("emissions_per_million_gdp"),
        round_half_up("_avg_gdp", 2).alias("avg_regional_gdp_per_capita"),
        round_half_up("_avg_epc", 2).alias("avg_regional_emissions_per_capita"),
        round_half_up("_avg_ci", 2).alias("avg_regional_carbon_intensity"),
        round_half_up(pct_diff_from("gdp_per_capita", "_avg_gdp"), 2).alias("gdp_vs_regional_avg_pct"),
        round_half_up(pct_diff_from("_epc", "_avg_epc"), 2).alias("emissions_vs_regional_avg_pct"),
        "gdp_growth_pct",
        "emissions_growth_pct",
        "gdp_growth_5yr_pct",
        "emissions_growth_5yr_pct",
        classify(C.decoupling_rules("gdp_growth_pct", "emissions_growth_pct"), C.OTHER).alias("decoupling_status"),
        classify(
            C.decoupling_rules("gdp_growth_5yr_pct", "emissions_growth_5yr_pct", with_recession=False), C.OTHER
        ).alias("decoupling_status_5yr"),
    )


def country_profile(panel: DataFrame, entities=None, p: ModelParams = ModelParams()) -> DataFrame:
    """Yearly profile with year-over-year changes for one country, a list, or all.

    With a single entity the output has no ``country`` column.  Changes are
    per country (partitioned window), never a window over the whole table.
    """
    rows = panel.where(F.col(HAS_EMISSIONS))
    if entities is not None:
        many = isinstance(entities, (list, tuple, set, frozenset))
        rows = rows.where(F.col("country").isin(list(entities)) if many else F.col("country") == F.lit(entities))
    rows = rows.select(
        "country",
        "year",
        TOTAL,
        *GASES,
        "co2e_100yr_global_warming_potential",
        "co2e_20yr_global_warming_potential",
        "ghg_composition",
        "emission_intensity_category",
        "climate_impact_category",
        socio("population"),
        socio("gdp_per_capita"),
        socio("gini_index"),
        "life_expectancy",
        "school_enrollment",
    )
    yoy = {
        "yoy_emissions_change_pct": TOTAL,
        "yoy_population_change_pct": "population",
        "yoy_gdp_per_capita_change_pct": "gdp_per_capita",
    }
    rows = rows.withColumns({f"_prev_{c}": lag_value(c, "country", "year") for c in yoy.values()})
    rows = rows.withColumns(
        {name: round_half_up(pct_change(c, f"_prev_{c}"), 2) for name, c in yoy.items()}
    )
    keep_country = entities is None or isinstance(entities, (list, tuple, set, frozenset))
    return rows.select(
        *(["country"] if keep_country else []),
        "year",
        "population",
        "gdp_per_capita",
        "gini_index",
        "life_expectancy",
        "school_enrollment",
        TOTAL,
        *GASES,
        round_half_up(safe_divide(TOTAL, "population"), 2).alias("emissions_per_capita"),
        round_half_up(intensity_nullif(TOTAL, "gdp_per_capita", "population", p.gdp_unit), 2).alias(
            "emissions_per_million_gdp"
        ),
        *[round_half_up(share_pct(g, TOTAL), 2).alias(g.replace("_emissions", "_percentage")) for g in GASES],
        *yoy.keys(),
        classify(
            C.relationship_rules("yoy_emissions_change_pct", "yoy_gdp_per_capita_change_pct"), C.OTHER
        ).alias("economic_emissions_relationship"),
        "ghg_composition",
        "emission_intensity_category",
        "climate_impact_category",
    )


def region_countries(panel: DataFrame, region: str, p: ModelParams = ModelParams()) -> DataFrame:
    """Countries of one region with size, intensity, categories and yearly change."""
    rows = panel.where(F.col(HAS_EMISSIONS) & (F.col("region") == F.lit(region))).select(
        "country",
        "country_name",
        "year",
        "sub_region",
        TOTAL,
        *GASES,
        "ghg_composition",
        "emission_intensity_category",
        "climate_impact_category",
        socio("population"),
        socio("gdp_per_capita"),
        socio("income_category"),
        socio("inequality_category"),
        "education_access_category",
        "life_expectancy_group",
    )
    rows = rows.withColumn("_prev_total", lag_value(TOTAL, "country", "year"))
    out = rows.select(
        "country",
        "country_name",
        "year",
        "sub_region",
        "population",
        "gdp_per_capita",
        TOTAL,
        *GASES,
        round_half_up(safe_divide(TOTAL, "population"), 2).alias("emissions_per_capita"),
        round_half_up(intensity_nullif(TOTAL, "gdp_per_capita", "population", p.gdp_unit), 2).alias(
            "emissions_per_million_gdp"
        ),
        "ghg_composition",
        "emission_intensity_category",
        "climate_impact_category",
        "income_category",
        "inequality_category",
        "education_access_category",
        "life_expectancy_group",
        round_half_up(pct_change(TOTAL, "_prev_total"), 2).alias("yoy_emissions_change_pct"),
    )
    return out.orderBy(F.col("year").desc(), F.col(TOTAL).desc())


def top_emitters(panel: DataFrame, p: ModelParams = ModelParams()) -> DataFrame:
    """Countries in the top ``top_n`` of a year by total or per-head emissions.

    Yearly totals are a ``groupBy(year)`` joined back behind a size check.
    The three rankings are row numbers within the year, ties broken by
    country so the result is deterministic.  They are counted over ranges
    (``ordinals.top_row_numbers``), so no year is ever sorted in a single
    task; the few numbered rows are written when the plan is built.
    """
    rows = panel.where(F.col(HAS_EMISSIONS) & F.col(HAS_SOCIO) & (F.col("population") > 0)).select(
        "country",
        "country_name",
        "year",
        "region",
        "sub_region",
        TOTAL,
        *GASES,
        "ghg_composition",
        "population",
        "gdp_per_capita",
        "income_category",
        safe_divide(TOTAL, "population").alias("_epc"),
        intensity_guarded(TOTAL, "gdp_per_capita", "population", p.gdp_unit).alias("_epmg"),
    )
    ranks = {"emissions_rank": TOTAL, "per_capita_rank": "_epc", "carbon_intensity_rank": "_epmg"}
    top = top_row_numbers(rows, ["year"], "country", ranks, ["emissions_rank", "per_capita_rank"], p.top_n)
    ranked = rows.join(top, ["year", "country"])
    with_tot = attach_group_stats(
        ranked,
        ["year"],
        {"_global_e": exact_sum(TOTAL), "_global_p": exact_sum("population")},
        source=rows,
    )
    pct_e = round_half_up(share_pct(TOTAL, "_global_e"), 2)
    pct_p = round_half_up(share_pct("population", "_global_p"), 2)
    out = with_tot.withColumns({"pct_of_global_emissions": pct_e, "pct_of_global_population": pct_p}).select(
        "country",
        "country_name",
        "year",
        "region",
        "sub_region",
        TOTAL,
        *GASES,
        *[round_half_up(share_pct(g, TOTAL), 2).alias(g.replace("_emissions", "_percentage")) for g in GASES],
        "population",
        "gdp_per_capita",
        "income_category",
        round_half_up("_epc", 2).alias("emissions_per_capita"),
        round_half_up("_epmg", 2).alias("emissions_per_million_gdp"),
        "pct_of_global_emissions",
        "pct_of_global_population",
        "emissions_rank",
        "per_capita_rank",
        "carbon_intensity_rank",
        round_half_up(safe_divide("pct_of_global_emissions", "pct_of_global_population"), 2).alias(
            "emissions_to_population_ratio"
        ),
        "ghg_composition",
    )
    return out.orderBy(F.col("year").desc(), F.col(TOTAL).desc())


# ----------------------------------------------------------------- checks


def source_check(combined: DataFrame) -> DataFrame:
    return combined.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_distinct("country").alias("distinct_countries")
    )


def join_check(combined: DataFrame, countries: DataFrame, sample: int = 10) -> DataFrame:
    """Distinct source countries found / not found in the dimension, with samples."""
    src = combined.select(F.col("country").alias("source_country")).distinct()
    dim = countries.select(F.col("alpha_3").alias("_code")).distinct()
    checked = src.join(dim, src.source_country == dim._code, "left").select(
        "source_country", C.match_status(F.col("_code").isNotNull()).alias("match_status")
    )
    counts = checked.groupBy("match_status").agg(F.count(F.lit(1)).alias("country_count"))
    samples = sample_values(checked, ["match_status"], "source_country", sample, "sample_countries")
    return counts.join(samples, "match_status", "left")


def top_k(panel: DataFrame, metric: str, k: int = 10) -> DataFrame:
    """The ``k`` largest rows of a metric (dashboard top list), ties by country and year."""
    return panel.orderBy(F.col(metric).desc_nulls_last(), "country", "year").limit(k)


def top_k_per_head(panel: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` country-years with the most emissions per head, ties by country and year."""
    rows = panel.where(F.col(HAS_EMISSIONS) & F.col(HAS_SOCIO)).select(
        "country", "year", TOTAL, "population", safe_divide(TOTAL, "population").alias("emissions_per_capita")
    )
    return top_k(rows, "emissions_per_capita", k)


__all__ = [
    "ModelParams",
    "by_development",
    "country_profile",
    "dim_emissions",
    "dim_socio",
    "dim_wellbeing",
    "fct_region",
    "fct_subregion",
    "gdp_correlation",
    "join_check",
    "region_countries",
    "source_check",
    "sovereign_panel",
    "stg_combined",
    "stg_countries",
    "stg_sovereign",
    "time_series",
    "top_emitters",
    "top_k",
]
