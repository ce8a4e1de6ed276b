"""The queries as plain SQL (DuckDB dialect) over the driver's tables.

Every panel model is a select list over one of two frames: ``wide``, one row
per country and year with its place, total and labels, and ``em``, the rows of
``wide`` with emissions, in which the columns that need a population are blanked
where there is none.  Lags, baselines, averages and ranks are windows over these
frames; no model has a statement of its own beyond its list.

Sums are DECIMAL(38,9) sums of the printed values and averages are DuckDB's own,
so neither shares code or method with the DataFrame side.
"""

from __future__ import annotations

from panelyze.plans.testpanel import NAME_SUFFIX, ODD, REGION_GAPS, PanelThresholds


def R(expr: str, n: int = 2) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,{n + 7})), {n}) AS DOUBLE)"


def DEC(expr: str) -> str:
    return f"CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,9))"


def XSUM(expr: str) -> str:
    return f"CAST(SUM({DEC(expr)}) AS DOUBLE)"


def q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def per(a: str, b: str, factor: str = "") -> str:
    return f"({a}) / NULLIF({b}, 0)" + (f" * {factor}" if factor else "")


def growth(now: str, before: str) -> str:
    return R(f"(({now}) - ({before})) / NULLIF({before}, 0) * 100")


def ladder(steps, default: str = "Unknown") -> str:
    """CASE from (condition, label) pairs."""
    return "CASE " + " ".join(f"WHEN {c} THEN {q(label)}" for c, label in steps) + f" ELSE {q(default)} END"


T = PanelThresholds()
LOW, MID_LOW, MID, HIGH = T.income
SMALL, LARGE = T.intensity

# ------------------------------------------------------------------ panel


def _cents(flag: str, name: str) -> str:
    return f"SUM(CAST(round(l_extendedprice * 100) AS BIGINT)) FILTER (WHERE l_returnflag = {q(flag)}) AS {name}"


def _key_number(a: int, b: int, m: int, first: int, gap: str) -> str:
    return f"CASE WHEN {gap} <> 0 THEN CAST({first} + (country * {a} + year * {b}) % {m} AS DOUBLE) END"


_GAS = ", ".join(
    f"CASE WHEN (country + year) % {ODD['no_gas']} = 0 THEN 0.0::DOUBLE"
    f" ELSE CAST(CASE WHEN priced THEN COALESCE({g}_c, 0) END AS DOUBLE) / 100 END AS {g}"
    for g in ("co2", "ch4", "n2o")
)

COMBINED = f"""
order_sums AS (
  SELECT l_orderkey AS k, SUM(l_quantity) AS amount, {_cents('N', 'a')}, {_cents('A', 'b')}, {_cents('R', 'c')}
  FROM lineitem GROUP BY 1
),
customer_years AS (
  SELECT CASE WHEN o_custkey % {ODD['null_key']} <> 0 THEN o_custkey END AS country,
         CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS orders, COUNT(k) > 0 AS priced,
         SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS paid, SUM(amount) AS amount,
         SUM(a) AS co2_c, SUM(b) AS ch4_c, SUM(c) AS n2o_c
  FROM orders LEFT JOIN order_sums ON k = o_orderkey
  GROUP BY 1, 2
),
with_gas AS (SELECT *, {_GAS} FROM customer_years),
combined AS (
  SELECT country, year,
    CASE WHEN (country * 3 + year) % {ODD['no_population']} = 0 THEN 0.0::DOUBLE ELSE amount END AS sp_pop_totl,
    CAST(paid AS DOUBLE) / (orders * 100) AS ny_gdp_pcap_cd,
    {_key_number(7, 3, 40, 50, 'country % 13')} AS sp_dyn_le00_in,
    {_key_number(11, 5, 70, 40, 'country % 7')} AS se_sec_enrr,
    {_key_number(3, 1, 25, 0, 'country % 17')} AS sl_uem_totl_zs,
    {_key_number(13, 11, 40, 0, 'country % 5')} AS si_pov_gaps,
    {_key_number(5, 7, 30, 25, '(country + year) % 3')} AS si_pov_gini,
    co2, ch4, n2o,
    co2 * 1.0::DOUBLE + ch4 * 28.0::DOUBLE + n2o * 300.0::DOUBLE AS co2e_100yr,
    co2 * 1.0::DOUBLE + ch4 * 84.0::DOUBLE + n2o * 264.0::DOUBLE AS co2e_20yr
  FROM with_gas
)"""

_SUFFIX = "CASE c_custkey % {} {} ELSE '' END".format(
    ODD["name"], " ".join(f"WHEN {r} THEN {q(t)}" for r, t in NAME_SUFFIX)
)


def _gap(column: str, side: int) -> str:
    whens = " ".join(f"WHEN {g[0]} THEN {q(g[side])}" for g in REGION_GAPS if g[side] != "kept")
    return f"CASE c_custkey % {ODD['region']} {whens} ELSE {column} END"


_CODE = f"CASE WHEN c_custkey % {ODD['no_dim']} <> 0 THEN c_custkey END"
_FOREIGN = " OR ".join(f"contains(country_name, {q(w)})" for w in ("Territory", "Island", "Dependencies", "Dependency"))

# Staged name of each source column, in the order of the staged panel.
_STAGED = {
    "population": "sp_pop_totl", "gdp_per_capita": "ny_gdp_pcap_cd", "life_expectancy": "sp_dyn_le00_in",
    "school_enrollment": "se_sec_enrr", "unemployment_rate": "sl_uem_totl_zs", "gini_index": "si_pov_gini",
    "poverty_gap_2_15_usd": "si_pov_gaps", "co2_emissions": "co2", "ch4_emissions": "ch4", "n2o_emissions": "n2o",
    "co2e_100yr_global_warming_potential": "co2e_100yr", "co2e_20yr_global_warming_potential": "co2e_20yr",
}

STAGING = f"""
staged AS (
  SELECT country, year, {', '.join(f'{s}::DOUBLE AS {d}' for d, s in _STAGED.items())}
  FROM combined
  WHERE country IS NOT NULL AND year IS NOT NULL AND co2 IS NOT NULL AND ny_gdp_pcap_cd IS NOT NULL
    AND sp_pop_totl IS NOT NULL
),
places AS (
  SELECT * FROM (
    SELECT c_name || {_SUFFIX} AS country_name, left(c_mktsegment, 2) AS alpha_2, {_CODE} AS alpha_3,
           c_nationkey AS country_code, {_gap('r_name', 1)} AS region, {_gap('n_name', 2)} AS sub_region
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
  ) named
  WHERE alpha_3 IS NOT NULL AND country_code IS NOT NULL AND NOT ({_FOREIGN})
)"""

_G20, _G100 = "co2e_20yr_global_warming_potential", "co2e_100yr_global_warming_potential"
_LABELS = {
    "emission_intensity_category": ladder(
        [(f"total < {SMALL}", "Low Emitters"), (f"total < {LARGE}", "Medium Emitters"), (f"total >= {LARGE}", "High Emitters")]
    ),
    "ghg_composition": ladder(
        [
            (f"{per('co2_emissions', 'total', '100')} > 70", "CO₂-Dominant"),
            (f"{per('ch4_emissions', 'total', '100')} > 50", "Methane-Dominant"),
        ],
        "Mixed Emissions",
    ),
    "climate_impact_category": ladder(
        [
            (f"{_G20} > {_G100}", "Fast Warming Country"),
            (f"{_G100} - {_G20} <= 0.05 * {_G100}", "Balanced Warming"),
            (f"{_G20} < {_G100}", "Slow Warming Country"),
        ]
    ),
    "income_category": ladder(
        [
            (f"gdp_per_capita < {LOW}", "Low income"),
            (f"gdp_per_capita <= {MID_LOW}", "Lower-middle income"),
            (f"gdp_per_capita < {MID}", "Unknown"),
            (f"gdp_per_capita <= {HIGH}", "Upper-middle income"),
            (f"gdp_per_capita > {HIGH}", "High income"),
        ]
    ),
    "inequality_category": ladder([("gini_index > 40", "High inequality"), ("gini_index < 40", "Moderate or low inequality")]),
    "poverty_intensity": ladder(
        [("poverty_gap_2_15_usd < 5", "Low Poverty"), ("poverty_gap_2_15_usd < 20", "Moderate Poverty"), ("poverty_gap_2_15_usd >= 20", "Severe Poverty")]
    ),
    "employment_status": ladder(
        [("unemployment_rate < 5", "Low Unemployment"), ("unemployment_rate < 15", "Moderate Unemployment"), ("unemployment_rate >= 15", "High Unemployment")]
    ),
    "education_access_category": ladder(
        [("school_enrollment < 60", "Low enrollment"), ("school_enrollment < 90", "Medium enrollment"), ("school_enrollment >= 90", "High enrollment")]
    ),
    "life_expectancy_group": ladder(
        [("life_expectancy < 60", "Low life Expectancy"), ("life_expectancy < 75", "Medium life expectancy"), ("life_expectancy >= 75", "High life expectancy")]
    ),
}

# Columns that a row without population or income does not show.
_NEEDS_PEOPLE = ("population", "gdp_per_capita", "income_category", "gini_index", "inequality_category")

FRAMES = f"""
totals AS (
  SELECT s.* REPLACE (make_date(s.year, 1, 1) AS year), s.year AS y, p.country_name, p.region, p.sub_region,
         s.co2_emissions + s.ch4_emissions + s.n2o_emissions AS total
  FROM staged s JOIN places p ON p.alpha_3 = s.country
),
wide AS (
  SELECT *, total AS calculated_total_emissions, population > 0 AND gdp_per_capita IS NOT NULL AS peopled,
         {', '.join(f'{e} AS {n}' for n, e in _LABELS.items())}
  FROM totals
),
em AS (
  SELECT * REPLACE ({', '.join(f'CASE WHEN peopled THEN {c} END AS {c}' for c in _NEEDS_PEOPLE)}),
         CASE WHEN peopled THEN total / population END AS per_head,
         CASE WHEN peopled AND gdp_per_capita > 0 THEN total / (gdp_per_capita * population / 1000000.0::DOUBLE) END AS per_million
  FROM wide WHERE total > 0
)"""

BASE = f"WITH {COMBINED},{STAGING},{FRAMES}"


def with_base(body: str, extra_ctes: str = "") -> str:
    return f"{BASE}{',' + extra_ctes if extra_ctes else ''}\n{body}"


def pick(frame: str, columns: str, rest: str = "", **computed: str) -> str:
    """Select ``columns`` (names) and ``computed`` (name: expression) of a frame."""
    items = columns.split() + [f"{e} AS {n}" for n, e in computed.items()]
    return f"SELECT {', '.join(items)}\nFROM {frame}\n{rest}"


_GASES = "co2_emissions ch4_emissions n2o_emissions"
_TOTAL = "calculated_total_emissions"


def _gas_shares(total: str = "total") -> dict[str, str]:
    return {f"{g}_percentage": R(per(f"{g}_emissions", total, "100")) for g in ("co2", "ch4", "n2o")}


COMBINED_SQL = with_base("SELECT * FROM combined")
STG_COMBINED_SQL = with_base("SELECT * FROM staged")
STG_COUNTRIES_SQL = with_base("SELECT * FROM places")
STG_SOVEREIGN_SQL = with_base("SELECT * FROM staged WHERE country IN (SELECT alpha_3 FROM places)")
DIM_EMISSIONS = pick(
    "wide",
    f"country year {_GASES} {_G100} {_G20} {_TOTAL} emission_intensity_category ghg_composition climate_impact_category",
    "WHERE total > 0",
    **{f"{g}_percentage": f"{g}_emissions / total * 100" for g in ("co2", "ch4", "n2o")},
)
DIM_EMISSIONS_SQL = with_base(DIM_EMISSIONS)
DIM_SOCIO_SQL = with_base(
    pick(
        "wide",
        "country year population gdp_per_capita gini_index poverty_gap_2_15_usd unemployment_rate school_enrollment"
        " life_expectancy income_category inequality_category poverty_intensity employment_status",
        "WHERE peopled",
    )
)
DIM_WELLBEING_SQL = with_base(
    pick("wide", "country year school_enrollment life_expectancy education_access_category life_expectancy_group")
)

_SUMS = {"total_emissions": XSUM("total"), "total_population": XSUM("population")} | {g: XSUM(g) for g in _GASES.split()}

FCT_REGION_SQL = with_base(
    pick(
        "em",
        "region year",
        "WHERE region <> '' GROUP BY region, year",
        country_count="COUNT(DISTINCT country)",
        **_SUMS,
        avg_gdp_per_capita=R("AVG(gdp_per_capita)"),
        emissions_per_capita=R(per(XSUM("total"), XSUM("population"))),
        **{
            f"{label.split()[0].lower().replace('-', '_')}_income_count": f"COUNT(*) FILTER (WHERE income_category = {q(label)})"
            for label in ("High income", "Upper-middle income", "Lower-middle income", "Low income")
        },
    )
)

# By composition first: the sums add up, and the most frequent label is the largest (rows, label).
FCT_SUBREGION_SQL = with_base(
    pick(
        "by_composition",
        "region sub_region year",
        "GROUP BY region, sub_region, year ORDER BY year DESC, total_emissions DESC",
        country_count="CAST(SUM(n) AS BIGINT)",
        total_emissions="CAST(SUM(t) AS DOUBLE)",
        co2_emissions="CAST(SUM(a) AS DOUBLE)",
        ch4_emissions="CAST(SUM(b) AS DOUBLE)",
        n2o_emissions="CAST(SUM(c) AS DOUBLE)",
        total_population="CAST(SUM(heads) AS DOUBLE)",
        avg_gdp_per_capita=R("SUM(gdp_sum) / NULLIF(SUM(gdp_n), 0)"),
        **{f"{g}_percentage": R(per(f"CAST(SUM({v}) AS DOUBLE)", "CAST(SUM(t) AS DOUBLE)", "100")) for g, v in (("co2", "a"), ("ch4", "b"), ("n2o", "c"))},
        emissions_per_capita=R(per("CAST(SUM(t) AS DOUBLE)", "CAST(SUM(heads) AS DOUBLE)")),
        avg_emissions_per_gdp=R("SUM(gdp_rate) / NULLIF(SUM(gdp_rate_n), 0)", 8),
        dominant_ghg_composition="arg_max(ghg_composition, (n, ghg_composition))",
    ),
    f"""
by_composition AS (
  SELECT region, sub_region, year, ghg_composition, COUNT(DISTINCT country) AS n, SUM({DEC('total')}) AS t,
         SUM({DEC('co2_emissions')}) AS a, SUM({DEC('ch4_emissions')}) AS b, SUM({DEC('n2o_emissions')}) AS c,
         SUM({DEC('population')}) AS heads, SUM(gdp_per_capita) AS gdp_sum, COUNT(gdp_per_capita) AS gdp_n,
         SUM(per_million) / 1000000.0::DOUBLE AS gdp_rate, COUNT(per_million) AS gdp_rate_n
  FROM em WHERE sub_region <> '' GROUP BY ALL
)""",
)

_PEOPLED = "WHERE peopled"
BY_DEVELOPMENT_SQL = with_base(
    pick(
        "income_years",
        f"year income_category country_count {_GASES} avg_emissions_per_capita avg_emissions_per_million_gdp avg_gdp_per_capita",
        "WINDOW yr AS (PARTITION BY year)",
        total_emissions="CAST(t AS DOUBLE)",
        total_population="CAST(heads AS DOUBLE)",
        percentage_of_global_emissions=R("CAST(t AS DOUBLE) / CAST(SUM(t) OVER yr AS DOUBLE) * 100"),
        percentage_of_global_population=R("CAST(heads AS DOUBLE) / CAST(SUM(heads) OVER yr AS DOUBLE) * 100"),
        emissions_to_population_ratio=R(
            "(CAST(t AS DOUBLE) / CAST(SUM(t) OVER yr AS DOUBLE)) / (CAST(heads AS DOUBLE) / CAST(SUM(heads) OVER yr AS DOUBLE))"
        ),
    ),
    "\nincome_years AS ("
    + pick(
        "em",
        "year income_category",
        f"{_PEOPLED} GROUP BY year, income_category",
        country_count="COUNT(DISTINCT country)",
        t=f"SUM({DEC('total')})",
        heads=f"SUM({DEC('population')})",
        **{g: XSUM(g) for g in _GASES.split()},
        avg_emissions_per_capita=R("AVG(per_head)"),
        avg_emissions_per_million_gdp=R("AVG(per_million)"),
        avg_gdp_per_capita=R("AVG(gdp_per_capita)"),
    )
    + ")",
)

_LAG = "lag({}) OVER story"
_STORY = "WINDOW story AS (PARTITION BY country ORDER BY y)"
TIME_SERIES_SQL = with_base(
    pick(
        "told",
        "*",
        "",
        long_term_trend=ladder(
            [
                ("emissions_cagr < -2", "Rapid decrease"),
                ("emissions_cagr <= -0.5", "Moderate decrease"),
                ("emissions_cagr <= 0.5", "Stable"),
                ("emissions_cagr <= 2", "Moderate increase"),
                ("emissions_cagr > 2", "Rapid increase"),
            ],
            "Insufficient data",
        ),
    ),
    "\ntold AS ("
    + pick(
        "em",
        f"country country_name year region sub_region {_TOTAL} {_GASES} ghg_composition population gdp_per_capita income_category",
        _STORY,
        **_gas_shares(),
        emissions_per_capita=R("per_head"),
        absolute_emissions_change=f"total - {_LAG.format('total')}",
        yoy_emissions_change_pct=growth("total", _LAG.format("total")),
        co2_percentage_point_change=f"{_gas_shares()['co2_percentage']} - "
        + R(per(_LAG.format("co2_emissions"), _LAG.format("total"), "100")),
        baseline_year="first_value(y) OVER story",
        baseline_emissions="first_value(total) OVER story",
        baseline_emissions_per_capita="first_value(per_head) OVER story",
        pct_change_from_baseline=growth("total", "first_value(total) OVER story"),
        emissions_cagr="CASE WHEN y > first_value(y) OVER story THEN "
        + R("(pow(total / first_value(total) OVER story, 1.0::DOUBLE / (y - first_value(y) OVER story)) - 1) * 100")
        + " END",
    )
    + ")",
)


def _coupling(gdp: str, gas: str, shrinking: bool) -> str:
    """Label from the signs of two growth rates."""
    steps = [
        (f"{gdp} > 0 AND {gas} < 0", "Absolute decoupling"),
        (f"{gas} > 0 AND {gdp} > {gas}", "Relative decoupling"),
        (f"{gdp} > 0 AND {gas} >= {gdp}", "No decoupling"),
    ]
    if shrinking:
        steps += [
            (f"{gdp} < 0 AND {gas} < {gdp}", "Recession with larger emissions reduction"),
            (f"{gdp} < 0 AND {gas} < 0", "Recession with smaller emissions reduction"),
        ]
    return ladder(steps, "Other")


def _years_ago(expr: str, n: int) -> str:
    return f"any_value({expr}) OVER (PARTITION BY country ORDER BY y RANGE BETWEEN {n} PRECEDING AND {n} PRECEDING)"


_BY_REGION = {
    f"mean_{n}": f"CASE WHEN region IS NOT NULL THEN AVG({c}) OVER (PARTITION BY year, region) END"
    for n, c in (("gdp", "gdp_per_capita"), ("head", "per_head"), ("million", "per_million"))
}
GDP_CORRELATION_SQL = with_base(
    pick(
        "rates",
        f"country country_name year region sub_region gdp_per_capita population total_gdp {_TOTAL}"
        " gdp_growth_pct emissions_growth_pct gdp_growth_5yr_pct emissions_growth_5yr_pct",
        "",
        emissions_per_capita=R("per_head"),
        emissions_per_million_gdp=R("per_million"),
        avg_regional_gdp_per_capita=R("mean_gdp"),
        avg_regional_emissions_per_capita=R("mean_head"),
        avg_regional_carbon_intensity=R("mean_million"),
        gdp_vs_regional_avg_pct=R("(gdp_per_capita / NULLIF(mean_gdp, 0) - 1) * 100"),
        emissions_vs_regional_avg_pct=R("(per_head / NULLIF(mean_head, 0) - 1) * 100"),
        decoupling_status=_coupling("gdp_growth_pct", "emissions_growth_pct", True),
        decoupling_status_5yr=_coupling("gdp_growth_5yr_pct", "emissions_growth_5yr_pct", False),
    ),
    "\nrates AS ("
    + pick(
        "em",
        "*",
        f"{_PEOPLED} AND gdp_per_capita > 0",
        total_gdp="gdp_per_capita * population",
        **{
            f"{name}_growth{tag}_pct": growth(expr, _years_ago(expr, n))
            for n, tag in ((1, ""), (5, "_5yr"))
            for name, expr in (("gdp", "gdp_per_capita * population"), ("emissions", "total"))
        },
        **_BY_REGION,
    )
    + ")",
)

_CHANGES = {
    f"yoy_{n}_change_pct": growth(c, _LAG.format(c))
    for n, c in (("emissions", "total"), ("population", "population"), ("gdp_per_capita", "gdp_per_capita"))
}
_PER_MILLION_ANY = R("total / NULLIF(gdp_per_capita * population / 1000000.0::DOUBLE, 0)")


def country_profile_sql(entities: tuple | None = None) -> str:
    where = f"WHERE country IN ({', '.join(map(str, entities))})" if entities else ""
    e, g = "yoy_emissions_change_pct", "yoy_gdp_per_capita_change_pct"
    return with_base(
        pick(
            "yearly",
            "*",
            where,
            economic_emissions_relationship=ladder(
                [
                    (f"{g} > 0 AND {e} < 0", "Decoupling"),
                    (f"{e} > 0 AND {e} < {g}", "Relative decoupling"),
                    (f"{g} > 0 AND {e} >= {g}", "No decoupling"),
                ],
                "Other",
            ),
        ),
        "\nyearly AS ("
        + pick(
            "em",
            f"country year population gdp_per_capita gini_index life_expectancy school_enrollment {_TOTAL} {_GASES}"
            " ghg_composition emission_intensity_category climate_impact_category",
            _STORY,
            emissions_per_capita=R("per_head"),
            emissions_per_million_gdp=_PER_MILLION_ANY,
            **_gas_shares(),
            **_CHANGES,
        )
        + ")",
    )


COUNTRY_PROFILE_SQL = country_profile_sql()


def region_countries_sql(region: str) -> str:
    return with_base(
        pick(
            "em",
            f"country country_name year sub_region population gdp_per_capita {_TOTAL} {_GASES} ghg_composition"
            " emission_intensity_category climate_impact_category income_category inequality_category"
            " education_access_category life_expectancy_group",
            f"WHERE region = {q(region)} {_STORY} ORDER BY year DESC, total DESC",
            emissions_per_capita=R("per_head"),
            emissions_per_million_gdp=_PER_MILLION_ANY,
            yoy_emissions_change_pct=_CHANGES["yoy_emissions_change_pct"],
        )
    )


def top_emitters_sql(top_n: int = 50) -> str:
    place = "CAST(row_number() OVER (PARTITION BY year ORDER BY {} DESC NULLS LAST, country) AS INTEGER)"
    share = lambda c: R(f"{c} / CAST(SUM({DEC(c)}) OVER (PARTITION BY year) AS DOUBLE) * 100")
    return with_base(
        pick(
            "placed",
            "*",
            f"WHERE least(emissions_rank, per_capita_rank) <= {top_n} ORDER BY year DESC, {_TOTAL} DESC",
            emissions_to_population_ratio=R(per("pct_of_global_emissions", "pct_of_global_population")),
        ),
        "\nplaced AS ("
        + pick(
            "em",
            f"country country_name year region sub_region {_TOTAL} {_GASES} population gdp_per_capita income_category ghg_composition",
            _PEOPLED,
            **_gas_shares(),
            emissions_per_capita=R("per_head"),
            emissions_per_million_gdp=R("per_million"),
            pct_of_global_emissions=share("total"),
            pct_of_global_population=share("population"),
            emissions_rank=place.format("total"),
            per_capita_rank=place.format("per_head"),
            carbon_intensity_rank=place.format("per_million"),
        )
        + ")",
    )


SOURCE_CHECK_SQL = with_base("SELECT COUNT(*) AS total_rows, COUNT(DISTINCT country) AS distinct_countries FROM combined")

JOIN_CHECK_SQL = with_base(
    """
SELECT CASE WHEN known THEN 'Found match' ELSE 'No match' END AS match_status, COUNT(*) AS country_count,
       list_sort(list(country))[1:10] AS sample_countries
FROM (SELECT DISTINCT country, country IS NOT NULL AND country IN (SELECT alpha_3 FROM places) AS known FROM combined) met
GROUP BY known"""
)


def top_k_sql(metric: str, k: int = 10) -> str:
    return with_base(f"FROM ({DIM_EMISSIONS}) ORDER BY {metric} DESC NULLS LAST, country, year LIMIT {k}")


def top_k_per_head_sql(k: int = 10) -> str:
    return with_base(
        pick("em", f"country year {_TOTAL} population", f"{_PEOPLED} ORDER BY per_head DESC NULLS LAST, country, year LIMIT {k}", emissions_per_capita="per_head")
    )


# ---------------------------------------------------------- operator queries
_EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def _pivot_cols(order: str) -> str:
    return ",\n  ".join(
        f"arg_max(value, {order}) FILTER (WHERE event_type = {q(t)}) AS {t}" for t in _EVENT_TYPES
    )


PIVOT_INDICATORS_SQL = f"""
SELECT user_id, CAST(ts AS DATE) AS day,
  {_pivot_cols('(ts, event_id)')}
FROM events
WHERE value IS NOT NULL AND event_type IS NOT NULL AND user_id IS NOT NULL
GROUP BY 1, 2"""

JSON_INDICATOR_SQL = f"""
SELECT CAST(user_id AS VARCHAR) AS country, CAST(ts AS DATE) AS day,
  {_pivot_cols('(ts, event_id)')}
FROM events
WHERE value IS NOT NULL AND event_type IS NOT NULL AND user_id IS NOT NULL
GROUP BY 1, 2"""

FLATTEN_PROPS_SQL = """
SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k
FROM events
WHERE event_id IS NOT NULL AND props IS NOT NULL AND len(json_keys(props)) > 0"""

CSV_YEARLY_SQL = with_base(
    """
SELECT CAST(country AS VARCHAR) AS country, year, sp_pop_totl, ny_gdp_pcap_cd,
  CASE WHEN year = 2001 THEN NULL ELSE sp_dyn_le00_in END AS sp_dyn_le00_in,
  se_sec_enrr, sl_uem_totl_zs, si_pov_gaps, si_pov_gini
FROM combined"""
)

_NATION_SIDES = """
wb AS (
  SELECT c_nationkey AS country, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS revenue, COUNT(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
),
ct AS (
  SELECT s_nationkey AS country, CAST(year(l_shipdate) AS INTEGER) AS year,
         CAST(SUM(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS revenue, COUNT(*) AS n
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2
)"""

FULL_OUTER_MERGE_SQL = """
SELECT COALESCE(wb.country, ct.country) AS country, COALESCE(wb.year, ct.year) AS year,
       wb.revenue AS revenue_wb, wb.n AS n_wb, ct.revenue AS revenue_ct, ct.n AS n_ct
FROM (SELECT o_custkey AS country, CAST(year(o_orderdate) AS INTEGER) AS year,
             CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS revenue, COUNT(*) AS n
      FROM orders GROUP BY 1, 2) wb
FULL OUTER JOIN (SELECT l_suppkey AS country, CAST(year(l_shipdate) AS INTEGER) AS year,
             CAST(SUM(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS revenue, COUNT(*) AS n
      FROM lineitem GROUP BY 1, 2) ct ON wb.country = ct.country AND wb.year = ct.year"""

SINGLE_YEAR_JOIN_SQL = f"""WITH {_NATION_SIDES}
SELECT wb.country, wb.year AS year_1, wb.revenue AS revenue_1, wb.n AS n_1,
       ct.year AS year_2, ct.revenue AS revenue_2, ct.n AS n_2
FROM wb JOIN ct ON wb.country = ct.country AND wb.year = ct.year"""

SUPPLIER_TOTALS_SQL = f"""WITH {_NATION_SIDES}
SELECT country, CASE WHEN isfinite(revenue) THEN revenue END AS revenue, CASE WHEN NOT isfinite(revenue) THEN revenue::VARCHAR END AS special
FROM (
  SELECT country, {XSUM('revenue')} AS revenue FROM ct GROUP BY country
  UNION ALL SELECT -1, CAST(SUM(CAST(v AS DECIMAL(38,9))) AS DOUBLE)
  FROM (SELECT 9900000000000 + CAST(l_quantity AS DECIMAL(38,9)) AS v FROM lineitem
        UNION ALL SELECT 9900000000000.25 FROM lineitem)
  UNION ALL SELECT -2, SUM(CASE l_returnflag WHEN 'A' THEN 'NaN'::DOUBLE ELSE l_extendedprice END) FROM lineitem
  UNION ALL SELECT -3, SUM(CASE l_returnflag WHEN 'A' THEN 'Infinity'::DOUBLE ELSE l_extendedprice END) FROM lineitem
  UNION ALL SELECT -4, SUM(CASE l_returnflag WHEN 'A' THEN '-Infinity'::DOUBLE ELSE l_extendedprice END) FROM lineitem
  UNION ALL SELECT -5, AVG(CASE l_returnflag WHEN 'A' THEN 'NaN'::DOUBLE ELSE l_extendedprice END) FROM lineitem
)"""

SUM_BY_SUPPLIER_YEAR_SQL = "SELECT l_suppkey AS supplier, CAST(year(l_shipdate) AS INTEGER) AS year,\n" + ",\n".join(
    f"  COALESCE({XSUM(f'CASE WHEN l_returnflag = {q(f)} THEN l_extendedprice END')}, 0.0) AS flag_{f}"
    for f in ("A", "N", "R")
) + "\nFROM lineitem WHERE l_suppkey IS NOT NULL AND l_shipdate IS NOT NULL GROUP BY 1, 2"

ENTITY_TOTALS_SQL = with_base(
    f"""
SELECT country, {XSUM('calculated_total_emissions')} AS total_emissions,
       {XSUM('co2_percentage')} / COUNT(co2_percentage) AS avg_co2_percentage
FROM ({DIM_EMISSIONS}) GROUP BY country"""
)

INCOME_MODE_SQL = with_base(
    """
SELECT region, year, arg_max(income_category, (n, income_category)) AS mode_income_category
FROM (SELECT region, year, income_category, COUNT(*) AS n FROM wide WHERE peopled GROUP BY ALL)
GROUP BY region, year"""
)

DISTINCT_COUNTRIES_SQL = with_base("SELECT DISTINCT country FROM combined")

SOVEREIGN_NAMES_SQL = f"""
SELECT {_CODE} AS code, c_name || {_SUFFIX} AS name FROM customer
WHERE NOT regexp_matches(c_name || {_SUFFIX}, 'Territory|Island|Dependenc(y|ies)')"""

_CHECK_COLS = ("population", "gdp_per_capita", "life_expectancy", "school_enrollment", "gini_index")
NULL_COUNTS_SQL = with_base(
    "\nUNION ALL\n".join(
        f"SELECT {q(c)} AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM staged"
        for c in _CHECK_COLS
    )
)
UNIQUE_PANEL_KEY_SQL = """
SELECT * FROM (
  SELECT o_custkey AS country, CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS n_rows FROM orders GROUP BY ALL
) WHERE n_rows > 1"""
UNIQUE_DIM_KEY_SQL = with_base(
    "SELECT * FROM (SELECT country_code, COUNT(*) AS n_rows FROM places GROUP BY ALL) WHERE n_rows > 1"
)
DIM_ROW_COUNT_SQL = with_base(
    "SELECT * FROM (SELECT COUNT(*) AS row_count FROM places) t WHERE NOT (row_count BETWEEN 180 AND 250)"
)
NOT_NULL_STAGED_SQL = with_base(
    "SELECT country, year, life_expectancy FROM staged WHERE life_expectancy IS NULL"
)
YEAR_OVERWRITE_SQL = with_base(
    """
SELECT country, year, sp_pop_totl, ny_gdp_pcap_cd, sp_dyn_le00_in, se_sec_enrr, sl_uem_totl_zs, si_pov_gaps,
       si_pov_gini, CASE WHEN year = 1998 THEN co2 * 2 ELSE co2 END AS co2, ch4, n2o, co2e_100yr, co2e_20yr
FROM combined"""
)
EXTERNAL_TABLE_SQL = with_base(
    f"FROM ({DIM_EMISSIONS})"
)
ENTITY_SHARE_SQL = with_base(
    """
SELECT country, year, co2_emissions / NULLIF(population, 0) * 100 AS co2_per_unit_pct,
       population * gdp_per_capita AS total_gdp
FROM staged"""
)

PARQUET_YEARS_SQL = with_base("SELECT * FROM combined WHERE year IN (1996, 1997)")
REGISTERED_VIEW_SQL = with_base(
    """
SELECT year, COUNT(*) AS n_rows, COUNT(DISTINCT country) AS n_countries,
       CAST(SUM(CAST(co2_emissions AS DECIMAL(38,2))) AS DOUBLE) AS co2_emissions
FROM staged WHERE population > 0 GROUP BY year"""
)

_ORDER_GASES = """
order_lines AS (
  SELECT l_orderkey,
         SUM(CASE WHEN l_returnflag = 'N' THEN CAST(round(l_extendedprice * 100) AS BIGINT) ELSE 0 END) AS co2_cents,
         SUM(CASE WHEN l_returnflag = 'A' THEN CAST(round(l_extendedprice * 100) AS BIGINT) ELSE 0 END) AS ch4_cents,
         SUM(CASE WHEN l_returnflag = 'R' THEN CAST(round(l_extendedprice * 100) AS BIGINT) ELSE 0 END) AS n2o_cents
  FROM lineitem GROUP BY l_orderkey
),
order_gas AS (
  SELECT o_custkey AS country, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(co2_cents AS DOUBLE) / 100 AS co2, CAST(ch4_cents AS DOUBLE) / 100 AS ch4,
         CAST(n2o_cents AS DOUBLE) / 100 AS n2o
  FROM orders LEFT JOIN order_lines ON l_orderkey = o_orderkey
),
order_gases AS (
  SELECT *, co2 * CAST(1 AS DOUBLE) + ch4 * CAST(28 AS DOUBLE) + n2o * CAST(300 AS DOUBLE) AS co2e_100yr,
            co2 * CAST(1 AS DOUBLE) + ch4 * CAST(84 AS DOUBLE) + n2o * CAST(264 AS DOUBLE) AS co2e_20yr
  FROM order_gas
)"""

_CT_SELECT = ",\n  ".join(f"COALESCE({XSUM(c)}, 0.0) AS {c}" for c in ("co2", "ch4", "n2o", "co2e_100yr", "co2e_20yr"))

PROCESS_EMISSIONS_SQL = f"""WITH {_ORDER_GASES}
SELECT CAST(country AS VARCHAR) AS country, year,
  {_CT_SELECT}
FROM order_gases GROUP BY 1, 2"""

PROCESS_INDICATORS_SQL = CSV_YEARLY_SQL

FILE_PIPELINE_SQL = f"""{BASE},
{_ORDER_GASES.strip()},
ct AS (
  SELECT CAST(country AS VARCHAR) AS country, year,
  {_CT_SELECT}
  FROM order_gases GROUP BY 1, 2
),
wb AS (
  SELECT CAST(country AS VARCHAR) AS country, year, sp_pop_totl, ny_gdp_pcap_cd,
    CASE WHEN year = 2001 THEN NULL ELSE sp_dyn_le00_in END AS sp_dyn_le00_in,
    se_sec_enrr, sl_uem_totl_zs, si_pov_gaps, si_pov_gini
  FROM combined
)
SELECT COALESCE(wb.country, ct.country) AS country, COALESCE(wb.year, ct.year) AS year,
  wb.sp_pop_totl, wb.ny_gdp_pcap_cd, wb.sp_dyn_le00_in, wb.se_sec_enrr, wb.sl_uem_totl_zs, wb.si_pov_gaps,
  wb.si_pov_gini, ct.co2, ct.ch4, ct.n2o, ct.co2e_100yr, ct.co2e_20yr
FROM wb FULL OUTER JOIN ct ON wb.country = ct.country AND wb.year = ct.year"""


REWRITTEN_SQL = DIM_WELLBEING_SQL + "WHERE y <> 1998"
LATE_COLUMN_SQL = with_base(
    "SELECT country, year, co2, CASE WHEN year >= 1998 THEN si_pov_gini END AS si_pov_gini FROM combined"
)


def declared_checks_sql(not_null: dict, unique: dict) -> str:
    frames = {
        "stg_countries": STG_COUNTRIES_SQL, "dim_emissions": DIM_EMISSIONS_SQL, "dim_socio": DIM_SOCIO_SQL,
        "dim_wellbeing": DIM_WELLBEING_SQL, "fct_region": FCT_REGION_SQL, "by_development": BY_DEVELOPMENT_SQL,
        "stg_combined": STG_COMBINED_SQL, "stg_sovereign": STG_SOVEREIGN_SQL, "gdp_correlation": GDP_CORRELATION_SQL,
        "country_profile": COUNTRY_PROFILE_SQL, "time_series": TIME_SERIES_SQL,
    }
    parts = [
        f"SELECT {q(m)} AS model, {q('not_null_' + c)} AS check_name, COUNT(*) - COUNT({c}) AS failures FROM ({frames[m]})"
        for m, cols in not_null.items()
        for c in cols
    ]
    parts += [
        f"SELECT {q(m)}, {q('unique_' + '_'.join(k))}, COUNT(*) FROM (SELECT COUNT(*) AS n FROM ({frames[m]}) GROUP BY {', '.join(k)}) WHERE n > 1"
        for m, keys in unique.items()
        for k in keys
    ]
    return "\nUNION ALL\n".join(parts)


ORDERED_SQL = f"""
SELECT *, row_number() OVER (
  ORDER BY year DESC, total_emissions DESC NULLS LAST, region NULLS FIRST, sub_region NULLS FIRST) AS ordinal
FROM ({FCT_SUBREGION_SQL})"""
RELOADED_SQL = f"SELECT * REPLACE (CASE WHEN year = 1998 THEN co2 * 2 ELSE co2 END AS co2) FROM ({FILE_PIPELINE_SQL})"

_SIDE = """SELECT {} AS country, CAST(year({}) AS INTEGER) AS year,
             CAST(SUM(CAST(round({} * 100) AS BIGINT)) AS DOUBLE) / 100 AS revenue, COUNT(*) AS n FROM {} GROUP BY 1, 2"""
_LEFT = _SIDE.format("o_custkey", "o_orderdate", "o_totalprice", "orders")
_RIGHT = _SIDE.format("l_suppkey", "l_shipdate", "l_extendedprice", "lineitem")
FALLBACKS_SQL = f"""
SELECT 'both' AS case, * FROM ({FULL_OUTER_MERGE_SQL})
UNION ALL BY NAME SELECT c AS case, l.* FROM ({_LEFT}) l, (VALUES ('right absent'), ('right empty')) v(c)
UNION ALL BY NAME SELECT c AS case, r.* FROM ({_RIGHT}) r, (VALUES ('left absent'), ('left empty')) v(c)"""

CATALOG_YEARS_SQL = """
WITH o AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders),
     s AS (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS y FROM lineitem)
SELECT COALESCE(o.y, s.y) AS year, o.y IS NOT NULL AS in_indicators, s.y IS NOT NULL AS in_emissions
FROM o FULL JOIN s ON o.y = s.y"""
YEAR_TABLES_SQL = with_base("SELECT country, year, co2, co2 AS co2_of_year FROM combined")

SEED_SQL = f"""
SELECT CAST({_CODE} AS VARCHAR) AS alpha_3, c_name || {_SUFFIX} AS name, left(c_mktsegment, 2) AS alpha_2,
       CAST(c_nationkey AS VARCHAR) AS country_code, NULLIF({_gap('r_name', 1)}, '') AS region,
       NULLIF({_gap('n_name', 2)}, '') AS sub_region
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey"""
SEED_NUMBERS_SQL = f"""
SELECT CAST(alpha_3 AS DOUBLE) AS alpha_3, CAST(country_code AS DOUBLE) AS country_code, TRY_CAST(region AS DOUBLE) AS region,
       name, alpha_2, sub_region FROM ({SEED_SQL})"""
EMISSION_YEARS_SQL = f"SELECT country, CAST(year(year) AS INTEGER) AS year, calculated_total_emissions FROM ({DIM_EMISSIONS_SQL})"
OVERWRITTEN_SQL = with_base("SELECT country, year, co2 * 2 AS co2 FROM combined")


def column_names_sql(headers: tuple) -> str:
    rows = ", ".join(f"({q(h)}, 'string', {'.' in h})" for h in ("country", *(h for _, h in headers)))
    return f"SELECT * FROM (VALUES {rows}) v(column_name, data_type, has_dot)"
