"""Models on a small hand-made panel with the edge rows of the fixtures."""

import pytest

from panelyze.operators import quality as Q
from panelyze.plans import models as M
from panelyze.sinks import writers as W
from panelyze.session import scratch_path
from tests.conftest import rows

COMBINED_SCHEMA = (
    "country string, year int, sp_pop_totl double, ny_gdp_pcap_cd double, sp_dyn_le00_in double, "
    "se_sec_enrr double, sl_uem_totl_zs double, si_pov_gini double, si_pov_gaps double, co2 double, ch4 double, "
    "n2o double, co2e_100yr double, co2e_20yr double"
)


def panel_row(country, year, pop, gdp, co2, ch4=1.0, n2o=1.0, c100=None, c20=None, gini=30.0):
    c100 = co2 + 28 * ch4 if c100 is None else c100
    c20 = co2 + 84 * ch4 if c20 is None else c20
    return (country, year, pop, gdp, 70.0, 95.0, 4.0, gini, 2.0, co2, ch4, n2o, c100, c20)


@pytest.fixture(scope="module")
def frames(spark):
    data = [
        # NLD: 2015..2020 growing economy, falling emissions
        *[panel_row("NLD", y, 100.0 + y - 2015, 1000.0 * (1 + (y - 2015) / 10), 100.0 - (y - 2015) * 5)
          for y in range(2015, 2021)],
        # MAF: gap at 2020
        panel_row("MAF", 2019, 10.0, 500.0, 20.0),
        panel_row("MAF", 2021, 10.0, 600.0, 30.0),
        # ONE: a single year
        panel_row("ONE", 2020, 5.0, 20000.0, 10.0),
        # BVT: all-zero gases (dropped by total > 0)
        panel_row("BVT", 2020, 1.0, 100.0, 0.0, 0.0, 0.0),
        # ZPO: zero population (kept in emissions dim, not in socio dim)
        panel_row("ZPO", 2020, 0.0, 100.0, 5.0),
        # AFE: aggregate entity not in the seed
        panel_row("AFE", 2020, 1000.0, 100.0, 500.0),
        # no GDP: dropped by staging
        panel_row("NLD", 2021, 1.0, None, 1.0),
    ]
    combined = spark.createDataFrame(data, COMBINED_SCHEMA)
    seed = spark.createDataFrame(
        [
            ("Netherlands", "NL", "NLD", "528", "Europe", "Western Europe"),
            ("Saint Martin", "MF", "MAF", "663", "Americas", "Latin America and the Caribbean"),
            ("Oneland", "ON", "ONE", "001", None, None),
            ("Bouvet Island", "BV", "BVT", "074", "Americas", "Latin America and the Caribbean"),
            ("Zeropop", "ZP", "ZPO", "002", "Europe", "Western Europe"),
        ],
        "name string, `alpha-2` string, `alpha-3` string, `country-code` string, region string, `sub-region` string",
    )
    staged = M.stg_combined(combined)
    countries = M.stg_countries(seed)
    return combined, staged, countries, M.sovereign_panel(staged, countries)


def test_staging_and_dims(frames):
    combined, staged, countries, panel = frames
    assert staged.count() == combined.count() - 1
    assert "BVT" not in {r["alpha_3"] for r in rows(countries)}  # Island
    sov = {r["country"] for r in rows(M.stg_sovereign(staged, countries))}
    assert sov == {"NLD", "MAF", "ONE", "ZPO"}
    emis = {r["country"] for r in rows(M.dim_emissions(panel))}
    socio = {r["country"] for r in rows(M.dim_socio(panel))}
    assert "ZPO" in emis and "ZPO" not in socio
    assert Q.unique_violations(staged, ["country", "year"]).count() == 0


def test_time_series_gap_and_baseline(frames):
    ts = {(r["country"], r["year"].year): r for r in rows(M.time_series(frames[3]))}
    maf = ts[("MAF", 2021)]
    assert maf["yoy_emissions_change_pct"] == round((32 - 22) / 22 * 100, 2)  # previous available row
    assert maf["baseline_year"] == 2019 and maf["emissions_cagr"] == round(((32 / 22) ** 0.5 - 1) * 100, 2)
    assert ts[("ONE", 2020)]["long_term_trend"] == "Insufficient data"
    assert ts[("NLD", 2020)]["long_term_trend"] == "Rapid decrease"
    assert ts[("ZPO", 2020)]["population"] is None  # socio side missing -> NULL (left join)


def test_gdp_correlation_exact_lags(frames):
    g = {(r["country"], r["year"].year): r for r in rows(M.gdp_correlation(frames[3]))}
    assert g[("MAF", 2021)]["gdp_growth_pct"] is None  # no row exactly one year before
    assert g[("NLD", 2020)]["gdp_growth_5yr_pct"] is not None
    assert g[("NLD", 2019)]["gdp_growth_5yr_pct"] is None
    assert g[("NLD", 2016)]["decoupling_status"] == "Absolute decoupling"
    assert g[("ONE", 2020)]["avg_regional_gdp_per_capita"] is None  # NULL region
    assert ("ZPO", 2020) not in g


def test_facts(frames):
    panel = frames[3]
    fr = {(r["region"], r["year"].year): r for r in rows(M.fct_region(panel))}
    assert ("Europe", 2020) in fr and all(k[0] is not None for k in fr)
    eu = fr[("Europe", 2020)]
    # ZPO has no socioeconomic row (population 0), so only NLD's population counts
    assert eu["country_count"] == 2 and eu["total_population"] == 105.0
    dev = rows(M.by_development(panel))
    by_year = {}
    for r in dev:
        by_year.setdefault(r["year"], 0.0)
        by_year[r["year"]] += r["percentage_of_global_emissions"]
    assert all(abs(v - 100.0) < 0.05 for v in by_year.values())
    sub = rows(M.fct_subregion(panel))
    assert all(r["dominant_ghg_composition"] in ("CO₂-Dominant", "Methane-Dominant", "Mixed Emissions") for r in sub)


def test_profile_and_region_and_top(frames):
    panel = frames[3]
    prof = rows(M.country_profile(panel, "NLD"), ["year"])
    assert "country" not in prof[0] and len(prof) == 6
    assert prof[1]["economic_emissions_relationship"] == "Decoupling"
    eu = rows(M.region_countries(panel, "Europe"))
    assert {r["country"] for r in eu} == {"NLD", "ZPO"}
    top = rows(M.top_emitters(panel, M.ModelParams(top_n=1)))
    per_year = {}
    for r in top:
        per_year.setdefault(r["year"], []).append(r)
    assert all(any(r["emissions_rank"] == 1 or r["per_capita_rank"] == 1 for r in v) for v in per_year.values())


def test_checks(frames):
    combined, staged, countries, panel = frames
    assert rows(M.source_check(combined)) == [{"total_rows": 13, "distinct_countries": 6}]
    jc = {r["match_status"]: r for r in rows(M.join_check(combined, countries))}
    assert jc["No match"]["sample_countries"] == ["AFE", "BVT"]
    assert jc["Found match"]["country_count"] == 4
    assert Q.row_count_outside(countries, 180, 250).count() == 1
    nc = {r["column_name"]: r["null_count"] for r in rows(Q.null_counts(staged, ["gdp_per_capita", "population"]))}
    assert nc == {"gdp_per_capita": 0, "population": 0}


def test_year_overwrite_keeps_other_years(spark, frames):
    combined = frames[0].where("country = 'NLD'")
    path = scratch_path(spark, "test_years")
    W.write_years(combined, path)
    W.write_years(combined.where("year = 2016").withColumn("co2", combined.co2 * 10), path)
    back = spark.read.parquet(path)
    assert back.select("year").distinct().count() == 7
    assert back.where("year = 2016").first()["co2"] == 950.0
    assert back.where("year = 2015").count() == 1


def test_country_count_paths_agree(frames):
    panel = frames[3]
    for model in (M.fct_region, M.by_development, M.fct_subregion):
        a = sorted(tuple(r) for r in model(panel).collect())
        b = sorted(tuple(r) for r in model(panel, M.ModelParams(key_unique=False)).collect())
        assert a == b, model.__name__
