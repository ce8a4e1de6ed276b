"""Synthetic yearly CSV files -> file pipeline -> every model."""

import pytest

from panelyze.plans import file_pipeline as FP
from panelyze.plans import models as M
from panelyze.session import scratch_path
from panelyze.sinks.versions import read_published
from panelyze.sources.files import read_seed
from tests.conftest import rows

WB_HEAD = "country,SP.POP.TOTL,NY.GDP.PCAP.CD,SP.DYN.LE00.IN,SE.SEC.ENRR,SL.UEM.TOTL.ZS,SI.POV.GAPS,SI.POV.GINI"
WB_HEAD_2023 = "country,SP.POP.TOTL,NY.GDP.PCAP.CD,SL.UEM.TOTL.ZS,SE.SEC.ENRR,SI.POV.GAPS,SI.POV.GINI"
CT_HEAD = "country,year,co2,ch4,n2o,co2e_100yr,co2e_20yr"


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    d = tmp_path_factory.mktemp("landed")
    wb, ct = [], []
    for y in (2021, 2022):
        p = d / f"world_bank_indicators_{y}.csv"
        p.write_text(
            WB_HEAD + "\n"
            f"ALD,{17000000 + y},{50000 + (y - 2021) * 1000}.5,81.5,120,3.5,0.1,28\n"
            f"BRM,{83000000 + y},{48000 + y},80.9,100,3.1,0.0,31\n"
            "AGG,700000000,1500,62,,,,\n"
        )
        wb.append(str(p))
    p = d / "world_bank_indicators_2023.csv"
    p.write_text(WB_HEAD_2023 + "\nALD,17900000,57000,3.6,120,0.2,25.7\nBRM,84000000,52000,3.0,99,0.0,31.7\n")
    wb.append(str(p))
    p = d / "world_bank_indicators_2024.csv"
    p.write_text("\n")
    wb.append(str(p))
    for y, ald, brm in ((2021, 150.0, 700.0), (2022, 140.0, 690.0), (2023, 130.0, 660.0)):
        p = d / f"global_emissions_{y}.csv"
        p.write_text(
            CT_HEAD + "\n"
            f"ALD,{y},{ald},10,1,{ald + 300},{ald + 900}\n"
            f"BRM,{y},{brm},40,4,{brm + 1500},{brm + 4000}\n"
            f"CVI,{y},0,0,0,0,0\n"
            f"XQX,{y},8,1,0.1,40,90\n"
        )
        ct.append(str(p))
    p = d / "global_emissions_2025.csv"
    p.write_text("\n")
    ct.append(str(p))
    seed = d / "countries.csv"
    seed.write_text(
        "name,alpha-2,alpha-3,country-code,iso_3166-2,region,sub-region,intermediate-region,region-code,"
        "sub-region-code,intermediate-region-code\n"
        "Aldmark,AL,ALD,901,X-1:AL,Northland,Inner Northland,,11,12,\n"
        "Bremland,BM,BRM,902,X-1:BM,Northland,Inner Northland,,11,12,\n"
        "Coven Island,CI,CVI,003,X-1:CI,Farland,Outer Farland,Capes,21,22,23\n"
    )
    return wb, ct, str(seed)


def test_pipeline_to_every_model(spark, landed):
    wb_paths, ct_paths, seed_path = landed
    combined = FP.run(spark, wb_paths, ct_paths, scratch_path(spark, "e2e"))
    got = {(r["country"], r["year"]) for r in rows(combined)}
    # full outer: AGG only in indicators, CVI/XQX only in emissions; 2024/2025 empty
    assert ("AGG", 2021) in got and ("XQX", 2023) in got and ("CVI", 2022) in got
    assert {y for _, y in got} == {2021, 2022, 2023}
    ald23 = [r for r in rows(combined) if (r["country"], r["year"]) == ("ALD", 2023)][0]
    assert ald23["sl_uem_totl_zs"] == 3.6 and ald23["se_sec_enrr"] == 120.0 and ald23["sp_dyn_le00_in"] is None

    staged = M.stg_combined(combined)
    countries = M.stg_countries(read_seed(spark, seed_path))
    panel = M.sovereign_panel(staged, countries)
    assert {r["country"] for r in rows(staged)} == {"ALD", "BRM"}  # both sources needed
    outputs = {
        "dim_emissions": M.dim_emissions(panel),
        "dim_socio": M.dim_socio(panel),
        "dim_wellbeing": M.dim_wellbeing(panel),
        "fct_region": M.fct_region(panel),
        "fct_subregion": M.fct_subregion(panel),
        "by_development": M.by_development(panel),
        "time_series": M.time_series(panel),
        "gdp_correlation": M.gdp_correlation(panel),
        "country_profile": M.country_profile(panel, "ALD"),
        "region_countries": M.region_countries(panel, "Northland"),
        "top_emitters": M.top_emitters(panel),
        "source_check": M.source_check(combined),
        "join_check": M.join_check(combined, countries),
    }
    counts = {k: v.count() for k, v in outputs.items()}
    assert counts["dim_emissions"] == 6 and counts["fct_region"] == 3 and counts["country_profile"] == 3
    assert counts["top_emitters"] == 6
    ts = {(r["country"], r["year"].year): r for r in rows(outputs["time_series"])}
    assert ts[("ALD", 2023)]["baseline_year"] == 2021
    assert ts[("ALD", 2023)]["long_term_trend"] == "Rapid decrease"
    g = {(r["country"], r["year"].year): r for r in rows(outputs["gdp_correlation"])}
    assert g[("ALD", 2022)]["decoupling_status"] == "Absolute decoupling"
    jc = {r["match_status"]: r for r in rows(outputs["join_check"])}
    assert jc["No match"]["sample_countries"] == ["AGG", "CVI", "XQX"]  # CVI: "Island" filtered out
    assert rows(outputs["source_check"]) == [{"total_rows": 14, "distinct_countries": 5}]  # 6 + AGG 2 + CVI 3 + XQX 3


def test_pipeline_reload_of_one_year(spark, landed, tmp_path):
    wb_paths, ct_paths, _ = landed
    out = scratch_path(spark, "e2e_years")
    FP.run(spark, wb_paths[:1], ct_paths[:1], out, years=[2021])
    first = {(r["country"], r["year"]) for r in rows(read_published(spark, f"{out}/combined"))}
    assert {y for _, y in first} == {2021}
    # A corrected 2022 file arrives: only 2022 is processed and written.
    fixed = tmp_path / "global_emissions_2022.csv"
    fixed.write_text("country,year,co2,ch4,n2o,co2e_100yr,co2e_20yr\nALD,2022,1,1,1,1,1\n")
    FP.run(spark, wb_paths, [str(fixed)], out, years=[2022])
    combined = rows(read_published(spark, f"{out}/combined"))
    assert {r["year"] for r in combined} == {2021, 2022}
    ald22 = [r for r in combined if (r["country"], r["year"]) == ("ALD", 2022)][0]
    assert ald22["co2"] == 1.0
    assert [r for r in combined if (r["country"], r["year"]) == ("BRM", 2021)][0]["co2"] == 700.0


def test_repeated_key_is_reported(spark, tmp_path):
    from panelyze.operators.quality import unique_violations

    p = tmp_path / "world_bank_indicators_2020.csv"
    p.write_text(WB_HEAD + "\nALD,1,2,3,4,5,6,7\nALD,1,2,3,4,5,6,8\nBEL,1,2,3,4,5,6,7\n")
    wb = FP.process_indicators(spark, [str(p)])
    got = rows(unique_violations(wb, ["country", "year"]))
    assert got == [{"country": "ALD", "year": 2020, "n_rows": 2}]


def test_build_every_model_table(spark, landed):
    from panelyze.plans.build import LAYOUT, build_models, model_frames

    wb_paths, ct_paths, seed_path = landed
    combined = FP.run(spark, wb_paths, ct_paths, scratch_path(spark, "e2e_build"))
    countries = M.stg_countries(read_seed(spark, seed_path))
    panel = M.sovereign_panel(M.stg_combined(combined), countries)
    frames = model_frames(combined, countries, panel, region="Northland")
    built = build_models(spark, frames, scratch_path(spark, "tables"))
    assert set(built) == set(LAYOUT)
    for name, df in built.items():
        assert df.columns == frames[name]().columns and df.count() > 0, name
    for name in ("fct_region", "time_series"):
        assert sorted(map(tuple, built[name].collect())) == sorted(map(tuple, frames[name]().collect())), name
