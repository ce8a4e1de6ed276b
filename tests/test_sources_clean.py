"""Readers, cleaning and typing on small files shaped like the landed data."""

import json

import pytest

from panelyze.operators import clean as CL
from panelyze.operators import reshape as RS
from panelyze.sources import files as SRC
from tests.conftest import rows


def write(path, text):
    path.write_text(text)
    return str(path)


@pytest.fixture()
def yearly_csv(tmp_path):
    h9 = "country,SP.POP.TOTL,NY.GDP.PCAP.CD,SP.DYN.LE00.IN,SE.SEC.ENRR,SL.UEM.TOTL.ZS,SI.POV.GAPS,SI.POV.GINI"
    f2015 = write(tmp_path / "world_bank_indicators_2015.csv",
                  h9 + "\nNLD,17000000,45000.5,81.5,130,6.9,0.1,28\nAFE,600000000,1500,,,,,\n"
                       "XYZ,abc,1,2,3,4,5,6\n,5,5,5,5,5,5,5\n")
    # 2023: reordered (unemployment before enrollment), no life expectancy, integer population
    h23 = "country,SP.POP.TOTL,NY.GDP.PCAP.CD,SL.UEM.TOTL.ZS,SE.SEC.ENRR,SI.POV.GAPS,SI.POV.GINI"
    f2023 = write(tmp_path / "world_bank_indicators_2023.csv", h23 + "\nNLD,17900000,57000,3.6,120,0.2,25.7\n")
    f2024 = write(tmp_path / "world_bank_indicators_2024.csv", "\n")
    return [f2015, f2023, f2024]


def test_clean_columns_rules(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`SP.POP.TOTL` int, `Gas Name` int, ` x` int")
    assert CL.clean_columns(df).columns == ["sp_pop_totl", "gas_name", "_x"]
    assert CL.clean_columns(df, dots=False).columns[0] == "sp.pop.totl"
    assert CL.dotted_names(df) == ["SP.POP.TOTL"]
    clash = spark.createDataFrame([(1, 2)], "`a.b` int, a_b int")
    with pytest.raises(ValueError):
        CL.clean_columns(clash)


def test_yearly_csv_drift_matches_by_name(spark, yearly_csv):
    df = SRC.read_yearly_csv(spark, yearly_csv)
    df = CL.ensure_year(CL.cast_numeric_except(df, keep=["country", "_file_year"]))
    got = {(r["country"], r["year"]): r for r in rows(df)}
    assert set(y for _, y in got) == {2015, 2023}  # the empty 2024 file has no data
    nld23 = got[("NLD", 2023)]
    assert nld23["sl_uem_totl_zs"] == 3.6 and nld23["se_sec_enrr"] == 120.0  # not swapped
    assert nld23["sp_dyn_le00_in"] is None and nld23["sp_pop_totl"] == 17900000.0
    assert got[("XYZ", 2015)]["sp_pop_totl"] is None  # unparseable -> NULL
    assert got[("AFE", 2015)]["se_sec_enrr"] is None  # empty field -> NULL
    assert (None, 2015) in got  # NULL country kept here, dropped by staging


def test_read_single_empty_file_is_none(spark, yearly_csv):
    assert SRC.read_csv_file(spark, yearly_csv[2]) is None
    assert SRC.read_yearly_csv(spark, [yearly_csv[2]]) is None


def test_seed_edges(spark, tmp_path):
    text = (
        "name,alpha-2,alpha-3,country-code,iso_3166-2,region,sub-region,intermediate-region,region-code,"
        "sub-region-code,intermediate-region-code\n"
        'Arbovia,AV,ARB,004,X:AV,North,Upper North,"",142,034,""\n'
        'Glacia,GL,GLC,010,X:GL,"","","","","",""\n'
        "Nambria,NA,NMB,516,X:NA,South,Lower South,Deep South,002,202,018\n"
        '"Tarvo, Province of Arbovia",TV,TRV,158,X:TV,,,,,,\n'
        "Pebble Island,PI,PBI,162,X:PI,Sea,Outer Sea,,009,053,\n"
        "Outer Sea Territory,OS,OST,086,X:OS,Sea,Outer Sea,Far Sea,002,202,014\n"
        "Southern Sea Territories,SS,SST,260,X:SS,Sea,Outer Sea,Far Sea,002,202,014\n"
    )
    seed = SRC.read_seed(spark, write(tmp_path / "countries.csv", text))
    from panelyze.plans.models import stg_countries

    dim = {r["alpha_3"]: r for r in rows(stg_countries(seed))}
    assert dim["ARB"]["country_code"] == "004"
    assert dim["NMB"]["alpha_2"] == "NA"
    assert dim["TRV"]["country_name"] == "Tarvo, Province of Arbovia" and dim["TRV"]["region"] is None
    assert dim["GLC"]["region"] is None
    # "Island" and "Territory" names go; "Territories" matches '%Territor%'? no: kept only if no pattern matches
    assert "PBI" not in dim and "OST" not in dim
    assert "SST" in dim  # 'Territories' does not contain 'Territory'


def test_indicator_payloads(spark, tmp_path):
    docs = [
        [{"page": 1}, [
            {"countryiso3code": "NLD", "value": 1.0, "indicator": {"id": "SP.POP.TOTL"}, "date": "2020"},
            {"countryiso3code": "", "value": 2.0, "indicator": {"id": "SP.POP.TOTL"}, "date": "2020"},
            {"countryiso3code": "BEL", "value": None, "indicator": {"id": "SP.POP.TOTL"}, "date": "2020"},
            {"countryiso3code": "NLD", "value": 3.0, "indicator": {"id": "SP.POP.TOTL"}, "date": "2020"},
        ]],
        [{"message": "no data"}],
    ]
    for i, d in enumerate(docs):
        write(tmp_path / f"p{i}.json", json.dumps(d, indent=2))
    recs = SRC.read_indicator_payloads(spark, str(tmp_path), whole_file=True)
    wide = RS.pivot_last(recs, ["country"], "indicator", "value", ["SP.POP.TOTL"], ["_file", "seq"])
    got = rows(wide, ["country"])
    assert got == [{"country": "NLD", "SP.POP.TOTL": 3.0}]  # last wins; empty code and NULL value skipped


def test_emission_payloads(spark, tmp_path):
    doc = [
        {"country": "NLD", "emissions": {"co2": 1.5, "ch4": 0.5, "n2o": 0.1, "extra": 9.0}},
        {"emissions": {"co2": 1.0}},
        {"country": "BEL", "emissions": {}},
        42,
        {"country": "DEU", "emissions": {"co2": 2.0}},
    ]
    write(tmp_path / "e.json", json.dumps(doc))
    recs = SRC.read_emission_payloads(spark, str(tmp_path / "e.json"))
    flat = RS.flatten_map(recs, "country", "emissions", ["co2", "ch4", "n2o"])
    got = rows(flat, ["country"])
    assert got == [
        {"country": "DEU", "co2": 2.0, "ch4": None, "n2o": None},
        {"country": "NLD", "co2": 1.5, "ch4": 0.5, "n2o": 0.1},
    ]


@pytest.mark.parametrize(
    "value,expected",
    [
        ("[2015, 2016]", [2015, 2016]),
        ("[2015,2016]", [2015, 2016]),
        ("2019", [2019]),
        ("2015, x, 2017", [2015, 2017]),
        ('["2020", "bad"]', [2020]),
        (2021, [2021]),
        ("", [1999]),
        (None, [1999]),
        ("[1.5]", [1999]),
    ],
)
def test_parse_year_list(value, expected):
    assert SRC.parse_year_list(value, default=1999) == expected


def test_cast_and_derive(spark):
    df = spark.createDataFrame([("NLD", "2", "3", "x")], "country string, a string, b string, c string")
    typed = CL.cast_numeric(df, ["a", "b", "missing"])
    assert dict(typed.dtypes)["a"] == "double" and dict(typed.dtypes)["c"] == "string"
    out = CL.derive_product(typed, "a", "b", "ab")
    out = CL.derive_share(out, "a", "b", "a_pct")
    out = CL.derive_product(out, "a", "nope", "skip")
    r = out.first()
    assert r.ab == 6.0 and abs(r.a_pct - 66.66666666666667) < 1e-12 and "skip" not in out.columns
    assert CL.key_column_first(out.select("a", "country"), "country").columns == ["country", "a"]


def test_concat_frames_missing_columns(spark):
    a = spark.createDataFrame([("NLD", 1.0)], "country string, x double")
    b = spark.createDataFrame([("BEL", 2.0)], "country string, y double")
    got = rows(RS.concat_frames([a, b]), ["country"])
    assert got == [{"country": "BEL", "x": None, "y": 2.0}, {"country": "NLD", "x": 1.0, "y": None}]


def _bytes_read(spark):
    """Bytes that this machine's file system has read for Spark so far."""
    stats = spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file")
    return stats.getLong("bytesRead")


def test_first_lines_do_not_read_the_files(spark, tmp_path):
    small, large = tmp_path / "s", tmp_path / "l"
    for folder, n in ((small, 10), (large, 1_500_000)):
        folder.mkdir()
        for year in (2001, 2002):
            (folder / f"x_{year}.csv").write_text("country,SP.POP.TOTL\n" + "AAA,1234567.5\n" * n)
    (large / "x_2003.csv").write_text("\n")
    (large / "x_2004.csv").write_text("")
    read = []
    for folder in (small, large):
        before = _bytes_read(spark)
        got = {f.rsplit("/", 1)[1]: line for f, line in SRC.first_lines(spark, [str(folder)]).items()}
        read.append(_bytes_read(spark) - before)
        assert got["x_2001.csv"] == got["x_2002.csv"] == "country,SP.POP.TOTL"
    assert got.get("x_2003.csv") == "" and "x_2004.csv" not in got
    # A buffer of each file, not 40 MB.
    assert sum(f.stat().st_size for f in large.iterdir()) > 40_000_000
    assert read[1] < 400_000


def test_first_lines_in_bunches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(SRC, "_BUNCH", 3)
    for i in range(8):
        (tmp_path / f"with space [%2{i}].csv").write_text(f"h{i},x\n1,2\n")
    assert sorted(SRC.first_lines(spark, [str(tmp_path)]).values()) == [f"h{i},x" for i in range(8)]


def test_folders_of_years(spark, tmp_path):
    for name in ("year=2001", "year=2003", "year=old", "other=2002"):
        (tmp_path / "a" / name).mkdir(parents=True)
    (tmp_path / "b" / "year=2002").mkdir(parents=True)
    (tmp_path / "a" / "year=1999").write_text("a file, no folder")
    assert SRC.discover_years(spark, str(tmp_path / "a"), str(tmp_path / "b"), str(tmp_path / "absent")) == [2001, 2002, 2003]
    assert set(SRC.partition_folders(spark, str(tmp_path / "a"))) == {"2001", "2003", "old"}
