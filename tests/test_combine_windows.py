"""Panel merge, per-entity windows and group statistics."""

from pyspark.sql import functions as F

from panelyze.operators import aggregate as A
from panelyze.operators import windows as WN
from panelyze.operators.combine import merge_panels, merge_with_fallbacks, restrict_to_dim
from tests.conftest import rows


def test_full_outer_merge_with_suffixes(spark):
    wb = spark.createDataFrame([("NLD", 2020, 1.0, 5.0), ("BEL", 2020, 2.0, 6.0)],
                               "country string, year int, gdp double, total double")
    ct = spark.createDataFrame([("NLD", 2020, 10.0, 7.0), ("XKX", 2020, 20.0, 8.0)],
                               "country string, year int, co2 double, total double")
    got = rows(merge_panels(wb, ct), ["country"])
    assert [r["country"] for r in got] == ["BEL", "NLD", "XKX"]
    assert set(got[0]) == {"country", "year", "gdp", "total_wb", "co2", "total_ct"}
    assert got[1]["total_wb"] == 5.0 and got[1]["total_ct"] == 7.0
    assert got[2]["gdp"] is None and got[2]["co2"] == 20.0


def test_null_safe_merge(spark):
    a = spark.createDataFrame([(None, 2020, 1.0)], "country string, year int, x double")
    b = spark.createDataFrame([(None, 2020, 2.0)], "country string, year int, y double")
    assert len(rows(merge_panels(a, b))) == 2  # SQL semantics: NULL keys never match
    got = rows(merge_panels(a, b, null_safe=True))
    assert got == [{"country": None, "year": 2020, "x": 1.0, "y": 2.0}]


def test_merge_fallbacks(spark):
    a = spark.createDataFrame([("NLD", 2020, 1.0)], "country string, year int, x double")
    empty = spark.createDataFrame([], "country string, year int, y double")
    assert merge_with_fallbacks(a, empty).columns == ["country", "year", "x"]
    assert merge_with_fallbacks(None, a).columns == ["country", "year", "x"]
    both = merge_with_fallbacks(empty, None, empty_columns=["country", "year", "co2"])
    assert both.columns == ["country", "year", "co2"] and both.count() == 0


def test_restrict_to_dim_does_not_duplicate(spark):
    facts = spark.createDataFrame([("NLD", 1), ("BEL", 2)], "country string, v int")
    dim = spark.createDataFrame([("NLD",), ("NLD",)], "alpha_3 string")
    assert rows(restrict_to_dim(facts, dim, "country", "alpha_3")) == [{"country": "NLD", "v": 1}]


def test_lag_vs_exact_lag_on_gap(spark):
    df = spark.createDataFrame(
        [("MAF", 2018, 1.0), ("MAF", 2019, 2.0), ("MAF", 2021, 4.0), ("ONE", 2020, 9.0)],
        "country string, year int, v double")
    out = df.select(
        "country", "year",
        WN.lag_value("v", "country", "year").alias("prev"),
        WN.exact_lag_value("v", "country", "year", 1).alias("prev1"),
        WN.exact_lag_value("v", "country", "year", 3).alias("prev3"),
        WN.exact_lag_present("country", "year", 3).alias("has3"),
        WN.baseline_value("v", "country", "year").alias("base"),
    )
    got = {(r["country"], r["year"]): r for r in rows(out)}
    assert got[("MAF", 2021)]["prev"] == 2.0 and got[("MAF", 2021)]["prev1"] is None  # gap
    assert got[("MAF", 2021)]["prev3"] == 1.0 and got[("MAF", 2021)]["has3"]
    assert got[("MAF", 2019)]["prev1"] == 1.0 and got[("MAF", 2021)]["base"] == 1.0
    assert got[("ONE", 2020)]["prev"] is None and got[("ONE", 2020)]["base"] == 9.0


def test_group_stats_null_key_gets_null(spark):
    df = spark.createDataFrame([("A", "EU", 2.0), ("B", "EU", 4.0), ("C", None, 8.0)],
                               "country string, region string, v double")
    out = WN.attach_group_stats(df, ["region"], {"avg_v": F.avg("v")})
    got = {r["country"]: r["avg_v"] for r in rows(out)}
    assert got == {"A": 3.0, "B": 3.0, "C": None}


def test_top_k_per_group_and_sample(spark):
    df = spark.createDataFrame([("y1", c, float(i)) for i, c in enumerate("abcdefg")], "g string, c string, v double")
    top = WN.top_k_per_group(df, ["g"], [F.col("v").desc(), "c"], 3)
    assert [r["c"] for r in rows(top, ["rank"])] == ["g", "f", "e"]
    s = A.sample_values(df, ["g"], "c", 4, "sample")
    assert rows(s) == [{"g": "y1", "sample": ["a", "b", "c", "d"]}]


def test_mode_helpers(spark):
    df = spark.createDataFrame([("r", "x"), ("r", "y"), ("r", "y"), ("s", "x"), ("s", "y")], "g string, v string")
    assert {r["g"]: r["mode_v"] for r in rows(A.mode_by_group(df, ["g"], "v"))} == {"r": "y", "s": "y"}
    counts = A.count_labels("v", ["x", "y", "z"])
    out = df.groupBy("g").agg(A.mode_of_labels(counts, ["x", "y", "z"]).alias("m"))
    assert {r["g"]: r["m"] for r in rows(out)} == {"r": "y", "s": "y"}


def test_zero_fill_sum(spark):
    df = spark.createDataFrame([("A", 1, None), ("A", 1, None), (None, 1, 5.0), ("B", 1, 2.5)],
                               "k string, y int, v double")
    got = {r["k"]: r["v"] for r in rows(A.sum_by_key_zero_fill(df, ["k", "y"], ["v"]))}
    assert got == {"A": 0.0, "B": 2.5}
