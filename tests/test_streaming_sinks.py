"""Streaming yearly ingestion and the writers."""

from pyspark.sql import functions as F

from panelyze.session import scratch_path
from panelyze.sinks import writers as W
from panelyze.streaming.ingest import ingest_years
from tests.conftest import rows

SCHEMA = "country string, co2 double"


def land(spark, landing, year, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{landing}/year={year}")


def test_ingest_new_years_and_restart(spark):
    landing = scratch_path(spark, "t_landing")
    target = scratch_path(spark, "t_target")
    ckpt = scratch_path(spark, "t_ckpt")
    schema = spark.createDataFrame([], SCHEMA).schema
    land(spark, landing, 2019, [("NLD", 1.0), ("BEL", 2.0)])
    land(spark, landing, 2020, [("NLD", 3.0)])
    out = ingest_years(spark, landing, target, schema, checkpoint=ckpt)
    assert sorted((r["country"], r["year"], r["co2"]) for r in rows(out)) == [
        ("BEL", 2019, 2.0), ("NLD", 2019, 1.0), ("NLD", 2020, 3.0)]
    # A rerun with the same checkpoint takes nothing twice; a new year is added.
    land(spark, landing, 2021, [("NLD", 5.0)])
    out = ingest_years(spark, landing, target, schema, checkpoint=ckpt)
    got = {(r["country"], r["year"]): r["co2"] for r in rows(out)}
    assert got == {("BEL", 2019): 2.0, ("NLD", 2019): 1.0, ("NLD", 2020): 3.0, ("NLD", 2021): 5.0}


def test_a_year_that_lands_again_replaces_what_it_was(spark):
    landing, target, ckpt = (scratch_path(spark, f"t_again_{n}") for n in ("landing", "target", "ckpt"))
    schema = spark.createDataFrame([], SCHEMA).schema
    land(spark, landing, 1998, [("ALD", 1.0), ("BRM", 2.0), ("CVI", 3.0)])
    land(spark, landing, 1999, [("ALD", 9.0)])
    ingest_years(spark, landing, target, schema, checkpoint=ckpt, max_files=1)
    # Spark gives the files of the new year other names.
    land(spark, landing, 1998, [("ALD", 10.0), ("BRM", 20.0)])
    # A further file of a year, by append, keeps the earlier one.
    spark.createDataFrame([("BRM", 8.0)], SCHEMA).coalesce(1).write.mode("append").parquet(f"{landing}/year=1999")
    out = ingest_years(spark, landing, target, schema, checkpoint=ckpt, max_files=1)
    assert sorted((r["year"], r["country"], r["co2"]) for r in rows(out)) == [
        (1998, "ALD", 10.0), (1998, "BRM", 20.0), (1999, "ALD", 9.0), (1999, "BRM", 8.0)]
    # One folder for each year, not for each file.
    from panelyze.sources.files import partition_folders

    assert sorted(partition_folders(spark, target)) == ["1998", "1999"]


def test_year_from_file_name(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    landing = tmp_path / "landing"
    landing.mkdir()
    pq.write_table(pa.table({"country": ["NLD"], "co2": [1.0]}), str(landing / "global_emissions_2017.parquet"))
    target = scratch_path(spark, "t_target_names")
    out = ingest_years(spark, str(landing), target, spark.createDataFrame([], SCHEMA).schema)
    assert [(r["country"], r["year"]) for r in rows(out)] == [("NLD", 2017)]


def test_write_csv_skips_empty(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert W.write_csv(empty, str(tmp_path / "e")) is False
    full = spark.createDataFrame([("NLD", 1.5)], SCHEMA)
    assert W.write_csv(full, str(tmp_path / "f")) is True
    back = spark.read.option("header", True).csv(str(tmp_path / "f"))
    assert back.columns == ["country", "co2"] and back.first()["co2"] == "1.5"


def test_partitioned_table_and_view(spark, tmp_path):
    df = spark.createDataFrame([("NLD", 2019, 1.0), ("NLD", 2020, 2.0), ("BEL", 2020, 3.0)],
                               "country string, year int, co2 double")
    path = str(tmp_path / "t")
    W.write_partitioned_clustered(df, path, "year", ["country"])
    t = W.register_table(spark, "t_panel_test", path, partitioned=True)
    assert t.where(F.col("year") == 2020).count() == 2
    W.as_view(df, "v_panel_test")
    assert spark.sql("SELECT SUM(co2) AS s FROM v_panel_test").first()["s"] == 6.0
    W.write_parquet(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 3


def test_save_as_table(spark):
    df = spark.createDataFrame([("NLD", 2019, 1.0), ("NLD", 2020, 2.0)], "country string, year int, co2 double")
    t = W.save_as_table(df, "t_saved_panel", ["year"])
    assert t.count() == 2 and sorted(r["year"] for r in t.collect()) == [2019, 2020]


def test_discover_years_union(spark, tmp_path):
    from panelyze.sources.files import discover_years

    a = spark.createDataFrame([("NLD", 2019, 1.0)], "country string, year int, co2 double")
    b = spark.createDataFrame([("NLD", 2020, 1.0)], "country string, year int, co2 double")
    W.write_years(a, str(tmp_path / "wb"))
    W.write_years(b, str(tmp_path / "ct"))
    assert discover_years(spark, str(tmp_path / "wb"), str(tmp_path / "ct"), str(tmp_path / "none")) == [2019, 2020]


def test_column_name_report(spark):
    from panelyze.operators.quality import column_name_report, preview

    df = spark.createDataFrame([("NLD", 1.0)], "country string, `SP.POP.TOTL` double")
    rep = {r["column_name"]: (r["data_type"], r["has_dot"]) for r in column_name_report(df).collect()}
    assert rep == {"country": ("string", False), "SP.POP.TOTL": ("double", True)}
    assert preview(df, 1).count() == 1
