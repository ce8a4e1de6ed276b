"""Written tables: clustering, buckets, published versions, catalog years, footers, checks counted while writing."""

import pytest
from pyspark.sql import functions as F

from panelyze.operators import quality as Q
from panelyze.operators.combine import merge_with_fallbacks
from panelyze.plans import file_pipeline as FP
from panelyze.plans import models as M
from panelyze.plans.build import build_and_check
from panelyze.session import scratch_path
from panelyze.sinks import catalog as CAT
from panelyze.sinks import versions as V
from panelyze.sinks import writers as W
from panelyze.sources import files as SRC
from tests.test_plans import panel, plan_of, tree  # noqa: F401


@pytest.fixture
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def years(spark, n=400, of=(2019, 2020, 2021), factor=1.0):
    rows = [(f"C{i:04d}", y, float(i) * factor) for y in of for i in range(n)]
    return spark.createDataFrame(rows, "country string, year int, co2 double").repartition(7)


def test_files_of_a_year_hold_ranges_of_keys(spark, many_ranges):
    path = scratch_path(spark, "clustered")
    W.write_partitioned_clustered(years(spark), path, "year", ["country"])
    ends = (
        spark.read.parquet(path).groupBy("year", F.col("_metadata.file_name").alias("file"))
        .agg(F.min("country").alias("lo"), F.max("country").alias("hi")).orderBy("year", "lo").collect()
    )
    assert len(ends) > 4
    for a, b in zip(ends, ends[1:]):
        assert a["year"] != b["year"] or a["hi"] < b["lo"]


def test_trends_over_buckets_need_no_exchange(spark, panel):
    bucketed = W.save_bucketed(panel, "t_bucketed_panel", "country", 4, ["year"])
    plan = tree(plan_of(M.time_series(bucketed)))
    assert "Window" in plan and "Exchange" not in plan
    assert sorted(map(str, M.time_series(bucketed).collect())) == sorted(map(str, M.time_series(panel).collect()))


def test_reload_prunes_both_sides(spark):
    root = scratch_path(spark, "pruned")
    for name in ("indicators", "emissions"):
        W.write_years(years(spark, 5).withColumnRenamed("co2", name), f"{root}/{name}")
    plan = plan_of(FP.combine_tables(spark, f"{root}/indicators", f"{root}/emissions", [2020]))
    filters = [ln for ln in plan.splitlines() if ln.startswith("PartitionFilters")]
    assert len(filters) == 2 and all("2020" in ln for ln in filters)


def test_a_reload_is_seen_whole_or_not_at_all(spark, monkeypatch):
    root = scratch_path(spark, "versions")
    assert V.read_published(spark, root) is None
    V.publish_years(years(spark, 3, (2019, 2020)), root)
    before = V.read_published(spark, root)
    # The next run is written, but its pointer is not yet there.
    real = V.write_years
    seen = []

    def written(df, path, *rest):
        real(df, path, *rest)
        seen.append(sorted(map(str, V.read_published(spark, root).collect())))

    monkeypatch.setattr(V, "write_years", written)
    V.publish_years(years(spark, 3, (2020, 2021), 2.0).withColumn("more", F.lit(1)), root)
    assert seen == [sorted(map(str, before.collect()))]
    now = {(r["country"], r["year"]): (r["co2"], r["more"]) for r in V.read_published(spark, root).collect()}
    assert len(now) == 9 and now[("C0001", 2019)] == (1.0, None) and now[("C0001", 2020)] == (2.0, 1)
    # A reader that began before goes on with what it saw.
    assert before.where("year = 2020 and country = 'C0001'").first()["co2"] == 1.0
    # A reloaded year without rows is no longer published.
    V.publish_years(years(spark, 3, (2019,)), root, years=[2019, 2021])
    assert {r["year"] for r in V.read_published(spark, root).collect()} == {2019, 2020}
    assert V.read_published(spark, root, years=[2020]).count() == 3
    assert V.remove_unpublished(spark, root) == 1
    assert V.read_published(spark, root).count() == 6


def test_two_reloads_cannot_take_one_number(spark, monkeypatch):
    root = scratch_path(spark, "versions_race")
    V.publish_years(years(spark, 2, (2019,)), root)
    real = V.write_years

    def overtaken(df, path, *rest):
        monkeypatch.setattr(V, "write_years", real)
        V.publish_years(years(spark, 2, (2020,)), root)
        real(df, path, *rest)

    monkeypatch.setattr(V, "write_years", overtaken)
    with pytest.raises(RuntimeError):
        V.publish_years(years(spark, 2, (2021,)), root)
    assert {r["year"] for r in V.read_published(spark, root).collect()} == {2019, 2020}


def test_catalog_knows_years_one_reload_at_a_time(spark):
    path = scratch_path(spark, "catalog_years")
    W.write_years(years(spark, 2), path)
    CAT.create_year_table(spark, "t_years", path, "country string, co2 double, year int")
    assert CAT.catalog_years(spark, "t_years", "t_absent") == [] and spark.table("t_years").count() == 0
    folders = SRC.partition_folders(spark, path)
    CAT.add_years(spark, "t_years", {2020: folders["2020"]})
    assert CAT.catalog_years(spark, "t_years") == [2020] and spark.table("t_years").count() == 2
    # A year that is reloaded elsewhere moves there.
    other = scratch_path(spark, "catalog_other")
    W.write_years(years(spark, 3, (2020,), 2.0), other)
    CAT.add_years(spark, "t_years", {2020: SRC.partition_folders(spark, other)["2020"], 2021: folders["2021"]})
    assert spark.table("t_years").groupBy("year").count().orderBy("year").collect() == [(2020, 3), (2021, 2)]
    made = CAT.create_tables_per_year(spark, "t_one", path, [2019, 2021])
    assert made == {2019: "t_one_2019", 2021: "t_one_2021"} and spark.table("t_one_2021").count() == 2


def test_models_are_registered(spark, panel):
    path = scratch_path(spark, "registered")
    W.write_partitioned_clustered(M.dim_emissions(panel), path, "year", ["country"])
    t = CAT.register_models(spark, {"dim_emissions": path}, "t_reg_")["dim_emissions"]
    assert t.count() == M.dim_emissions(panel).count() == spark.table("t_reg_dim_emissions").count()


def test_rows_are_counted_in_footers(spark):
    path = scratch_path(spark, "footers")
    assert SRC.footer_rows(spark, path) == 0
    W.write_years(years(spark, 5), path)
    assert SRC.footer_rows(spark, path) == 15 and SRC.footer_rows(spark, path, [2020, 2021]) == 10
    W.write_parquet(years(spark, 5).limit(0), f"{path}_empty")
    assert SRC.footer_rows(spark, f"{path}_empty") == 0


def test_known_sides_are_not_looked_at(spark, monkeypatch):
    a = spark.createDataFrame([("ALD", 2020, 1.0)], "country string, year int, x double")
    monkeypatch.setattr(type(a), "isEmpty", lambda self: pytest.fail("a job was run"))
    assert merge_with_fallbacks(a, a.limit(0), has_rows=(True, False)).columns == a.columns


def test_checks_are_counted_while_writing(spark):
    rows = [("a", 1, None), ("a", 1, 2.0), ("a", 1, 2.0), (None, 2, 1.0), (None, 2, 1.0), ("b", 1, 1.0)]
    df = spark.createDataFrame(rows, "k string, year int, v double")
    marked, watch, seen = Q.watched(df, ["k", "v"], [["k", "year"], ["v"]])
    path = scratch_path(spark, "watched")
    W.write_partitioned_clustered(marked, path, "year", ["k"], watch)
    assert seen.get == {"not_null_k": 2, "not_null_v": 1, "unique_k_year": 2, "unique_v": 2}
    assert spark.read.parquet(path).columns == ["k", "v", "year"]
    report = build_and_check(spark, {"view": lambda: df}, path, {"view": ["k"]}, {"view": [["k"]]})
    assert sorted(map(tuple, report.collect())) == [("view", "not_null_k", 2), ("view", "unique_k", 2)]


def test_models_read_what_is_written_for_them(spark):
    """A view in read_later is computed once, though two later models read it; views are not kept otherwise."""
    runs = spark.sparkContext.accumulator(0)
    rows = spark.createDataFrame([("a", 1), (None, 2), ("a", 3)], "k string, year int").rdd

    def seen(row):
        runs.add(1)
        return row

    df = rows.map(seen).toDF("k string, year int")
    path = scratch_path(spark, "read_later")
    staged = lambda: spark.read.parquet(f"{path}/base")
    frames = {"base": lambda: df, "odd": lambda: staged().where("year % 2 = 1"), "even": lambda: staged().where("year = 2")}
    checks = {name: ["k"] for name in frames}
    report = build_and_check(spark, frames, path, checks, {"odd": [["k"]]}, read_later=["base"])
    want = [("base", "not_null_k", 1), ("even", "not_null_k", 1), ("odd", "not_null_k", 0), ("odd", "unique_k", 1)]
    assert sorted(map(tuple, report.collect())) == want
    assert runs.value == 3
    assert SRC.footer_rows(spark, f"{path}/base") == 3


def test_a_failing_model_fails_the_build(spark):
    frames = {
        "good": lambda: spark.range(3),
        "bad": lambda: spark.range(3).selectExpr("raise_error('broken row') AS k"),
    }
    with pytest.raises(Exception, match="broken row"):
        build_and_check(spark, frames, scratch_path(spark, "failing"), {"good": ["id"], "bad": ["k"]}, {})


def test_declared_checks_read_the_raw_tables_once(spark, monkeypatch):
    from panelyze.plans import operator_queries as OQ
    from panelyze.plans import pipeline

    monkeypatch.setattr(pipeline, "_MATERIALISED", {})
    built = []
    of = pipeline.M.sovereign_panel

    def sovereign_panel(staged, *rest):
        built.append(staged.inputFiles())
        return of(staged, *rest)

    monkeypatch.setattr(pipeline.M, "sovereign_panel", sovereign_panel)
    sf = scratch_path(spark, "tables")
    made = {
        "region": "SELECT 0 AS r_regionkey, 'EUROPE' AS r_name",
        "nation": "SELECT 0 AS n_nationkey, 'FRANCE' AS n_name, 0 AS n_regionkey",
        "customer": "SELECT id + 1 AS c_custkey, concat('C', id) AS c_name, 0 AS c_nationkey, 'BUILDING' AS c_mktsegment FROM range(20)",
        "orders": "SELECT id AS o_orderkey, id % 20 + 1 AS o_custkey, make_timestamp(1992 + cast(id % 7 AS int), 1, 1, 0, 0, 0) AS o_orderdate, 1000.5D + id AS o_totalprice FROM range(300)",
        "lineitem": "SELECT id % 300 AS l_orderkey, 2D AS l_quantity, 10.25D AS l_extendedprice, element_at(array('N', 'A', 'R'), cast(id % 3 AS int) + 1) AS l_returnflag FROM range(900)",
    }
    for name, sql in made.items():
        spark.sql(sql).write.parquet(f"{sf}/{name}.parquet")
    # One customer stands on two rows, so the panel repeats its keys.
    spark.sql(f"{made['customer']} WHERE id = 4").write.mode("append").parquet(f"{sf}/customer.parquet")
    report = {(r.model, r.check_name): r.failures for r in OQ.declared_checks(spark, sf).collect()}
    assert len(report) == 33
    assert report["stg_countries", "unique_alpha_3"] == 1
    assert report["fct_region", "unique_region_year"] == 0
    # The panel that was written came from the staged table, not from lineitem.
    assert built[-1] and all("stg_combined" in f for f in built[-1])


def test_key_is_taken_as_the_panel_has_it(spark):
    once = spark.createDataFrame([("a", 1), ("a", 2), (None, 1)], "country string, year int")
    assert M.with_key_seen(once, M.ModelParams()).key_unique
    assert not M.with_key_seen(once.union(once.limit(1)), M.ModelParams()).key_unique
