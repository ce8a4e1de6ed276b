"""The distributed ranking equals ROW_NUMBER on random groups with ties and NULLs; ordered tables and their proofs."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelyze.operators import ordinals as ORD
from panelyze.session import materialize, scratch_path

values = st.one_of(st.none(), st.sampled_from([0.0, 1.0, 1.0, 2.5, -3.0, float("nan")]), st.floats(-5, 5))
rows_strategy = st.lists(st.tuples(st.sampled_from([0, 1, 2, None]), values, values), min_size=1, max_size=40)


@settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows_strategy, k=st.integers(1, 4))
def test_row_numbers_match_window(spark, data, k):
    df = spark.createDataFrame(
        [(g, f"e{i:03d}", a, b) for i, (g, a, b) in enumerate(data)], "g int, e string, a double, b double"
    )
    got = ORD.top_row_numbers(df, ["g"], "e", {"ra": "a", "rb": "b"}, ["ra"], k)
    want = df.select(
        "g",
        "e",
        F.row_number().over(Window.partitionBy("g").orderBy(F.col("a").desc_nulls_last(), "e")).alias("ra"),
        F.row_number().over(Window.partitionBy("g").orderBy(F.col("b").desc_nulls_last(), "e")).alias("rb"),
    ).where(F.col("ra") <= k)
    assert sorted((tuple(r) for r in got.select("g", "e", "ra", "rb").collect()), key=str) == sorted(
        (tuple(r) for r in want.collect()), key=str
    )


@pytest.fixture
def many_ranges(spark):
    """Small tables stay in all their ranges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def numbers(spark, n=5000):
    """Values with many ties in one large group and several small ones."""
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (i % 11).cast("string"))).alias("g"),
        F.pmod(F.xxhash64("id"), F.lit(50)).alias("v"),
        i.alias("k"),
    )


def test_a_large_group_is_spread_over_ranges(spark, many_ranges):
    written = materialize(ORD.range_sorted(numbers(spark), ["g", "v", "k"]), "spread")
    hot = written.where("g = 'hot'").groupBy(ORD.range_of()).count().collect()
    assert len(hot) > 1
    got = ORD.with_row_numbers(written, "n", ["g"])
    want = numbers(spark).withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("v", "k")))
    assert sorted(map(tuple, got.select("g", "v", "k", "n").collect())) == sorted(map(tuple, want.collect()))


def test_ordered_table_and_its_certificate(spark, many_ranges):
    order = [F.col("v").desc(), F.col("k")]
    table = ORD.ordered_table(numbers(spark), "in-order", order)
    want = numbers(spark).withColumn("ordinal", F.row_number().over(Window.orderBy(*order)))
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("order", [["v", "k"], ["g", "k"]])
def test_certificate_finds_disorder(spark, many_ranges, order):
    path = scratch_path(spark, "other-order")
    ORD.write_in_order(numbers(spark), path, ["k"])
    proof = ORD.order_certificate(spark.read.parquet(path), order)
    assert proof.where("inversions > 0 or not follows").count() > 0
    right = ORD.order_certificate(spark.read.parquet(path), ["k"])
    assert right.where("inversions > 0 or not follows").count() == 0


def test_ranges_that_do_not_follow_each_other_are_found(spark):
    # Each range is sorted in itself, but the second one begins before the first one ends.
    rows = [(0, 1), (1, 5), ((1 << 33) + 0, 3), ((1 << 33) + 1, 9)]
    proof = ORD.order_certificate(spark.createDataFrame(rows, f"{ORD.ID} long, v int"), ["v"])
    assert [(r["inversions"], r["follows"]) for r in proof.orderBy("range").collect()] == [(0, False), (0, False)]
