"""Map the driver's star schema onto an entity-by-year panel.

The models expect a combined panel ``(country, year, indicators..., gases...)``
and a country dimension.  From the order tables we build:

* entity ``country`` = customer key, ``year`` = order year;
* ``ny_gdp_pcap_cd`` = average order total (order grain, not line grain);
* ``sp_pop_totl`` = quantity ordered;
* ``co2`` / ``ch4`` / ``n2o`` = extended price of lines with return flag
  N / A / R, and two weighted sums of them as warming potentials;
* the remaining indicators are deterministic functions of the key, in 0..110,
  with a NULL for one residue each, so every ladder band is exercised;
* the dimension is customer -> nation (sub-region) -> region;
* fixed residues of the key make the odd rows: entities whose seed row has no
  code, names that match each non-sovereign pattern, NULL and empty regions,
  years with no gases or no population, and a NULL entity (see ``ODD``).

Plan shape: lineitem is reduced to one row per order (partial aggregation
before its shuffle on the order key), joined to orders on the order key
(sort-merge; both sides are hash-partitioned on it), and aggregated to the
customer-year grain.  Money is summed as whole cents (long), so sums are
exact and do not depend on partitioning.  No join carries a broadcast hint:
nation and region (a few rows) are broadcast by the planner from their file
size, customer only if it is small.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelyze.functions.numeric import money_cents

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

# Return flag -> gas column, and the warming-potential weights
# (co2, ch4, n2o) used for the two horizons of the test panel.
FLAG_GAS = (("N", "co2"), ("A", "ch4"), ("R", "n2o"))
WEIGHTS_100YR = (1.0, 28.0, 300.0)
WEIGHTS_20YR = (1.0, 84.0, 264.0)


# The rows that make filters, joins and masks matter.  Entity
# keys divisible by ``no_dim`` have no code in the seed, those divisible by
# ``null_key`` become the NULL entity; a name's suffix and an absent region
# follow the key's residue; a year has no gases or no population where the
# residue of key and year is 0.
ODD = {"no_dim": 11, "null_key": 97, "no_gas": 19, "no_population": 23, "name": 29, "region": 31}
NAME_SUFFIX = ((1, " Island"), (2, " Territory"), (3, " Dependency"), (4, " Dependencies"), (5, " Territories"))
REGION_GAPS = ((1, None, "kept"), (2, "", "kept"), (3, "kept", None), (4, "kept", ""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _key_indicator(entity: Column, year: Column, a: int, b: int, mod: int, offset: int, null_mod: int, null_on_sum: bool = False) -> Column:
    """``offset + (a*entity + b*year) mod m``, NULL when the key hits a residue."""
    value = (F.lit(offset) + F.pmod(entity * a + year * b, F.lit(mod))).cast("double")
    null_key = F.pmod(entity + year, F.lit(null_mod)) if null_on_sum else F.pmod(entity, F.lit(null_mod))
    return F.when(null_key != 0, value)


def lines_per_order(lineitem: DataFrame) -> DataFrame:
    """One row per order: quantity and, per return flag, the price in cents."""
    cents = money_cents("l_extendedprice")
    flag = F.col("l_returnflag")
    return lineitem.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("qty"),
        *[F.sum(F.when(flag == F.lit(f), cents).otherwise(F.lit(0))).alias(f"{gas}_cents") for f, gas in FLAG_GAS],
    )


def combined_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The combined source panel, one row per (country, year)."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    lines = lines_per_order(
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag")
    )
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
    key = F.col("o_custkey")
    per_year = joined.groupBy(
        F.when(F.pmod(key, F.lit(ODD["null_key"])) != 0, key).alias("country"), F.year("o_orderdate").alias("year")
    ).agg(
        F.count(F.lit(1)).alias("_orders"),
        F.sum(money_cents("o_totalprice")).alias("_price_cents"),
        F.sum("qty").alias("_qty"),
        *[F.sum(f"{gas}_cents").alias(f"_{gas}_cents") for _, gas in FLAG_GAS],
    )
    c, y = F.col("country"), F.col("year")
    no_gas = F.pmod(c + y, F.lit(ODD["no_gas"])) == 0
    gas = {g: F.when(no_gas, F.lit(0.0)).otherwise(F.col(f"_{g}_cents") / F.lit(100.0)) for _, g in FLAG_GAS}
    population = F.when(F.pmod(c * 3 + y, F.lit(ODD["no_population"])) == 0, F.lit(0.0)).otherwise(F.col("_qty"))
    w100, w20 = WEIGHTS_100YR, WEIGHTS_20YR
    return per_year.select(
        c,
        y,
        population.alias("sp_pop_totl"),
        (F.col("_price_cents").cast("double") / (F.col("_orders") * F.lit(100))).alias("ny_gdp_pcap_cd"),
        _key_indicator(c, y, 7, 3, 40, 50, 13).alias("sp_dyn_le00_in"),
        _key_indicator(c, y, 11, 5, 70, 40, 7).alias("se_sec_enrr"),
        _key_indicator(c, y, 3, 1, 25, 0, 17).alias("sl_uem_totl_zs"),
        _key_indicator(c, y, 13, 11, 40, 0, 5).alias("si_pov_gaps"),
        _key_indicator(c, y, 5, 7, 30, 25, 3, null_on_sum=True).alias("si_pov_gini"),
        gas["co2"].alias("co2"),
        gas["ch4"].alias("ch4"),
        gas["n2o"].alias("n2o"),
        (gas["co2"] * w100[0] + gas["ch4"] * w100[1] + gas["n2o"] * w100[2]).alias("co2e_100yr"),
        (gas["co2"] * w20[0] + gas["ch4"] * w20[1] + gas["n2o"] * w20[2]).alias("co2e_20yr"),
    )


def countries_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country dimension with the seed file's column names."""
    # No hints: Spark broadcasts these two tiny tables from their file size,
    # and would not if they ever grew.
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    key = F.col("c_custkey")
    name = F.pmod(key, F.lit(ODD["name"]))
    suffix = F.lit("")
    for residue, text in NAME_SUFFIX:
        suffix = F.when(name == residue, F.lit(text)).otherwise(suffix)
    area, part = F.col("r_name"), F.col("n_name")
    gap = F.pmod(key, F.lit(ODD["region"]))
    for residue, upper, lower in REGION_GAPS:
        area = area if upper == "kept" else F.when(gap == residue, F.lit(upper)).otherwise(area)
        part = part if lower == "kept" else F.when(gap == residue, F.lit(lower)).otherwise(part)
    code = F.when(F.pmod(key, F.lit(ODD["no_dim"])) != 0, key)
    return (
        cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
        .join(region, F.col("n_regionkey") == region.r_regionkey, "left")
        .select(
            F.concat("c_name", suffix).alias("name"),
            F.substring("c_mktsegment", 1, 2).alias("alpha-2"),
            code.alias("alpha-3"),
            F.col("c_nationkey").alias("country-code"),
            area.alias("region"),
            part.alias("sub-region"),
        )
    )


@dataclass(frozen=True)
class PanelThresholds:
    """Ladder bounds for the test panel.

    Order totals are in the hundreds of thousands, so the income and
    emitter-size bounds are scaled (x20 and x0.003 of the defaults) to
    spread rows over every band.  All other ladders use their defaults.
    """

    income: tuple[float, float, float, float] = (22920.0, 90300.0, 90320.0, 280100.0)
    intensity: tuple[float, float] = (3000.0, 300000.0)
