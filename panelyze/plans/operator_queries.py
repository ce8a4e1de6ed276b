"""Operator-level queries over the driver's tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame.  Sources
and sinks are exercised by round trips: Spark derives landed files (yearly
CSV with drifting headers, JSON API payloads, year-partitioned Parquet) from
the tables into a fresh folder under ``spark.checkpoint.dir``, and the
query reads them back with the library's readers.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelyze.functions.numeric import date_to_year, exact_avg, exact_sum, money_cents
from panelyze.operators import aggregate as A
from panelyze.operators import clean as CL
from panelyze.operators import ordinals as ORD
from panelyze.operators import quality as Q
from panelyze.operators import reshape as RS
from panelyze.operators.combine import merge_panels
from panelyze.operators.filters import exclude_name_patterns
from panelyze.plans import models as M
from panelyze.plans.pipeline import TEST_PARAMS, panel_frames
from panelyze.plans.testpanel import table
from panelyze.session import input_version, materialize, scratch_path, session_id
from panelyze.sinks import catalog as CAT
from panelyze.sinks import versions as V
from panelyze.sinks import writers as W
from panelyze.sources import files as SRC

# The event types of the events table (pivot output columns)
# and the source header names of the indicator files.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
INDICATOR_HEADERS = (
    ("sp_pop_totl", "SP.POP.TOTL"),
    ("ny_gdp_pcap_cd", "NY.GDP.PCAP.CD"),
    ("sp_dyn_le00_in", "SP.DYN.LE00.IN"),
    ("se_sec_enrr", "SE.SEC.ENRR"),
    ("sl_uem_totl_zs", "SL.UEM.TOTL.ZS"),
    ("si_pov_gaps", "SI.POV.GAPS"),
    ("si_pov_gini", "SI.POV.GINI"),
)
# The drifted year: columns reordered and life expectancy absent.
DRIFT_YEAR = 2001
DRIFT_DROPS = "SP.DYN.LE00.IN"
# A year whose file is an empty frame (header-less single newline).
EMPTY_YEAR = 2002
RELOAD_YEAR = 1998

# Landed files are derived from the tables once per session and input folder
# and then read by every query that needs them.
_LANDED: dict[tuple, str] = {}


def _landed(spark: SparkSession, sf_dir: str, kind: str, land) -> str:
    tables = ("orders", "lineitem", "customer", "nation", "region", "events")
    version = input_version(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in tables])
    key = (session_id(spark), sf_dir, kind, version if version is not None else object())
    if key not in _LANDED:
        root = scratch_path(spark, kind)
        land(spark, sf_dir, root)
        _LANDED[key] = root
    return _LANDED[key]


# ------------------------------------------------------------------ reshape


def pivot_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as long indicator records -> one row per (user, day), one
    column per event type, the last value (by time, then id) winning."""
    ev = table(spark, sf_dir, "events").select(
        "user_id", F.to_date("ts").alias("day"), "event_type", "value", "ts", "event_id"
    )
    return RS.pivot_last(ev, ["user_id", "day"], "event_type", "value", EVENT_TYPES, ["ts", "event_id"])


def flatten_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON property maps -> one column per name found."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "map<string,double>").alias("props")
    )
    return RS.flatten_map(ev, "event_id", "props")


# ------------------------------------------------------------------ sources


PAGE_SIZE = 1000


def _indicator_payloads(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Land events as API payload documents ``[metadata, [records]]``.

    One document (page) per event type and block of ``PAGE_SIZE`` event ids,
    so no document, and no task building one, grows with a hot key.
    Records carry the user as the country code and the event time as
    ``date``, in time order; pages are numbered in id order.
    """
    ev = table(spark, sf_dir, "events")
    page = F.floor(F.col("event_id") / PAGE_SIZE).cast("long")
    rec = F.struct(
        F.col("user_id").cast("string").alias("countryiso3code"),
        F.col("value").alias("value"),
        F.struct(F.col("event_type").alias("id")).alias("indicator"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("date"),
    )
    docs = ev.groupBy("event_type", page.alias("page")).agg(
        F.array_sort(F.collect_list(F.struct("ts", "event_id", rec.alias("r")))).alias("items")
    )
    meta = F.to_json(F.struct("page", F.lit(PAGE_SIZE).alias("per_page"), F.size("items").alias("total")))
    body = F.to_json(F.transform("items", lambda x: x["r"]))
    docs.select(F.concat(F.lit("["), meta, F.lit(","), body, F.lit("]")).alias("value")).write.mode(
        "overwrite"
    ).text(path)


def json_indicator_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed payloads read back, decoded and pivoted; the last record in
    (time, page, position) order wins."""
    path = _landed(spark, sf_dir, "payloads", _indicator_payloads)
    recs = SRC.read_indicator_payloads(spark, path, whole_file=False)
    recs = recs.withColumn("day", F.to_date(F.substring("date", 1, 10)))
    return RS.pivot_last(recs, ["country", "day"], "indicator", "value", EVENT_TYPES, ["date", "page", "seq"])


def _land_yearly_csv(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Write the indicator side of the panel as one CSV folder per year
    (``year=YYYY``) with source-style dotted headers.  One job writes the
    regular years; the drifted year has its columns reordered and one
    missing; one extra year holds an empty frame (a single newline)."""
    combined = panel_frames(spark, sf_dir, TEST_PARAMS).combined
    cols = [F.col(src).alias(hdr) for src, hdr in INDICATOR_HEADERS]
    regular = combined.where(F.col("year") != DRIFT_YEAR).select("country", "year", *cols)
    regular.write.mode("overwrite").partitionBy("year").option("header", True).csv(root)
    drifted = [c for (_, hdr), c in zip(INDICATOR_HEADERS, cols) if hdr != DRIFT_DROPS][::-1]
    W.write_csv(combined.where(F.col("year") == DRIFT_YEAR).select("country", *drifted), f"{root}/year={DRIFT_YEAR}")
    spark.createDataFrame([("",)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{root}/year={EMPTY_YEAR}"
    )


def csv_yearly_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drifting yearly CSV read back by name, cleaned, typed, year from the path."""
    root = _landed(spark, sf_dir, "wb_landing", _land_yearly_csv)
    # One folder per year (a year's file written by several tasks).
    folders = _year_folders(spark, root)
    stacked = SRC.read_yearly_csv(spark, folders, pattern=r"year=(\d{4})/", name_col="_metadata.file_path")
    typed = CL.cast_numeric_except(stacked, keep=["country", "_file_year"])
    typed = CL.ensure_year(typed)
    return typed.select("country", "year", *[src for src, _ in INDICATOR_HEADERS])


# ------------------------------------------------------------------- joins


def _orders_by_nation_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .groupBy(F.col("c_nationkey").alias("country"), F.year("o_orderdate").alias("year"))
        .agg((F.sum(money_cents("o_totalprice")) / 100.0).alias("revenue"), F.count(F.lit(1)).alias("n"))
    )


def _lines_by_nation_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_extendedprice")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (
        li.join(s, li.l_suppkey == s.s_suppkey)
        .groupBy(F.col("s_nationkey").alias("country"), F.year("l_shipdate").alias("year"))
        .agg((F.sum(money_cents("l_extendedprice")) / 100.0).alias("revenue"), F.count(F.lit(1)).alias("n"))
    )


def _by_key_year(df: DataFrame, key: str, date: str, money: str) -> DataFrame:
    return df.groupBy(F.col(key).alias("country"), F.year(date).alias("year")).agg(
        (F.sum(money_cents(money)) / 100.0).alias("revenue"), F.count(F.lit(1)).alias("n")
    )


def full_outer_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals by customer and year vs shipped totals by supplier and year, merged on
    (key, year); shared names get ``_wb`` / ``_ct``.  There are more customers
    than suppliers, some without orders, and more ship than order years, so all
    three cases of the full outer join occur."""
    left = _by_key_year(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_totalprice")
    return merge_panels(left, _by_key_year(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_shipdate", "l_extendedprice"))


def single_year_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity-only inner join of two single-year inputs, for every year in both."""
    from panelyze.operators.combine import join_single_period

    a, b = _orders_by_nation_year(spark, sf_dir), _lines_by_nation_year(spark, sf_dir)
    return join_single_period(a, b, "country", "year")


# ------------------------------------------------------------- aggregation


def sum_by_supplier_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (supplier, ship year) price by return flag; an absent flag sums to 0."""
    li = table(spark, sf_dir, "lineitem")
    wide = li.select(
        F.col("l_suppkey").alias("supplier"),
        F.year("l_shipdate").alias("year"),
        *[F.when(F.col("l_returnflag") == f, F.col("l_extendedprice")).alias(f"flag_{f}") for f in ("A", "N", "R")],
    )
    return A.sum_by_key_zero_fill(wide, ["supplier", "year"], ["flag_A", "flag_N", "flag_R"])


def entity_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per country: total emissions and average CO2 share over all years."""
    dim = M.dim_emissions(panel_frames(spark, sf_dir, TEST_PARAMS, materialised=True).panel)
    return A.entity_summary(dim, "country", M.TOTAL, "co2_percentage")


def income_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most frequent income category per region and year (open label set)."""
    panel = panel_frames(spark, sf_dir, TEST_PARAMS, materialised=True).panel
    return A.mode_by_group(panel.where(F.col(M.HAS_SOCIO)), ["region", "year"], "income_category")


def distinct_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.distinct_values(panel_frames(spark, sf_dir, TEST_PARAMS).combined, ["country"])


def sovereign_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The non-sovereign name patterns applied to the names of the seed."""
    seed = panel_frames(spark, sf_dir, TEST_PARAMS).seed
    return exclude_name_patterns(seed.select(F.col("`alpha-3`").alias("code"), "name"), "name")


# ----------------------------------------------------------------- quality

STAGED_CHECK_COLUMNS = ("population", "gdp_per_capita", "life_expectancy", "school_enrollment", "gini_index")


def null_counts_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.null_counts(panel_frames(spark, sf_dir, TEST_PARAMS).staged, STAGED_CHECK_COLUMNS)


def unique_panel_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer-year keys that several orders repeat."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("country"), F.year("o_orderdate").alias("year"))
    return Q.unique_violations(orders, ["country", "year"])


def unique_dim_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country codes (nations) that several entities of the dimension share."""
    return Q.unique_violations(panel_frames(spark, sf_dir, TEST_PARAMS).countries, ["country_code"])


def dim_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fails (returns the count) when the dimension is outside 180..250 rows."""
    return Q.row_count_outside(panel_frames(spark, sf_dir, TEST_PARAMS).countries, 180, 250)


def not_null_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.not_null_violations(
        panel_frames(spark, sf_dir, TEST_PARAMS).staged.select("country", "year", "life_expectancy"),
        ["life_expectancy"],
    )


# ------------------------------------------------------------------- sinks


def year_overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the combined panel by year, reload one corrected year, read back.

    The reload doubles that year's ``co2``; dynamic partition overwrite must
    replace that year only and keep every other year as written.
    """
    combined = panel_frames(spark, sf_dir, TEST_PARAMS).combined
    path = scratch_path(spark, "combined_by_year")
    W.write_years(combined, path, "year", ["country"])
    reload = combined.where(F.col("year") == RELOAD_YEAR).withColumn("co2", F.col("co2") * 2)
    W.write_years(reload, path, "year", ["country"])
    return spark.read.parquet(path).select(*combined.columns)


def external_table_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Emissions dimension written partitioned by year and clustered by
    country, registered as a table and read from the catalog."""
    dim = M.dim_emissions(panel_frames(spark, sf_dir, TEST_PARAMS, materialised=True).panel)
    path = scratch_path(spark, "dim_emissions")
    W.write_partitioned_clustered(dim, path, "year", ["country"])
    name = "dim_emissions_" + path.rsplit("-", 1)[-1]
    t = W.register_table(spark, name, path, partitioned=True)
    return t.select(*M.DIM_EMISSIONS_COLUMNS)


def entity_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share derived with ``derive_share`` and product with ``derive_product``."""
    staged = panel_frames(spark, sf_dir, TEST_PARAMS).staged
    out = CL.derive_share(staged, "co2_emissions", "population", "co2_per_unit_pct")
    out = CL.derive_product(out, "population", "gdp_per_capita", "total_gdp")
    return out.select("country", "year", "co2_per_unit_pct", "total_gdp")


def supplier_totals_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact revenue per supplier nation, and of made groups: one that passes 1e18, with NaN, with either infinity.

    ``special`` names a total that is no finite number, which ``revenue`` leaves out.
    """
    li = table(spark, sf_dir, "lineitem").select("l_quantity", "l_returnflag", "l_extendedprice")
    large = li.select(F.explode(F.array(F.lit(9.9e12) + F.col("l_quantity"), F.lit(9.9e12 + 0.25))).alias("revenue"))
    odd = lambda v: F.when(F.col("l_returnflag") == "A", F.lit(float(v))).otherwise(F.col("l_extendedprice"))
    groups = {-2: "nan", -3: "inf", -4: "-inf"}
    special = li.select(F.explode(F.array(*[F.struct(F.lit(k).alias("country"), odd(v).alias("revenue")) for k, v in groups.items()])).alias("r"))
    rows = _lines_by_nation_year(spark, sf_dir).select("country", "revenue")
    rows = rows.unionByName(large.select(F.lit(-1).alias("country"), "revenue")).unionByName(special.select("r.*"))
    sums = rows.groupBy("country").agg(exact_sum("revenue").alias("v"))
    sums = sums.unionByName(li.agg(exact_avg(odd("nan")).alias("v")).select(F.lit(-5).alias("country"), "v"))
    finite = F.abs("v") < float("inf")
    name = F.when(F.isnan("v"), "nan").when(F.col("v") > 0, "inf").otherwise("-inf")
    return sums.select("country", F.when(finite, F.col("v")).alias("revenue"), F.when(~finite, name).alias("special"))


# --------------------------------------------------------------- streaming


def stream_year_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Combined panel landed as yearly Parquet folders and taken by the ingestion stream into a
    year-partitioned table; then one corrected year lands again and the stream goes on."""
    from panelyze.streaming.ingest import ingest_years

    combined = panel_frames(spark, sf_dir, TEST_PARAMS).combined
    landing, target, seen = (scratch_path(spark, n) for n in ("landing", "ingested", "ingest-checkpoint"))
    # Two files for each year, taken three at a time: a year spans batches.
    W.write_years(combined.repartition(2, "country"), landing)
    args = spark, landing, target, combined.drop("year").schema
    ingest_years(*args, sort_by=["country"], checkpoint=seen, max_files=3)
    reload = combined.where(F.col("year") == RELOAD_YEAR).withColumn("co2", F.col("co2") * 2)
    W.write_years(reload, landing)
    return ingest_years(*args, sort_by=["country"], checkpoint=seen, max_files=3).select(*combined.columns)


# ---------------------------------------------------------------- sources 2


def parquet_years(spark: SparkSession, sf_dir: str, years=(1996, 1997)) -> DataFrame:
    """The combined panel written as year-partitioned Parquet and read back
    for a year list (partition pruning: other years are never opened)."""
    combined = panel_frames(spark, sf_dir, TEST_PARAMS).combined
    path = scratch_path(spark, "combined_parquet")
    W.write_years(combined, path)
    return SRC.read_parquet(spark, path, SRC.parse_year_list(list(years))).select(*combined.columns)


def registered_view_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model written in SQL against a registered view of the staged panel."""
    staged = panel_frames(spark, sf_dir, TEST_PARAMS).staged
    name = "stg_combined_" + scratch_path(spark, "view").rsplit("-", 1)[-1]
    W.as_view(staged, name)
    return spark.sql(
        f"""
        SELECT year, COUNT(*) AS n_rows, COUNT(DISTINCT country) AS n_countries,
               CAST(SUM(CAST(co2_emissions AS DECIMAL(38,2))) AS DOUBLE) AS co2_emissions
        FROM {name}
        WHERE population > 0
        GROUP BY year
        """
    )


# ----------------------------------------------------------- file pipeline

GAS_WEIGHTS = (("co2e_100yr", (1.0, 28.0, 300.0)), ("co2e_20yr", (1.0, 84.0, 264.0)))


def _land_emission_csv(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Order-level gas records as one CSV folder per year (``year=YYYY``),
    several rows per (customer, year); orders without lines have empty gases."""
    from panelyze.plans.testpanel import FLAG_GAS, lines_per_order

    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = lines_per_order(
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag")
    )
    gas = {g: F.col(f"{g}_cents") / F.lit(100.0) for _, g in FLAG_GAS}
    recs = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").select(
        F.col("o_custkey").alias("country"),
        F.year("o_orderdate").alias("year"),
        *[gas[g].alias(g) for _, g in FLAG_GAS],
        *[(gas["co2"] * w[0] + gas["ch4"] * w[1] + gas["n2o"] * w[2]).alias(name) for name, w in GAS_WEIGHTS],
    )
    # The year stays in the file as a column and names the folder.
    recs.withColumn("_y", F.col("year")).write.mode("overwrite").partitionBy("_y").option("header", True).csv(root)


def _year_folders(spark: SparkSession, root: str, key: str = "year") -> list[str]:
    return sorted(SRC.partition_folders(spark, root, key).values())


def process_emission_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly emission CSV -> gases summed per (country, year), zero-filled."""
    from panelyze.plans.file_pipeline import process_emissions

    root = _landed(spark, sf_dir, "ct_landing", _land_emission_csv)
    return process_emissions(spark, _year_folders(spark, root, "_y"), r"_y=(\d{4})/", "_metadata.file_path")


def process_indicator_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly indicator CSV (drifting headers, an empty year) -> typed rows."""
    from panelyze.plans.file_pipeline import process_indicators

    root = _landed(spark, sf_dir, "wb_landing", _land_yearly_csv)
    return process_indicators(spark, _year_folders(spark, root), r"year=(\d{4})/", "_metadata.file_path")


def file_pipeline_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sources landed, processed, written by year, merged and written."""
    from panelyze.plans import file_pipeline as FP

    wb_root = _landed(spark, sf_dir, "wb_landing", _land_yearly_csv)
    ct_root = _landed(spark, sf_dir, "ct_landing", _land_emission_csv)
    wb = FP.process_indicators(spark, _year_folders(spark, wb_root), r"year=(\d{4})/", "_metadata.file_path")
    ct = FP.process_emissions(spark, _year_folders(spark, ct_root, "_y"), r"_y=(\d{4})/", "_metadata.file_path")
    out_root = scratch_path(spark, "pipeline_out")
    read_back = []
    for name, df in (("indicators", wb), ("emissions", ct)):
        W.write_years(df, f"{out_root}/{name}", "year", ["country"])
        read_back.append(spark.read.parquet(f"{out_root}/{name}"))
    combined = FP.combine_sources(*read_back)
    W.write_years(combined, f"{out_root}/combined", "year", ["country"])
    return spark.read.parquet(f"{out_root}/combined")


# ------------------------------------------------------------- model tables


def socio_dimension_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The socioeconomic dimension built as a table (partitioned by year,
    clustered by country and income category) and read back."""
    from panelyze.plans.build import build_models, model_frames

    f = panel_frames(spark, sf_dir, TEST_PARAMS, materialised=True)
    frames = model_frames(f.combined, f.countries, f.panel, TEST_PARAMS)
    return build_models(spark, frames, scratch_path(spark, "model_tables"), only=["dim_socio"])["dim_socio"]


def rewritten_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model table written in full, then again with one year less: the year goes."""
    dim = M.dim_wellbeing(panel_frames(spark, sf_dir, TEST_PARAMS, materialised=True).panel)
    path = scratch_path(spark, "rewritten")
    W.write_partitioned_clustered(dim, path, "year", ["country"])
    W.write_partitioned_clustered(dim.where(F.year("year") != RELOAD_YEAR), path, "year", ["country"])
    return spark.read.parquet(path).select(*M.DIM_WELLBEING_COLUMNS)


def catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model saved as a managed table and read by its name."""
    dim = M.dim_wellbeing(panel_frames(spark, sf_dir, TEST_PARAMS, materialised=True).panel)
    name = "dim_wellbeing_" + scratch_path(spark, "name").rsplit("-", 1)[-1]
    return W.save_as_table(dim, name, ["year"]).select(*M.DIM_WELLBEING_COLUMNS)


def late_column_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two reloads of one panel, the later with a column the earlier lacks; read back whole."""
    from panelyze.plans.file_pipeline import _read_if_written

    combined = panel_frames(spark, sf_dir, TEST_PARAMS).combined.select("country", "year", "co2", "si_pov_gini")
    path = scratch_path(spark, "late_column")
    W.write_years(combined.where(F.col("year") < RELOAD_YEAR).drop("si_pov_gini"), path, "year", ["country"])
    W.write_years(combined.where(F.col("year") >= RELOAD_YEAR), path, "year", ["country"])
    return _read_if_written(spark, path).select("country", "year", "co2", "si_pov_gini")


def declared_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The models' declared checks, counted in the pass that builds each model: ``(model, check_name, failures)``.

    The raw tables are read once: the staged panel is written as a table, from
    which the sovereign rows and the panel of all other models are built.
    """
    from panelyze.plans.build import build_and_check

    p = TEST_PARAMS
    f = panel_frames(spark, sf_dir, p)
    root = scratch_path(spark, "checked_models")

    @cache
    def staged() -> DataFrame:
        return spark.read.parquet(f"{root}/stg_combined")

    @cache
    def panel() -> DataFrame:
        return panel_frames(spark, sf_dir, p, materialised=True, staged=staged()).panel

    @cache
    def keyed() -> M.ModelParams:
        return M.with_key_seen(panel(), p)

    frames = {
        "stg_countries": lambda: f.countries,
        "stg_combined": lambda: f.staged,
        "stg_sovereign": lambda: M.stg_sovereign(staged(), f.countries),
        "dim_emissions": lambda: M.dim_emissions(panel()),
        "dim_socio": lambda: M.dim_socio(panel()),
        "dim_wellbeing": lambda: M.dim_wellbeing(panel()),
        "gdp_correlation": lambda: M.gdp_correlation(panel(), p),
        "country_profile": lambda: M.country_profile(panel(), None, p),
        "time_series": lambda: M.time_series(panel(), p),
        # Where the key is unique, countries are counted before the shuffle.
        "fct_region": lambda: M.fct_region(panel(), keyed()),
        "by_development": lambda: M.by_development(panel(), keyed()),
    }
    return build_and_check(spark, frames, root, DECLARED_NOT_NULL, DECLARED_UNIQUE, read_later=("stg_combined",))


# Columns that must not be NULL, and keys that must be unique.
DECLARED_NOT_NULL = {
    "stg_combined": ("country", "year", "school_enrollment"),
    "stg_countries": ("country_name", "alpha_3", "region"),
    "stg_sovereign": ("country", "year"),
    "dim_emissions": ("country", "year", "calculated_total_emissions"),
    "dim_socio": ("country", "year", "gini_index"),
    "dim_wellbeing": ("country", "year", "life_expectancy"),
    "fct_region": ("region", "year", "total_emissions"),
    "by_development": ("year", "income_category", "total_emissions"),
    "gdp_correlation": ("country", "year", "gdp_growth_pct"),
    "country_profile": ("year", "gini_index"),
    "time_series": ("country", "year"),
}
DECLARED_UNIQUE = {
    "stg_countries": (("alpha_3",), ("country_code", "alpha_2")),
    "fct_region": (("region", "year"),),
}


# ------------------------------------------- ordered, bucketed, published, listed


def ordered_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sub-region facts written in their order and read back with each row's place."""
    out = M.fct_subregion(panel_frames(spark, sf_dir, TEST_PARAMS, materialised=True).panel, TEST_PARAMS)
    order = [F.col("year").desc(), F.col("total_emissions").desc(), F.col("region"), F.col("sub_region")]
    path = scratch_path(spark, "in_order")
    W.write_ordered(out, path, order)
    if ORD.order_certificate(spark.read.parquet(path), order).where("inversions > 0 or not follows").count():
        raise RuntimeError(f"{path} is out of order")
    return ORD.read_in_order(spark, path)


def bucketed_time_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trends over a panel that is bucketed by country: its windows need no exchange."""
    panel = panel_frames(spark, sf_dir, TEST_PARAMS, materialised=True).panel
    name = "panel_by_country_" + scratch_path(spark, "name").rsplit("-", 1)[-1]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return M.time_series(W.save_bucketed(panel, name, "country", buckets, ["year"]), TEST_PARAMS)


def published_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The combined panel published, one corrected year published over it, and the newest version read."""
    combined = panel_frames(spark, sf_dir, TEST_PARAMS).combined
    root = scratch_path(spark, "published")
    V.publish_years(combined, root, "year", ["country"])
    reload = combined.where(F.col("year") == RELOAD_YEAR).withColumn("co2", F.col("co2") * 2)
    V.publish_years(reload, root, "year", ["country"], [RELOAD_YEAR])
    return V.read_published(spark, root).select(*combined.columns)


def combined_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file pipeline's tables merged and published, then one corrected year merged and published alone."""
    from panelyze.plans import file_pipeline as FP

    wb_root = _landed(spark, sf_dir, "wb_landing", _land_yearly_csv)
    ct_root = _landed(spark, sf_dir, "ct_landing", _land_emission_csv)
    wb = FP.process_indicators(spark, _year_folders(spark, wb_root), r"year=(\d{4})/", "_metadata.file_path")
    ct = FP.process_emissions(spark, _year_folders(spark, ct_root, "_y"), r"_y=(\d{4})/", "_metadata.file_path")
    root = scratch_path(spark, "reloaded")
    W.write_years(wb, f"{root}/indicators", "year", ["country"])
    W.write_years(ct, f"{root}/emissions", "year", ["country"])
    both = f"{root}/indicators", f"{root}/emissions"
    V.publish_years(FP.combine_tables(spark, *both), f"{root}/combined", "year", ["country"])
    fixed = spark.read.parquet(both[1]).where(F.col("year") == RELOAD_YEAR).withColumn("co2", F.col("co2") * 2)
    W.write_years(materialize(fixed, "fixed-year"), both[1], "year", ["country"])
    again = FP.combine_tables(spark, *both, years=[RELOAD_YEAR])
    V.publish_years(again, f"{root}/combined", "year", ["country"], [RELOAD_YEAR])
    return V.read_published(spark, f"{root}/combined")


def merge_fallbacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals and shipped totals merged where both, one or none of the two tables has rows or is there at all."""
    from panelyze.plans import file_pipeline as FP

    left = _by_key_year(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_totalprice")
    right = _by_key_year(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_shipdate", "l_extendedprice")
    root = scratch_path(spark, "sides")
    for name, df in (("left", left), ("right", right), ("left_empty", left.limit(0)), ("right_empty", right.limit(0))):
        W.write_parquet(df, f"{root}/{name}")
    cases = {
        "both": ("left", "right"),
        "left absent": ("absent", "right"),
        "left empty": ("left_empty", "right"),
        "right absent": ("left", "absent"),
        "right empty": ("left", "right_empty"),
        "both empty": ("left_empty", "right_empty"),
        "both absent": ("absent", "absent"),
    }
    out = []
    for case, (a, b) in cases.items():
        merged = FP.combine_tables(spark, f"{root}/{a}", f"{root}/{b}")
        names = [c for c in merged.columns if c in ("country", "year", "n") or c.startswith(("revenue", "n_"))]
        key = {"country": "long", "year": "int"}
        out.append(merged.select(F.lit(case).alias("case"), *[F.col(c).cast(key[c]) if c in key else F.col(c) for c in names]))
    return RS.concat_frames(out)


def _year_tables(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """Two year tables in the catalog, indicators by order year and emissions by ship year, and where the first one lies."""
    combined = panel_frames(spark, sf_dir, TEST_PARAMS).combined
    shipped = _lines_by_nation_year(spark, sf_dir)
    names, root = [], scratch_path(spark, "year_tables")
    for kind, df in (("indicators", combined), ("emissions", shipped)):
        path, name = f"{root}/{kind}", f"{kind}_" + scratch_path(spark, "name").rsplit("-", 1)[-1]
        W.write_years(df, path, "year", ["country"])
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        CAT.create_year_table(spark, name, path, ddl)
        # One reload after the other, as yearly jobs do.
        for year, folder in sorted(SRC.partition_folders(spark, path).items()):
            CAT.add_years(spark, name, {year: folder})
        names.append(name)
    return names[0], names[1], f"{root}/indicators"


def years_in_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The years that either of two registered sources holds, read from the catalog."""
    wb, ct, _ = _year_tables(spark, sf_dir)
    has = set(CAT.catalog_years(spark, wb)), set(CAT.catalog_years(spark, ct))
    rows = [(y, y in has[0], y in has[1]) for y in CAT.catalog_years(spark, wb, ct)]
    return spark.createDataFrame(rows, "year int, in_indicators boolean, in_emissions boolean")


def tables_per_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the combined table of all years beside the table of its own year."""
    name, _, path = _year_tables(spark, sf_dir)
    per_year = CAT.create_tables_per_year(spark, name, path)
    single = RS.concat_frames([spark.table(t).withColumn("year", F.lit(y)) for y, t in per_year.items()])
    both = spark.table(name).alias("a").join(
        single.alias("b"), F.col("a.country").eqNullSafe(F.col("b.country")) & (F.col("a.year") == F.col("b.year")), "full"
    )
    return both.select(
        F.col("a.country").alias("country"), F.col("a.year").alias("year"), F.col("a.co2").alias("co2"), F.col("b.co2").alias("co2_of_year")
    )


# ------------------------------------------------------------ seed and columns


def seed_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seed landed as CSV and read back, every column a string, the key first; an empty text comes back as NULL."""
    seed = panel_frames(spark, sf_dir, TEST_PARAMS).seed
    path = scratch_path(spark, "seed")
    W.write_csv(seed, path, skip_empty=False)
    back = CL.key_column_first(SRC.read_seed(spark, path), "alpha-3")
    return back.toDF(*[c.replace("-", "_") for c in back.columns])


def seed_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some columns of the landed seed as numbers; what is none becomes NULL."""
    return CL.cast_numeric(seed_dimension(spark, sf_dir), ["alpha_3", "country_code", "region", "absent"])


def emission_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The emissions dimension with its dates turned back to years."""
    dim = M.dim_emissions(panel_frames(spark, sf_dir, TEST_PARAMS, materialised=True).panel)
    return dim.select("country", date_to_year("year").alias("year"), M.TOTAL)


def landed_column_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and types of the columns of a landed indicator file."""
    root = _landed(spark, sf_dir, "wb_landing", _land_yearly_csv)
    return Q.column_name_report(spark.read.option("header", True).csv(SRC.partition_folders(spark, root)[str(RELOAD_YEAR)]))


def parquet_overwritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written, written again with other rows, and read."""
    combined = panel_frames(spark, sf_dir, TEST_PARAMS).combined
    path = scratch_path(spark, "overwritten")
    W.write_parquet(combined, path)
    W.write_parquet(combined.withColumn("co2", F.col("co2") * 2), path)
    return spark.read.parquet(path).select("country", "year", "co2")
