"""Readers for landed files: yearly CSV with drifting headers, Parquet, API
payloads (JSON), the country seed, and the year-list parameter."""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelyze.operators.clean import clean_columns
from panelyze.operators.reshape import concat_frames

YEAR_IN_NAME = r"(\d{4})(?=\.[A-Za-z0-9]+$)"


def partition_folders(spark: SparkSession, root: str, key: str = "year") -> dict[str, str]:
    """``{value: path}`` of the ``key=value`` folders directly under ``root``; empty where ``root`` is absent.

    One listing of folders; no file is listed, let alone opened.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{key}=*")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return {f.getPath().getName().split("=", 1)[1]: f.getPath().toString() for f in found if f.isDirectory()}


def discover_years(spark: SparkSession, *roots: str, key: str = "year") -> list[int]:
    """Years present as ``year=YYYY`` folders under any of ``roots`` (the
    union, so a year held by one source only is still processed)."""
    years = {v for root in roots for v in partition_folders(spark, root, key)}
    return sorted(int(v) for v in years if re.fullmatch(r"\d{4}", v))


def year_from_name(name_col: str = "_metadata.file_name", pattern: str = YEAR_IN_NAME):
    return F.regexp_extract(F.col(name_col), pattern, 1).try_cast("int")


def read_csv_file(
    spark: SparkSession, path: str, pattern: str = YEAR_IN_NAME, name_col: str = "_metadata.file_name"
) -> DataFrame | None:
    """One header CSV (or one folder of parts sharing a header), every column
    a string, plus ``_file_year`` parsed from the file name or path.

    Returns None for a file without columns (an empty frame written as a
    single newline): that year simply has no data.
    """
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    if not df.columns:
        return None
    return df.withColumn("_file_year", year_from_name(name_col, pattern))


# Larger than any file: a file is then one partition, and a partition one file.
_WHOLE_FILE = str(1 << 50)
# Files whose first lines one job reads.
_BUNCH = 64


def first_lines(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """``{file: first line}`` of every file under ``paths`` that has a line, read without the rest of the file.

    A limit ends a scan after its first row, so what is read of a file is one
    buffer, whatever its size.  A job takes a bunch of files, each in a task
    of its own; one short string of each reaches the driver.
    """
    own = spark.newSession()
    for name in ("maxPartitionBytes", "openCostInBytes"):
        own.conf.set(f"spark.sql.files.{name}", _WHOLE_FILE)
    # Listed as URIs, read as patterns.
    files = [re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(f)) for f in sorted(own.read.text(list(paths)).inputFiles())]
    out: dict[str, str] = {}
    for at in range(0, len(files), _BUNCH):
        ones = [
            own.read.text(f).select(F.lit(f).alias("file"), F.col("value").alias("line")).limit(1)
            for f in files[at : at + _BUNCH]
        ]
        out |= {r["file"]: r["line"] for r in reduce(DataFrame.union, ones).collect()}
    return out


def read_yearly_csv(
    spark: SparkSession,
    paths: Sequence[str],
    clean: bool = True,
    pattern: str = YEAR_IN_NAME,
    name_col: str = "_metadata.file_name",
) -> DataFrame | None:
    """Read yearly CSV files whose headers differ (order, missing columns).

    Reading all files in one call would map columns by position and shift
    values when the order changes.  So the first line of every file is read
    first (``first_lines``); files with the same header are read together in one scan, and
    the per-header frames are stacked by column *name*.  The parts of one
    folder may differ as well: headers are those of files, not of paths.  Names
    are cleaned (``clean_columns``) before stacking so ``SP.POP.TOTL`` and
    ``sp_pop_totl`` meet.  Absent paths and empty files are skipped; returns
    None when no file has data.
    """
    there = [p for p in paths if path_exists(spark, p)]
    if not there:
        return None
    by_header: dict[str, list[str]] = {}
    for file, line in first_lines(spark, there).items():
        if line.strip():
            by_header.setdefault(line, []).append(file)
    frames = []
    for group in by_header.values():
        # A file whose header is not the group's is an error, never shifted values.
        reader = spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False)
        df = reader.csv(group).withColumn("_file_year", year_from_name(name_col, pattern))
        frames.append(clean_columns(df) if clean else df)
    return concat_frames(frames) if frames else None


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or a pattern of paths, leads to anything."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def read_parquet(spark: SparkSession, path: str, years: Sequence[int] | None = None, year_col: str = "year") -> DataFrame:
    """Parquet with partition discovery; ``years`` prunes year partitions."""
    df = spark.read.parquet(path)
    if years:
        df = df.where(F.col(year_col).isin(list(years)))
    return df


def footer_rows(spark: SparkSession, path: str, years: Sequence[int] | None = None, year_col: str = "year") -> int:
    """Number of rows of a Parquet table (of some of its years) from the files' footers alone; 0 where it is absent.

    The count is pushed down to the footers, which Spark's newer Parquet
    source does; a session of its own turns that on.
    """
    if not path_exists(spark, path):
        return 0
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    df = own.read.parquet(path)
    if years:
        df = df.where(F.col(year_col).isin(list(years)))
    # A pushed-down count of no row groups comes back as NULL.
    return df.agg(F.count(F.lit(1))).first()[0] or 0


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """The country seed: header CSV, every column a string (leading zeros kept)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


# Record layouts of the two landed payload kinds.
INDICATOR_RECORD = T.StructType(
    [
        T.StructField("countryiso3code", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("indicator", T.StructType([T.StructField("id", T.StringType())])),
        T.StructField("date", T.StringType()),
    ]
)
EMISSION_RECORD = T.StructType(
    [
        T.StructField("country", T.StringType()),
        T.StructField("emissions", T.MapType(T.StringType(), T.DoubleType())),
    ]
)


def _payload_text(spark: SparkSession, path: str, whole_file: bool) -> DataFrame:
    """One document per line, or with ``whole_file`` one per file (which then must fit a task)."""
    return spark.read.text(path, wholetext=whole_file).select(
        F.col("value").alias("_doc"), F.col("_metadata.file_path").alias("_file")
    )


def indicator_records(docs: DataFrame, doc_col: str = "_doc") -> DataFrame:
    """``[metadata, [record, ...]]`` documents -> one row per record.

    Output: ``country, indicator, value, date, page, seq`` where ``page``
    comes from the document's metadata and ``seq`` is the record's position
    in its document (later records win on a duplicate).  A document with
    no second element yields no rows.
    """
    recs = F.from_json(F.get_json_object(F.col(doc_col), "$[1]"), T.ArrayType(INDICATOR_RECORD))
    page = F.get_json_object(F.col(doc_col), "$[0].page").try_cast("long")
    return docs.select("*", page.alias("_page"), F.posexplode_outer(recs).alias("seq", "_r")).where(
        F.col("_r").isNotNull()
    ).select(
        F.col("_r.countryiso3code").alias("country"),
        F.col("_r.indicator.id").alias("indicator"),
        F.col("_r.value").alias("value"),
        F.col("_r.date").alias("date"),
        F.col("_page").alias("page"),
        "seq",
        *[c for c in docs.columns if c != doc_col],
    )


def emission_records(docs: DataFrame, doc_col: str = "_doc") -> DataFrame:
    """``[{country, emissions: {gas: value}}, ...]`` documents -> one row per object.

    Items that are not objects are dropped (each item is parsed on its own,
    so one bad item does not void the document).
    """
    items = F.from_json(F.col(doc_col), T.ArrayType(T.StringType()))
    exploded = docs.select("*", F.posexplode_outer(items).alias("seq", "_item"))
    parsed = exploded.withColumn(
        "_r",
        F.when(F.ltrim(F.col("_item")).startswith("{"), F.from_json(F.col("_item"), EMISSION_RECORD)),
    ).where(F.col("_r").isNotNull())
    return parsed.select(
        F.col("_r.country").alias("country"),
        F.col("_r.emissions").alias("emissions"),
        "seq",
        *[c for c in docs.columns if c not in (doc_col,)],
    )


def read_indicator_payloads(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    return indicator_records(_payload_text(spark, path, whole_file))


def read_emission_payloads(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    return emission_records(_payload_text(spark, path, whole_file))


def parse_year_list(value: object, default: int | None = None) -> list[int]:
    """Years from a parameter: JSON array, ``[a, b]``/``a,b`` text, or one value.

    Non-integers are dropped; with nothing usable the default (current
    year unless given) is returned.
    """
    fallback = [default if default is not None else dt.date.today().year]
    if value is None:
        return fallback
    items: list
    if isinstance(value, (list, tuple)):
        items = list(value)
    elif isinstance(value, int):
        items = [value]
    else:
        text = str(value).strip()
        try:
            parsed = json.loads(text)
            items = parsed if isinstance(parsed, list) else [parsed]
        except ValueError:
            items = [s for s in re.split(r"[,\s]+", text.strip("[]")) if s]
    out = []
    for it in items:
        try:
            if isinstance(it, bool):
                continue
            if isinstance(it, float) and not it.is_integer():
                continue
            out.append(int(str(it).strip().strip("'\"")))
        except ValueError:
            continue
    return out or fallback


def register(df: DataFrame, name: str) -> DataFrame:
    """Named source / view (``createOrReplaceTempView``)."""
    df.createOrReplaceTempView(name)
    return df
