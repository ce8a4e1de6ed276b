"""Column-name cleaning, typing and derived columns for landed yearly files."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelyze.functions.numeric import safe_divide


def clean_name(name: str, dots: bool = True) -> str:
    """Lower-case; space (and dot) -> underscore; then strip."""
    out = name.lower().replace(" ", "_")
    if dots:
        out = out.replace(".", "_")
    return out.strip()


def clean_columns(df: DataFrame, dots: bool = True) -> DataFrame:
    """Rename every column with ``clean_name``; two names that clean to the
    same result raise instead of silently shadowing each other."""
    new = [clean_name(c, dots) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValueError(f"columns {seen[n]!r} and {old!r} both clean to {n!r}")
        seen[n] = old
    return df.toDF(*new)


def cast_numeric(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Cast the named columns that exist to double; unparseable -> NULL."""
    present = [c for c in cols if c in df.columns]
    if not present:
        return df
    return df.withColumns({c: F.col(f"`{c}`").try_cast("double") for c in present})


def cast_numeric_except(df: DataFrame, keep: Sequence[str] = ("country",)) -> DataFrame:
    """Cast every column except ``keep`` to double, in one projection."""
    return df.select(
        *[F.col(f"`{c}`") if c in keep else F.col(f"`{c}`").try_cast("double").alias(c) for c in df.columns]
    )


def ensure_year(df: DataFrame, year_col: str = "year", from_name: str = "_file_year") -> DataFrame:
    """Integer ``year``: cast the column if present, else take ``from_name``
    (the year parsed from the file name, see ``sources.files``)."""
    if year_col in df.columns:
        year = F.col(year_col).try_cast("double").cast("int")
        if from_name in df.columns:
            year = F.coalesce(year, F.col(from_name))
        return df.withColumn(year_col, year)
    if from_name in df.columns:
        return df.withColumn(year_col, F.col(from_name).cast("int"))
    raise ValueError(f"no {year_col!r} column and no {from_name!r} to derive it from")


def derive_product(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """``out = a * b`` when both inputs exist, else unchanged."""
    if a in df.columns and b in df.columns:
        return df.withColumn(out, F.col(a) * F.col(b))
    return df


def derive_share(df: DataFrame, part: str, total: str, out: str) -> DataFrame:
    """``out = part / total * 100`` (NULL for a zero total) when both exist."""
    if part in df.columns and total in df.columns:
        return df.withColumn(out, safe_divide(part, total) * 100)
    return df


def key_column_first(df: DataFrame, key: str = "country") -> DataFrame:
    if key not in df.columns:
        return df
    return df.select(key, *[c for c in df.columns if c != key])


def dotted_names(df: DataFrame) -> list[str]:
    """Column names that contain a dot (need backticks until cleaned)."""
    return [c for c in df.columns if "." in c]
