"""Published versions of a year-partitioned table.

A reload writes its years into a folder of its own (``run=<id>/year=YYYY``) and
then publishes a pointer, a small file that says which run holds each year.
Readers open the folders that the newest pointer names, so they see a reload
whole or not at all, and a reload that fails leaves nothing but a folder that
no pointer names.  Pointers are numbered; two reloads that finish at once
cannot both take one number, and the later one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from panelyze.sinks.writers import write_years
from panelyze.sources.files import partition_folders

# Spark's readers pass over names that begin with an underscore.
POINTERS = "_published"
RUN = "run"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _pointers(spark: SparkSession, root: str) -> list[int]:
    fs, path = _fs(spark, f"{root}/{POINTERS}")
    if not fs.exists(path):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(path)]
    return sorted(int(n[: -len(".json")]) for n in names if n.endswith(".json") and n[: -len(".json")].isdigit())


def published(spark: SparkSession, root: str, number: int | None = None) -> dict[str, str]:
    """``{year: run}`` of the newest pointer, or of pointer ``number``; empty before the first reload."""
    root = root.rstrip("/")
    numbers = _pointers(spark, root)
    if not numbers:
        return {}
    path = f"{root}/{POINTERS}/{numbers[-1] if number is None else number:08d}.json"
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


def publish_years(
    df: DataFrame, root: str, year_col: str = "year", sort_by: Sequence[str] = (), years: Sequence[int] | None = None
) -> int:
    """Write the years of ``df`` as a new run and publish it; other years keep the run they have.

    ``years`` names the years that are reloaded: one of them without rows in
    ``df`` is no longer published.  Returns the pointer's number.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    numbers = _pointers(spark, root)
    held = published(spark, root)
    run = uuid.uuid4().hex[:12]
    write_years(df, f"{root}/{RUN}={run}", year_col, sort_by)
    new = dict.fromkeys(partition_folders(spark, f"{root}/{RUN}={run}", year_col), run)
    gone = {str(y) for y in years or ()} - set(new)
    held = {y: r for y, r in held.items() if y not in gone} | new
    number = numbers[-1] + 1 if numbers else 1
    fs, final = _fs(spark, f"{root}/{POINTERS}/{number:08d}.json")
    _, draft = _fs(spark, f"{root}/{POINTERS}/_{run}")
    out = fs.create(draft, False)
    out.write(json.dumps(held, sort_keys=True).encode())
    out.close()
    # A rename onto an existing name fails: one reload takes the number.
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError(f"another reload of {root} was published meanwhile")
    return number


def read_published(
    spark: SparkSession, root: str, year_col: str = "year", years: Sequence[int] | None = None, number: int | None = None
) -> DataFrame | None:
    """The published years (all, or some of them); None where there are none.

    Only the folders of these years are listed.  A column that a later reload
    brought is NULL in earlier years.
    """
    root = root.rstrip("/")
    held = published(spark, root, number)
    wanted = held if years is None else {y: r for y, r in held.items() if y in {str(y) for y in years}}
    if not wanted:
        return None
    paths = [f"{root}/{RUN}={run}/{year_col}={year}" for year, run in sorted(wanted.items())]
    return spark.read.option("basePath", root).option("mergeSchema", True).parquet(*paths).drop(RUN)


def remove_unpublished(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Delete the runs that none of the newest ``keep`` pointers names, and older pointers; returns the runs deleted."""
    root = root.rstrip("/")
    numbers = _pointers(spark, root)
    named = {run for n in numbers[-keep:] for run in published(spark, root, n).values()}
    old = [path for run, path in partition_folders(spark, root, RUN).items() if run not in named]
    for path in old + [f"{root}/{POINTERS}/{n:08d}.json" for n in numbers[:-keep]]:
        fs, p = _fs(spark, path)
        fs.delete(p, True)
    return len(old)
