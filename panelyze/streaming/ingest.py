"""Incremental ingestion of yearly files with Structured Streaming.

A file-source stream picks up every newly landed file and tells which years
have news.  A micro-batch replaces each of these years whole, with what its
landing folder holds at that moment (dynamic partition overwrite of a target
partitioned by year).  So a year may land in any number of files and batches,
and a year that lands again takes the place of what it was, under whatever file
names; files that were taken away no longer count.  A batch that runs again
writes the same, and the stream's checkpoint records which files were seen, so
a restart after a lost executor or driver continues where it stopped.

Run it as a scheduled job with ``trigger(availableNow=True)``: it takes all
files present, then stops.  ``max_files`` bounds a batch of a large backfill; a
year that spans several batches is written by each of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelyze.session import scratch_path
from panelyze.sinks.writers import write_years


def yearly_stream(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    fmt: str = "parquet",
    year_col: str = "year",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Streaming DataFrame over yearly files landed under ``landing``.

    A file without a ``year`` column gets it from a ``year=YYYY`` folder or a
    four-digit year in its name.
    """
    return _yearly(spark.readStream, landing, schema, fmt, year_col, options)


def _yearly(reader, landing: str, schema: StructType, fmt: str, year_col: str, options: dict[str, str] | None) -> DataFrame:
    """The landed files, as a stream or as they are now, with the year of each row."""
    df = reader.format(fmt).schema(schema).options(**(options or {})).load(landing)
    if year_col not in schema.fieldNames():
        path = F.col("_metadata.file_path")
        from_dir = F.regexp_extract(path, r"year=(\d{4})", 1)
        from_name = F.regexp_extract(F.col("_metadata.file_name"), r"(\d{4})(?=\.[A-Za-z0-9]+$)", 1)
        year = F.when(from_dir != "", from_dir).otherwise(from_name).try_cast("int")
        df = df.withColumn(year_col, year)
    return df


def ingest_years(
    spark: SparkSession,
    landing: str,
    target: str,
    schema: StructType,
    fmt: str = "parquet",
    year_col: str = "year",
    sort_by: Sequence[str] = (),
    checkpoint: str | None = None,
    options: dict[str, str] | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Run the ingestion stream until the landed files are taken, then return
    the target table.  ``checkpoint`` defaults to a folder under
    ``spark.checkpoint.dir``; pass a fixed one to resume across runs."""
    ckpt = checkpoint or scratch_path(spark, "ingest-checkpoint")
    bounded = {**(options or {}), "maxFilesPerTrigger": str(max_files)} if max_files else options
    stream = yearly_stream(spark, landing, schema, fmt, year_col, bounded)

    def replace_years(batch: DataFrame, batch_id: int) -> None:
        # A row for each year of the batch.
        news = [r[0] for r in batch.select(year_col).distinct().collect()]
        if news:
            now = _yearly(spark.read, landing, schema, fmt, year_col, options)
            dated = F.col(year_col).isin([y for y in news if y is not None])
            now = now.where(dated | F.col(year_col).isNull() if None in news else dated)
            write_years(now, target, year_col, sort_by)

    query = (
        stream.writeStream.foreachBatch(replace_years)
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return spark.read.parquet(target)
