"""Row numbers, order certificates and ordered tables over range-partitioned rows.

A row number over a large group (all countries of a year, or a whole table)
does not need the group in one task.  Rows are dealt by ranges of the order,
sorted within each range, and written once with an id that counts rows within
the range; the number of rows in the ranges before, one small row for each
range and group, makes ids into row numbers:

    row number = id - first id of the group in the range + 1 + rows of the group in earlier ranges

The big table passes through one range exchange and no window.  What is joined
back has at most (ranges + groups) rows, so the planner may broadcast it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelyze.session import materialize, scratch_path

# Bits of monotonically_increasing_id below the partition number.
_ID_BITS = 33
ID, RANGE = "_id", "_range"


def range_sorted(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """``df`` dealt by ranges of ``order`` and sorted within each, with the row's ``ID``.

    Ranges follow each other in the order of their numbers.  Write the frame
    before it is read twice: ids belong to one dealing of the rows.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.withColumn(ID, F.monotonically_increasing_id())


def range_of(id_col: str = ID) -> Column:
    return F.shiftright(id_col, _ID_BITS)


def range_bases(written: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """``(RANGE, *group, _base)``: what is added to an id to make it the row number in its group."""
    counts = written.groupBy(range_of().alias(RANGE), *group).agg(F.min(ID).alias("_first"), F.count(F.lit(1)).alias("_n"))
    # One row for each range and group.
    before = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = before.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("_n").over(before), F.lit(0))
    return counts.select(RANGE, *group, (ahead - F.col("_first") + 1).alias("_base"))


def with_row_numbers(written: DataFrame, out: str, group: Sequence[str] = ()) -> DataFrame:
    """A written ``range_sorted`` table with the row number ``out`` within ``group`` in place of its id.

    NULL is a group like any other.
    """
    bases = range_bases(written, group)
    keys = [f"_g{i}" for i in range(len(group))]
    bases = bases.select(F.col(RANGE).alias("_of"), *[F.col(g).alias(k) for g, k in zip(group, keys)], "_base")
    same = range_of() == F.col("_of")
    for g, k in zip(group, keys):
        same = same & F.col(g).eqNullSafe(F.col(k))
    numbered = written.join(bases, same).withColumn(out, F.col(ID) + F.col("_base"))
    return numbered.drop(ID, "_of", "_base", *keys)


def top_row_numbers(
    df: DataFrame, group: Sequence[str], entity: str, metrics: Mapping[str, str], by: Sequence[str], n: int
) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY group ORDER BY metric DESC NULLS LAST, entity)`` for every metric.

    Returns ``(*group, entity, *metrics)`` of the rows that one of the numbers
    named in ``by`` puts at ``n`` or before, at most ``n * len(by)`` rows of
    each group, numbered among all rows of ``df``.  One narrow row for each
    metric and row is dealt by ranges; the result is written, so this runs
    when the plan is built.  ``(group, entity)`` must be unique.
    """
    each = [F.struct(F.lit(o).alias("_o"), F.col(m).cast("double").alias("_v")) for o, m in metrics.items()]
    long = df.select(*group, entity, F.explode(F.array(*each)).alias("_s")).select(*group, entity, "_s.*")
    order = [*[F.col(g) for g in group], F.col("_o"), F.col("_v").desc_nulls_last(), F.col(entity)]
    written = materialize(range_sorted(long, order).drop("_v"), "ranges")
    ranked = with_row_numbers(written, "_rank", [*group, "_o"])
    keys = [*group, entity]
    chosen = ranked.where(F.col("_o").isin(list(by)) & (F.col("_rank") <= n)).select(*keys).distinct()
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    few = ranked.alias("r").join(chosen.alias("c"), same, "left_semi")
    wide = few.groupBy(*keys).pivot("_o", list(metrics)).agg(F.first("_rank").cast("int"))
    return materialize(wide, "row-numbers")


def write_in_order(df: DataFrame, path: str, order: Sequence[str | Column]) -> None:
    """A table in global order: one file for each range of ``order``, each sorted, with the row's ``ID``."""
    range_sorted(df, order).write.mode("overwrite").parquet(path)


def read_in_order(spark: SparkSession, path: str, ordinal: str = "ordinal") -> DataFrame:
    """A table of ``write_in_order`` with every row's place in the order, from 1 on."""
    return with_row_numbers(spark.read.parquet(path), ordinal)


def order_certificate(written: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """``(range, n_rows, inversions, follows)`` of a written ``range_sorted`` table: proof that it is in order.

    ``inversions`` counts neighbours within a range that stand the wrong way
    round, ``follows`` says whether the range's first key is not before the
    last key of the range before.  Neither looks at more than one range at a
    time: each range is read by id, and only its ends meet those of its
    neighbours.
    """
    # The place of a row among its range's rows if sorted anew tells the order without a comparator of its own.
    # Rows that tie in the order keep their ids' order.
    anew = Window.partitionBy(RANGE).orderBy(*order, F.col(ID))
    local = written.withColumn(RANGE, range_of()).withColumn("_at", F.row_number().over(anew))
    first = F.min(ID).over(Window.partitionBy(RANGE))
    local = local.withColumn("_off", (F.col(ID) - first + 1 != F.col("_at")).cast("int"))
    inside = local.groupBy(RANGE).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("_off").alias("inversions"), F.min(ID).alias("_lo"), F.max(ID).alias("_hi")
    )
    # Two rows for each range: its ends, ranked among all ends.
    ends = written.withColumn(RANGE, range_of()).join(
        inside.select(F.col(RANGE).alias("_r"), "_lo", "_hi"), F.col(RANGE) == F.col("_r")
    )
    ends = ends.where((F.col(ID) == F.col("_lo")) | (F.col(ID) == F.col("_hi")))
    placed = ends.withColumn("_by_key", F.row_number().over(Window.orderBy(*order, F.col(ID))))
    placed = placed.withColumn("_by_id", F.row_number().over(Window.orderBy(ID)))
    follows = placed.groupBy(RANGE).agg(F.min(F.col("_by_key") == F.col("_by_id")).alias("follows"))
    return inside.join(follows, RANGE).select(F.col(RANGE).alias("range"), "n_rows", "inversions", "follows")


def ordered_table(df: DataFrame, name: str, order: Sequence[str | Column], ordinal: str = "ordinal") -> DataFrame:
    """``df`` written in order under the shared folder and read back with its ordinals; an error if it is not in order."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    write_in_order(df, path, order)
    proof = order_certificate(spark.read.parquet(path), order)
    bad = proof.where((F.col("inversions") > 0) | ~F.col("follows")).count()
    if bad:
        raise RuntimeError(f"{bad} ranges of {path} are out of order")
    return read_in_order(spark, path, ordinal)
