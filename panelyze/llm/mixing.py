"""Mixing sources to target weights by systematic sampling.

Every document of a source expects ``target / source_size`` copies.  The
documents of a source stand in order of size, the expected copies are summed
along that order, one offset in [0, 1) is added per source, and a document is
emitted once for each integer that its stretch of the sum crosses.  Because
documents of like size are neighbours, the words taken stay within about one
document of the target.

Scale: only ids, sources and sizes are shuffled.  The order is made by range
partitioning, so a source that holds a third of all rows spreads over many
tasks; positions are a running number inside each range plus the counts of the
ranges before it.

Defined cases: a null or empty text has size 0 and takes nothing; a null source
is a source of its own, last in the order of weights; rows that repeat are
mixed as separate documents; an empty table gives an empty result; further
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelyze.llm.common import WORD, free_names, save, shuffle_parts, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``(source, n, source_size)`` with ``target``: one row per source.

    Weights repeat along the sources in code-point order, null last.  A source
    whose weighted part exceeds ``cap`` times its size stops there and the
    excess goes to the others by weight: sources sorted by capacity per weight
    are full up to the point where an equal level serves the rest.
    """
    one = W.partitionBy(F.lit(0))
    pos = F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (pos % len(weights) + 1).cast("int"))
    s = sizes.withColumn("weight", weight).withColumn("room", F.lit(cap) * F.col("source_size"))
    total = F.lit(share) * F.sum("source_size").over(one)
    by_level = one.orderBy(F.col("room") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("room").over(by_level.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(by_level.rowsBetween(W.currentRow, W.unboundedFollowing))
    s = s.withColumn("total", total).withColumn("full", F.col("room") / F.col("weight") <= (total - before) / left)
    kept = F.sum(F.when(F.col("full"), F.col("room")).otherwise(0.0)).over(one)
    open_weight = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(one)
    level = F.try_divide(F.col("total") - kept, open_weight)
    target = F.when(F.col("full"), F.col("room")).otherwise(level * F.col("weight"))
    return s.select("source", "n", "source_size", target.alias("target"))


def offset(source):
    """The one offset of a source, in [0, 1), from its name."""
    key = F.md5(F.concat(F.lit("mix:"), F.coalesce(source, F.lit("\x00"))))
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Rows ``(doc_id, source, size, source_size, target, copies, taken)``, one per document."""
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    ordered = (
        docs.select("doc_id", "source", size.alias("size"))
        .repartitionByRange(shuffle_parts(spark), "source", "size", "doc_id")
        .withColumn("part", F.spark_partition_id())
    )
    base = save(ordered, "mix-ranges")
    per_part = save(
        base.groupBy("source", "part").agg(F.count("*").alias("rows"), F.sum("size").alias("words")), "mix-parts"
    )
    per_source = per_part.groupBy("source").agg(F.sum("rows").alias("n"), F.sum("words").alias("source_size"))
    targets = source_targets(per_source, weights, share, cap)
    running = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    heads = per_part.select(
        "source", "part", F.coalesce(F.sum("rows").over(running), F.lit(0)).alias("head")
    )
    plan = heads.alias("h").join(targets.alias("t"), F.expr("h.source <=> t.source")).select(
        "h.source", "part", "head", "source_size", "target"
    )
    local = F.row_number().over(W.partitionBy("part", "source").orderBy("size", "doc_id"))
    ranked = base.withColumn("local", local)
    out = ranked.alias("r").join(save(plan, "mix-plan").alias("p"), F.expr("r.part = p.part and r.source <=> p.source"))
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    rank = (F.col("head") + F.col("local")).cast("double")
    u = offset(F.col("r.source"))
    copies = (F.floor(rank * rate + u) - F.floor((rank - 1) * rate + u)).cast("long")
    return out.select(
        "doc_id",
        F.col("r.source").alias("source"),
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def emit(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents themselves, each row repeated by its copies (repeated ids are matched in order)."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    nth, times, copy = free_names(docs, "nth", "times", "copy")
    same = W.partitionBy("doc_id").orderBy("source", "size")
    left = docs.withColumn(nth, F.row_number().over(W.partitionBy("doc_id").orderBy("source", size)))
    right = mixed.select("doc_id", "source", "size", "copies").withColumn("nth", F.row_number().over(same))
    right = right.where("copies > 0").select("doc_id", "nth", "copies")
    wide = left.alias("l").join(right.alias("r"), F.expr(f"l.doc_id <=> r.doc_id and l.{nth} = r.nth"))
    wide = wide.select(*[F.col(f"l.`{c}`") for c in docs.columns], F.col("r.copies").alias(times))
    return wide.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), times))).select(*docs.columns)


def op3_systematic_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), per_source AS (
  SELECT source, SUM(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, [5.0, 2.0, 1.0][((ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
         2.0::DOUBLE * source_size AS room
  FROM per_source
), levels AS (
  SELECT *, 1.5::DOUBLE * SUM(source_size) OVER ()::DOUBLE AS total,
         COALESCE(SUM(room) OVER (ORDER BY room / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier,
         SUM(weight) OVER (ORDER BY room / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS remaining
  FROM weighted
), marked AS (
  SELECT *, room / weight <= (total - earlier) / remaining AS is_full FROM levels
), targets AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN room
              ELSE (total - SUM(CASE WHEN is_full THEN room ELSE 0 END) OVER ())
                   / NULLIF(SUM(CASE WHEN is_full THEN 0 ELSE weight END) OVER (), 0) * weight END AS target
  FROM marked
), ranked AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         ROW_NUMBER() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id)::DOUBLE AS rank,
         CASE WHEN t.source_size = 0 THEN 0 ELSE t.target / t.source_size END AS rate,
         ('0x' || substr(md5('mix:' || COALESCE(s.source, chr(0))), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       ((floor(rank * rate + u) - floor((rank - 1) * rate + u))::BIGINT * size)::BIGINT AS taken
FROM ranked
"""
