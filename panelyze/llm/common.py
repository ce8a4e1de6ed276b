"""Helpers shared by the corpus operators: scratch tables, hashing, components."""

from __future__ import annotations

import gc

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelyze.session import scratch_path

# A word is a run of characters other than space and the ASCII controls 9-13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names`` with underscores behind them as far as the frame has columns of these names."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share, by the rule of ``session.checkpoint_root``."""
    return scratch_path(spark, f"corpus/{name}")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here.

    The shuffle files behind ``df`` are not needed any more.  Spark deletes
    them when the driver collects its garbage, which a long job with little to
    do on the driver may put off for half an hour, so it is asked to here.
    """
    spark, schema = df.sparkSession, df.schema
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    del df
    gc.collect()
    spark._jvm.System.gc()
    out = spark.read.schema(schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*saved: DataFrame) -> None:
    """Delete tables made by ``save`` that nothing reads any more."""
    for df in saved:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (bijective), vectorised."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def blocks(sizes: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Consecutive index ranges whose sizes sum to about ``limit`` (one item may exceed it)."""
    out, start, held = [], 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > limit:
            out.append((start, i))
            start, held = i, 0
        held += n
    if start < len(sizes):
        out.append((start, len(sizes)))
    return out


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(u, v)``: rows ``(node, root)``, root the smallest node.

    Alternating large-star and small-star rounds; every round's edges are
    written to the shared folder, so a lost executor re-reads files.  Only
    nodes that have an edge come out.  The per-node minimum is written before
    it is joined, so that a hub's rows can be split over tasks.
    """
    cur = save(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    seen = None
    for _ in range(max_rounds):
        both = cur.select("u", "v").unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = save(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # A node that is itself the minimum keeps no edge of its own.
        large = save(large.where("u <> v"), "large")
        low = save(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        pair = large.join(low, "u")
        small = (
            pair.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            .distinct()
        )
        cur = save(small, "edges")
        sign = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == seen:
            break
        seen = sign
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()
