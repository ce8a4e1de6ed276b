"""Session helpers: defaults for scale, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants; a cluster's own values for parallelism are left alone.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Replace only the partitions a write touches (year-by-year reloads).
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = 8, app: str = "panelyze") -> SparkSession:
    """Session for tests and local runs (UI off, AQE on)."""
    b = SparkSession.builder.master(master).appName(app).config("spark.ui.enabled", "false")
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    for k, v in SESSION_DEFAULTS.items():
        spark.conf.set(k, v)
    return spark


# Chosen by ``use_scratch_root``, or made once on a single machine.
_ROOT: list[str] = []
_WRITTEN: list[str] = []


def use_scratch_root(path: str) -> None:
    """Name the shared folder for sessions in which ``spark.checkpoint.dir`` is unset."""
    _ROOT[:] = [path]


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    ``spark.checkpoint.dir`` of the session, else the folder given to
    ``use_scratch_root``.  With neither, a session on one machine (``local``
    master, as in tests) gets a temporary folder; on a cluster that would not
    be shared, so it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or (_ROOT[0] if _ROOT else None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir (or call use_scratch_root) to a folder that all executors share")
    use_scratch_root(tempfile.mkdtemp(prefix="panelyze-scratch-"))
    return _ROOT[0]


def remove_scratch(spark: SparkSession) -> None:
    """Delete every scratch table that this process wrote."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(conf).delete(path, True)


def input_version(spark: SparkSession, paths: list[str]) -> tuple | None:
    """Newest modification time and size of each input; None where the store keeps no times."""
    jvm, conf, out = spark._jvm, spark._jsc.hadoopConfiguration(), []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if not fs.exists(path):
            out.append((p, -1, -1))
            continue
        status = fs.getFileStatus(path)
        files = list(fs.listStatus(path)) if status.isDirectory() else [status]
        newest = max([f.getModificationTime() for f in files] + [status.getModificationTime()])
        if newest <= 0:
            return None
        out.append((p, newest, sum(f.getLen() for f in files)))
    return tuple(out)


def session_id(spark: SparkSession) -> str:
    """An identifier of the running application (for per-session caches)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint root for one written table."""
    path = f"{checkpoint_root(spark)}/panelyze/{name}-{uuid.uuid4().hex[:12]}"
    _WRITTEN.append(path)
    return path


def materialize(
    df: DataFrame,
    name: str,
    partition_by: list[str] | None = None,
    sort_within: list[str] | None = None,
) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    This cuts lineage (a lost executor re-reads files instead of recomputing
    the whole plan) and lets later jobs prune on ``partition_by``.  Sorting
    within each task by ``sort_within`` (starting with the partition
    columns, which the writer needs anyway) clusters rows so Parquet min/max
    statistics skip row groups on those keys.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.parquet(path)
