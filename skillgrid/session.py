"""Spark session settings and the shared folder for materialised stages."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Settings every job relies on: UTC wall-clock months, ANSI errors, and AQE
# (runtime broadcast of small aggregates, partition coalescing, skew splits).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Row-group size of a written ads table; a scan can split a file between row groups.
ROW_GROUP_SETTING = "spark.skillgrid.rowGroupBytes"


def job_session(app_name: str = "skillgrid") -> SparkSession:
    """Session of a submitted job: master, memory and partition numbers are the submitter's."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "skillgrid",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests, the bench and local runs on one machine (UI off, no server)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SKILLGRID_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config(ROW_GROUP_SETTING, str(1 << 20))
    )
    for key, value in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Pin the session settings the operators' semantics depend on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from the session (``SparkContext.getCheckpointDir`` or the
    ``spark.checkpoint.dir`` setting). Only a local-mode session without one
    gets a fresh private folder, as tests do; a cluster session must name it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a remote session: only the setting is visible
        if configured:
            return configured
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder") from None
    current = sc.getCheckpointDir()
    if current:
        return current
    current = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) so stages can be materialised"
            )
        current = tempfile.mkdtemp(prefix="skillgrid-ckpt-")
    sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def app_id(spark: SparkSession) -> str:
    """The application id (from the context, else from the session settings)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # a session without a reachable SparkContext
        return spark.conf.get("spark.app.id", "app")


def _filesystem(spark: SparkSession, path: str):
    """(file system, path) as Spark resolves them, for any store it can read."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there; any other trouble (access, timeout) raises."""
    fs, where = _filesystem(spark, path)
    return fs.exists(where)


def list_files(spark: SparkSession, pattern: str) -> list[tuple[str, int, int]]:
    """Sorted (path, bytes, modification time) of the files that match a glob, folders entered."""
    fs, where = _filesystem(spark, pattern)
    out = []
    for status in fs.globStatus(where) or []:
        found = fs.listFiles(status.getPath(), True)
        while found.hasNext():
            f = found.next()
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


def row_group_option(spark: SparkSession) -> dict[str, str]:
    """Writer option for tables whose text is scanned by CPU-heavy stages, if the session asks for one."""
    size = spark.conf.get(ROW_GROUP_SETTING, None)
    return {"parquet.block.size": size} if size else {}


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint root for one materialised table."""
    root = checkpoint_root(spark).rstrip("/")
    app = app_id(spark)
    return f"{root}/skillgrid-stages/{app}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(
    df: DataFrame, name: str, partition_by: list[str] | None = None, options: dict[str, str] | None = None
) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    This cuts lineage the way a warehouse table does: a lost executor only
    re-reads files, it never re-runs the upstream regex scan. The folder goes
    when the application ends.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    writer = df.write.mode("overwrite").options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    fs, where = _filesystem(spark, path)
    fs.deleteOnExit(where)
    # Read back with the writer's schema (data columns, then partition
    # columns): partition values keep their types (a boolean flag is not
    # re-inferred as a string); the select restores the column order.
    parts = set(partition_by or [])
    fields = [f for f in df.schema.fields if f.name not in parts]
    fields += [f for f in df.schema.fields if f.name in parts]
    return spark.read.schema(T.StructType(fields)).parquet(path).select(*df.columns)
