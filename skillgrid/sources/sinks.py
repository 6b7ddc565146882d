"""Sinks: warehouse tables (S11), temp views (S12) and CSV export."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from skillgrid.session import _filesystem


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Create-or-replace a Parquet table (the CTAS of the SQL build).

    The new table is written beside the old one and takes its place when it is
    whole, so a failing job leaves the old table, and a table may be rewritten
    from its own rows.
    """
    folder, _, name = path.rstrip("/").rpartition("/")
    staged = StagedTables(df.sparkSession, folder or ("/" if path.startswith("/") else "."))
    try:
        staged.write(df, name, partition_by)
    except BaseException:
        staged.discard()
        raise
    staged.publish()


class StagedTables:
    """Tables of one folder that are written aside and take their places together.

    ``publish`` moves each old table away and its successor in, one rename each
    (the old ones are deleted last); ``discard`` leaves all tables as they were.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.run = spark, folder.rstrip("/"), uuid.uuid4().hex[:12]
        self.names: list[str] = []

    def _path(self, kind: str, name: str = "") -> str:
        return f"{self.folder}/_{kind}-{self.run}/{name}".rstrip("/")

    def write(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        """Writes a table aside and returns it."""
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self._path("staged", name))
        if name not in self.names:
            self.names.append(name)
        return self.spark.read.parquet(self._path("staged", name))

    def publish(self) -> None:
        for name in self.names:
            fs, place = _filesystem(self.spark, f"{self.folder}/{name}")
            _, old = _filesystem(self.spark, self._path("retired", name))
            _, new = _filesystem(self.spark, self._path("staged", name))
            if fs.exists(place):
                fs.mkdirs(old.getParent())
                _rename(fs, place, old)
            _rename(fs, new, place)
        self.discard()
        fs, old = _filesystem(self.spark, self._path("retired"))
        fs.delete(old, True)

    def discard(self) -> None:
        """Deletes what is still aside."""
        fs, where = _filesystem(self.spark, self._path("staged"))
        fs.delete(where, True)


def _rename(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"{source} could not be moved to {target}")


def register(df: DataFrame, name: str) -> DataFrame:
    """Expose a frame to SQL under ``name``."""
    df.createOrReplaceTempView(name)
    return df


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header row and ',' delimiter, written as a folder of part files.

    ``single_file`` funnels the rows through one task; use it only for small
    outputs such as a skill catalogue, never for a table that grows with data.
    """
    out = df.repartition(1) if single_file else df  # the work before it keeps its tasks
    out.write.mode("overwrite").option("header", True).option("sep", ",").csv(path)
