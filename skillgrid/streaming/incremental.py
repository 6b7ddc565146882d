"""Incremental archive ingestion with Structured Streaming.

The replace-by-archive load (S7) as a stream over a landing folder of JSON
lines files (one file per archive). ``trigger(availableNow=True)`` processes
every file not yet seen and stops, so a scheduler can run it like a batch
job; the checkpoint (in the shared checkpoint folder) records which files
are done. Each micro-batch publishes one version of the table that replaces
exactly the archives it contains; the version bears the batch's number, so a
replayed batch publishes nothing new. A file is never split across
micro-batches, so an archive is written whole.

Archives have the key of the batch load (``2024.jsonl`` is ``2024.jsonl.zip``
in the table), so loading a year both ways does not double it. Files are told
apart by path: a new delivery of an archive is seen when it lands under a new
path (``landing/<delivery>/2024.jsonl`` with a glob as the landing folder), and
of several in one batch the last by path counts. A file changed in place, under
the same path, is not read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skillgrid.session import checkpoint_root
from skillgrid.sources import archives


def _replace_batch(table_path: str, stream: str):
    def write(batch: DataFrame, epoch: int) -> None:
        # One path per archive: a small table next to the lines.
        last = batch.groupBy("source_archive").agg(F.max("path").alias("path"))
        ads = archives.flatten_ads(archives.parse_ad_lines(batch.join(last, ["source_archive", "path"]).drop("path")))
        archives.replace_archives(ads, table_path, {stream: str(epoch)})

    return write


def start_archive_stream(
    spark: SparkSession,
    landing_dir: str,
    table_path: str,
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the ingestion stream; returns the running query (await it)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = (
        reader.load(landing_dir)
        .select(
            F.col("value").alias("line"),
            F.concat(F.col("_metadata.file_name"), F.lit(".zip")).alias("source_archive"),
            F.col("_metadata.file_path").alias("path"),
        )
        .where(F.trim(F.regexp_replace("line", r"\s", " ")) != "")
        .withColumn(
            "source_year",
            F.regexp_extract(F.col("source_archive"), r"^(\d+)", 1).cast("int"),
        )
    )
    location = checkpoint or f"{checkpoint_root(spark).rstrip('/')}/skillgrid-streams/archives"
    return (
        lines.writeStream.foreachBatch(_replace_batch(table_path, location))
        .option("checkpointLocation", location)
        .trigger(availableNow=True)
        .start()
    )
