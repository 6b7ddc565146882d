"""Archive ingestion that sees files changed in place, with a table of rejected lines.

A file stream knows files by path, so a file that is delivered again under the
same path is not read again. Here a landing log stands in between: every scan
of the landing folder appends the deliveries it has not logged yet, keyed by
path, length and modification time, and the stream reads the log
(``availableNow``, exactly once per log entry). Each micro-batch reads the
logged files' lines, publishes one version of the ads table that replaces their
archives, and one of the rejects table: lines that are no JSON object, with
their archive. Both versions bear the batch's number, so a replay changes
nothing.

Of several deliveries of one archive in a batch, the newest counts (ties: the
last path). A file that changes again before its batch is read counts as it is
read then; the next scan logs that delivery, too, and reads it once more. Only
file names pass through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skillgrid.session import checkpoint_root, list_files, path_exists
from skillgrid.sources import archives
from skillgrid.sources.versions import VersionedTable

LOG_SCHEMA = "path string, length long, modified long"


def log_deliveries(spark: SparkSession, landing: str, log_path: str) -> int:
    """Appends the landing folder's deliveries that the log does not have; returns their number.

    ``landing`` is a folder or a glob; hidden files are no deliveries.
    """
    found = [f for f in list_files(spark, landing) if not f[0].rsplit("/", 1)[-1].startswith(("_", "."))]
    listed = spark.createDataFrame(found, LOG_SCHEMA)
    if path_exists(spark, log_path):
        listed = listed.join(spark.read.schema(LOG_SCHEMA).parquet(log_path), ["path", "length", "modified"], "left_anti")
    new = listed.collect()  # file names, as the listing itself
    if new:
        spark.createDataFrame(new, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(log_path)
    return len(new)


def rejects_table(spark: SparkSession, path: str) -> VersionedTable:
    """(line, source_year, source_archive): malformed lines, a versioned part per archive."""
    return VersionedTable(spark, path, "source_archive")


def _newest(files: list) -> list:
    """One delivery per archive."""
    newest: dict[str, tuple] = {}
    for f in files:
        key = archives.archive_key(f.path)
        newest[key] = max(newest.get(key, (-1, "")), (f.modified, f.path))
    return [(key, path) for key, (_, path) in sorted(newest.items())]


def _load(table_path: str, rejects_path: str, stream: str):
    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        deliveries = _newest(batch.collect())  # file names
        if not deliveries:
            return
        names = spark.createDataFrame([(p, k, archives.archive_year(p)) for k, p in deliveries], "path string, source_archive string, source_year int")
        text = spark.read.text([p for _, p in deliveries]).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("path"))
        text = text.where(F.trim(F.regexp_replace("line", r"\s", " ")) != "")
        # Paths as the scan and as the listing write them may differ in escapes; archive names do not.
        named = text.withColumn("file", F.element_at(F.split("path", "/"), -1)).drop("path")
        files = names.select(F.regexp_replace(F.element_at(F.split("path", "/"), -1), " ", "%20").alias("file"), "source_archive", "source_year")
        lines = named.join(F.broadcast(files), "file").drop("file")  # one row per file of the batch
        covered, tags = [k for k, _ in deliveries], {stream: str(epoch)}
        bad = lines.where(F.expr("try_parse_json(line) is null or schema_of_variant(try_parse_json(line)) not like 'OBJECT%'"))
        rejects_table(spark, rejects_path).stage(bad.select("line", "source_year", "source_archive"), covered).publish(tags=tags)
        archives.stage_ads(archives.flatten_ads(archives.parse_ad_lines(lines)), table_path, covered).publish(tags=tags)

    return write


def start_landing_stream(
    spark: SparkSession, landing: str, table_path: str, rejects_path: str, state: str | None = None
) -> StreamingQuery:
    """Logs new deliveries and starts the stream over the log; returns the running query (await it)."""
    location = (state or f"{checkpoint_root(spark).rstrip('/')}/skillgrid-streams/landing").rstrip("/")
    log_path = f"{location}/log"
    log_deliveries(spark, landing, log_path)
    if not path_exists(spark, log_path):
        spark.createDataFrame([], LOG_SCHEMA).write.parquet(log_path)
    entries = spark.readStream.schema(LOG_SCHEMA).parquet(log_path)
    writer = entries.writeStream.foreachBatch(_load(table_path, rejects_path, location))
    return writer.option("checkpointLocation", f"{location}/checkpoint").trigger(availableNow=True).start()
