"""Job-ad archive ingestion.

Yearly archives are zip files holding exactly one JSON-lines member. The
zip member is streamed in line batches by ``mapInPandas`` (one task per
archive, the only Python in the path), and every line is parsed by Spark's
JSON reader with one explicit schema. The occupation fields are a struct in
2022 archives and a list of structs in the others; they are read as VARIANT
and the label is taken from whichever shape is present, so one read covers
every year. The table is versioned by ``source_archive``
(``skillgrid.sources.versions``): a full rebuild or an append writes a new
version aside and publishes it whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skillgrid.functions.text import month_start
from skillgrid.session import list_files, row_group_option
from skillgrid.sources.binding import ADS_COLUMNS
from skillgrid.sources.versions import Staged, VersionedTable

BATCH_BYTES = 8 << 20  # characters of the lines that a task holds at once

_LABELS = "array<struct<label: string>>"
RAW_AD_SCHEMA = (
    "id string, publication_date string, headline string, "
    "description struct<text: string>, "
    "occupation variant, occupation_group variant, occupation_field variant, "
    f"must_have struct<skills: {_LABELS}>, nice_to_have struct<skills: {_LABELS}>, "
    "workplace_address struct<municipality: string, municipality_code: string, "
    "region: string, region_code: string, postcode: string, city: string, "
    "coordinates: array<double>>"
)
LINES_SCHEMA = T.StructType(
    [
        T.StructField("line", T.StringType()),
        T.StructField("source_archive", T.StringType()),
        T.StructField("source_year", T.IntegerType()),
    ]
)


# --- S3: discovery -----------------------------------------------------------
def archive_year(path: str | Path) -> int:
    """Year = leading integer of the file name (``2024.jsonl.zip`` -> 2024)."""
    name = Path(path).name
    m = re.match(r"(\d+)", name.split(".")[0])
    if not m:
        raise ValueError(f"archive name {name!r} does not start with a year")
    return int(m.group(1))


def archive_key(path: str | Path) -> str:
    """The archive's name in the table, the same for its zip and its plain lines: ``2024.jsonl.zip``."""
    name = Path(path).name
    return name if name.endswith(".zip") else f"{name}.zip"


def archive_paths(spark: SparkSession, raw_dir: str | Path, years: list[int] | None = None) -> list[str]:
    """Sorted ``*.jsonl.zip`` archives, listed through Spark's file systems, optionally only the given years.

    Raises FileNotFoundError for requested years without an archive, or when
    nothing is found at all.
    """
    paths = [p for p, _, _ in list_files(spark, f"{str(raw_dir).rstrip('/')}/*.jsonl.zip")]
    if years:
        wanted = set(years)
        paths = [p for p in paths if archive_year(p) in wanted]
        missing = sorted(wanted - {archive_year(p) for p in paths})
        if missing:
            raise FileNotFoundError(f"{raw_dir} holds no archive of the year(s) {missing}")
    if not paths:
        raise FileNotFoundError(f"{raw_dir} holds no *.jsonl.zip archive")
    return paths


# --- S2: zip member streaming -------------------------------------------------
def _archive_streamer(batch_bytes: int):
    """The per-archive reader shipped to Python workers.

    Defined as a closure so it is serialised by value: workers need only the
    standard library and pandas, not this package on their import path.
    """

    def stream(batches):
        import io
        import zipfile
        from pathlib import PurePath

        import pandas as pd

        for batch in batches:
            for path, year in zip(batch["path"], batch["source_year"], strict=True):
                path = path.removeprefix("file:")
                name = PurePath(path).name
                with zipfile.ZipFile(path) as archive:
                    members = [n for n in archive.namelist() if n.endswith(".jsonl")]
                    if len(members) != 1:
                        raise ValueError(f"{path} must hold one .jsonl member, it holds {len(members)}")
                    with archive.open(members[0]) as raw:
                        text = io.TextIOWrapper(raw, encoding="utf-8", errors="replace", newline="")
                        lines: list[str] = []
                        held = 0
                        for line in text:
                            line = line.rstrip("\r\n")
                            if line.strip():
                                lines.append(line)
                                held += len(line)
                            if held >= batch_bytes:
                                yield pd.DataFrame({"line": lines, "source_archive": name, "source_year": year})
                                lines, held = [], 0
                        if lines:
                            yield pd.DataFrame({"line": lines, "source_archive": name, "source_year": year})

    return stream


def read_archive_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(line, source_archive, source_year)`` rows from zip archives.

    Each archive is a partition of its own: one task streams its single JSONL
    member in batches bounded by their characters; nothing is unpacked to a
    local temp folder and no archive passes through the driver. A zip member
    can only be inflated from its start, so one archive is one task's work.
    Paths must be readable by the executors (a shared mount).
    """
    listing = spark.createDataFrame(
        spark.sparkContext.parallelize([(p, archive_year(p)) for p in paths], max(1, len(paths))),
        "path string, source_year int",
    )
    return listing.mapInPandas(_archive_streamer(BATCH_BYTES), LINES_SCHEMA)


def read_jsonl_lines(spark: SparkSession, path: str, source_archive: str, source_year: int) -> DataFrame:
    """Plain (already extracted) JSONL files: a splittable text scan; blank lines are no ads."""
    return spark.read.text(path).where(F.trim(F.regexp_replace("value", r"\s", " ")) != "").select(
        F.col("value").alias("line"),
        F.lit(source_archive).alias("source_archive"),
        F.lit(source_year).cast("int").alias("source_year"),
    )


# --- S1, S4, S5: parse and flatten ---------------------------------------------
def parse_ad_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Parse JSON lines with the explicit raw schema (PERMISSIVE).

    A malformed line becomes an all-NULL ad (the lineage columns survive), as
    the SQL loader's ``ignore_errors`` does; ``rejects`` separates them.
    """
    others = [c for c in lines.columns if c != line_col]
    parsed = lines.select(F.from_json(F.col(line_col), RAW_AD_SCHEMA).alias("ad"), *others).select("ad.*", *others)
    return parsed.withColumn("publication_date", wall_clock(F.col("publication_date")))


def wall_clock(text: Column) -> Column:
    """A date, a date and time, or an instant with a zone, as UTC wall-clock time; NULL if it is none.

    The session time zone is UTC (``SESSION_DEFAULTS``), so an instant's UTC
    reading is its cast; text without a zone is taken as it stands.
    """
    return F.try_to_timestamp(F.trim(text)).cast("timestamp_ntz")


def unreadable_dates(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Lines whose publication date is given but cannot be read."""
    given = F.get_json_object(line_col, "$.publication_date")
    return lines.where(given.isNotNull() & wall_clock(given).isNull())


def _label(v: Column) -> Column:
    """Label of a struct (2022 shape) or of a list's first element (other years)."""
    return F.coalesce(
        F.try_variant_get(v, "$[0].label", "string"), F.try_variant_get(v, "$.label", "string")
    )


def flatten_ads(parsed: DataFrame) -> DataFrame:
    """The 20-column ``historical_job_ads`` row from a parsed raw ad."""
    addr = F.col("workplace_address")
    return parsed.select(
        "id",
        "publication_date",
        month_start(F.col("publication_date")).alias("publication_month"),
        "headline",
        F.col("description.text").alias("description_text"),
        _label(F.col("occupation")).alias("occupation"),
        _label(F.col("occupation_group")).alias("occupation_group"),
        _label(F.col("occupation_field")).alias("occupation_field"),
        F.col("must_have.skills").alias("must_have_skills"),
        F.col("nice_to_have.skills").alias("nice_to_have_skills"),
        addr["municipality"].alias("municipality"),
        addr["municipality_code"].alias("municipality_code"),
        addr["region"].alias("region"),
        addr["region_code"].alias("region_code"),
        addr["postcode"].alias("postcode"),
        addr["city"].alias("city"),
        F.get(addr["coordinates"], 0).alias("longitude"),
        F.get(addr["coordinates"], 1).alias("latitude"),
        "source_archive",
        F.col("source_year").cast("int").alias("source_year"),
    )


def rejects(ads: DataFrame) -> DataFrame:
    """Rows that came from malformed lines (no id)."""
    return ads.where(F.col("id").isNull())


def raw_lines_from_ads(ads: DataFrame) -> DataFrame:
    """Nested raw JSON lines for a flattened ads frame, in both schema shapes.

    Half of the ids get the 2022 shape (occupation as a struct), the others a
    list of structs. Used to exercise the parser on data derived from the tables.
    """
    label = lambda c: F.struct(F.col(c).alias("label"))
    common = [
        F.col("id"),
        F.date_format("publication_date", "yyyy-MM-dd'T'HH:mm:ss").alias("publication_date"),
        F.col("headline"),
        F.struct(F.col("description_text").alias("text")).alias("description"),
    ]
    tail = [
        F.struct(F.col("must_have_skills").alias("skills")).alias("must_have"),
        F.struct(F.col("nice_to_have_skills").alias("skills")).alias("nice_to_have"),
        F.struct(
            *[F.col(c) for c in ("municipality", "municipality_code", "region", "region_code", "postcode", "city")],
            F.array(F.col("longitude"), F.col("latitude")).alias("coordinates"),
        ).alias("workplace_address"),
    ]
    occ = ["occupation", "occupation_group", "occupation_field"]
    as_struct = F.to_json(F.struct(*common, *[label(c).alias(c) for c in occ], *tail))
    as_list = F.to_json(F.struct(*common, *[F.array(label(c)).alias(c) for c in occ], *tail))
    even = F.crc32(F.coalesce(F.col("id"), F.lit("")).cast("binary")) % 2 == 0
    return ads.select(
        F.when(even, as_struct).otherwise(as_list).alias("line"),
        "source_archive",
        "source_year",
    )


# --- S6, S7: write ------------------------------------------------------------
def ads_table(spark: SparkSession, table_path: str) -> VersionedTable:
    """The ads table: one versioned part per archive."""
    return VersionedTable(spark, table_path, "source_archive")


def stage_ads(ads: DataFrame, table_path: str, covered: list[str] | None = None) -> Staged:
    """Writes a load aside, in one job; ``covered`` names its archives, those without rows included."""
    spark = ads.sparkSession
    return ads_table(spark, table_path).stage(ads.select(*ADS_COLUMNS), covered, row_group_option(spark))


def write_ads(ads: DataFrame, table_path: str) -> None:
    """Full rebuild: the table becomes exactly ``ads``, partitioned by archive."""
    stage_ads(ads, table_path).publish(whole=True)


def replace_archive(archive_ads: DataFrame, table_path: str, archive: str) -> None:
    """Replace one archive's rows (delete + insert of the SQL loader).

    Whatever the new load holds, possibly nothing, becomes the archive's
    content, and other archives are untouched. Reads the new load once; until
    it is written whole, readers see the old rows.
    """
    stage_ads(archive_ads.withColumn("source_archive", F.lit(archive)), table_path, [archive]).publish()


def replace_archives(ads: DataFrame, table_path: str, tags: dict[str, str] | None = None) -> None:
    """Replace every archive present in ``ads`` in one job and at once.

    For micro-batches, where each archive file arrives with its rows; a batch
    whose ``tags`` the table already bears is not published again.
    """
    stage_ads(ads, table_path).publish(tags=tags)


def read_ads_table(spark: SparkSession, table_path: str, version: int | None = None) -> DataFrame:
    """The ads table's newest version (or a given one), columns in table order; archive names are strings."""
    return ads_table(spark, table_path).read(version).select(*ADS_COLUMNS)


def stage_archives(
    spark: SparkSession,
    raw_dir: str,
    table_path: str,
    years: list[int] | None = None,
    watch: Callable[[DataFrame], DataFrame] | None = None,
) -> Staged:
    """Discover, read, flatten and write archives aside: every zip is read once, in one job for all of them.

    A zip that cannot be read raises here, with the table as it was. ``watch``
    may observe the ads on their way to the files.
    """
    paths = archive_paths(spark, raw_dir, years)
    ads = flatten_ads(parse_ad_lines(read_archive_lines(spark, paths)))
    return stage_ads(watch(ads) if watch else ads, table_path, [archive_key(p) for p in paths])


def load_archives(
    spark: SparkSession,
    raw_dir: str,
    table_path: str,
    years: list[int] | None = None,
    append: bool = False,
) -> DataFrame:
    """Load archives and return the written table.

    A rebuild makes the table exactly these archives; ``append`` replaces them
    and keeps the others. Either way all archives of the load become visible
    at once, when the last one is written; an archive that is now empty is
    cleared. A table that cannot be read is not appended to.
    """
    if append:
        check_readable(spark, table_path)
    stage_archives(spark, raw_dir, table_path, years).publish(whole=not append)
    return read_ads_table(spark, table_path)


def check_readable(spark: SparkSession, table_path: str) -> None:
    """Raises if a file of the table's newest version is damaged (every footer is read)."""
    manifest = ads_table(spark, table_path).manifest()
    folders = [f"{table_path.rstrip('/')}/{e.folder}" for e in manifest.entries if e.folder] if manifest else []
    if folders:
        spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(*folders).schema  # noqa: B018
