r"""Stage tables for one input folder, built lazily and materialised once.

Mirrors the table DAG of the original pipeline:

    ads -> regex matches -> regex skills -> monthly counts -> trends
        \-> provided-label skills         \-> geography
                                           \-> QA summary / samples

The ads table, the expensive stages (the regex scans over all ad text:
taxonomy matches and per-ad skill lists), the compact skills and the two marts
the exploration queries read are written as Parquet under the session's
checkpoint folder, so later queries re-read files instead of re-scanning text,
and a lost executor never forces a re-scan. Cheap projections and aggregates
stay lazy. A warehouse belongs to the state of its input files: when one of
them changes, the next call builds another.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillgrid.functions.taxonomy import taxonomy_frame
from skillgrid.operators import anchor_join, distinct_bitmaps, extract, incremental_marts, marts, qa
from skillgrid.session import app_id, apply_defaults, list_files, materialize, row_group_option, stage_path
from skillgrid.sources import archives, binding, tables
from skillgrid.sources.versions import VersionedTable

_LOCK = threading.Lock()
_CACHE: dict[tuple, SkillWarehouse] = {}


# Stages that the data tests know by their warehouse names.
TEST_NAMES = {
    "ads": "historical_job_ads",
    "regex_skills": "historical_regex_skills",
    "trends": "mart_dashboard_skill_trends",
    "geography": "mart_skill_geography",
}


class SkillWarehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, materialize_stages: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.materialize_stages = materialize_stages
        self._tables: dict[str, DataFrame] = {}
        self._tests = qa.ObservedTests()
        self._incremental: incremental_marts.IncrementalMarts | None = None

    def _stage(self, name: str, build, keep: bool, options: dict[str, str] | None = None) -> DataFrame:
        if name not in self._tables:
            df = build()
            if keep and self.materialize_stages:
                df = materialize(self._tests.watch(TEST_NAMES.get(name, name), df), name, options=options)
            self._tables[name] = df
        return self._tables[name]

    # --- sources -------------------------------------------------------
    def marked_ads(self) -> DataFrame:
        """The ads with their alias bits, written once: the only scan of all text for anchors.

        Small row groups, where the session asks for them, let the text scans split it.
        """
        return self._stage(
            "ads",
            lambda: extract.with_alias_bits(binding.job_ads(self.spark, self.sf_dir)),
            keep=True,
            options=row_group_option(self.spark),
        )

    def ads(self) -> DataFrame:
        return self.marked_ads().drop(*extract.ALIAS_BITS)

    def stg_ads(self) -> DataFrame:
        return marts.stg_ads(self.ads())

    def duplicate_ids(self) -> DataFrame | None:
        """Ids on more than one ad row, written once and shared by the distinct-ad
        denominators (None when stages are not materialised)."""
        if not self.materialize_stages:
            return None
        return self._stage("duplicate_ids", lambda: extract.duplicate_ids(self.ads()), keep=True)

    # --- extraction ----------------------------------------------------
    def regex_matches(self) -> DataFrame:
        """One row per (id, skill), deduplicated once and written."""
        return self._stage("regex_matches", lambda: extract.regex_skill_matches(self.marked_ads()), keep=True)

    def regex_skills(self) -> DataFrame:
        """The compact table, written on its own: marts never read headlines or snippets."""
        return self._stage("regex_skills", lambda: extract.regex_skills(self.regex_matches()), keep=True)

    def indexed_matches(self) -> DataFrame:
        """The fixed taxonomy as a relation, joined by the alias index: the rows of ``regex_matches``."""
        return anchor_join.regex_skill_matches(self.ads(), taxonomy_frame(self.spark))

    def word_matches(self) -> DataFrame:
        """A taxonomy of thousands of aliases (the corpus's rare words), joined by the alias index."""
        docs = tables.read_table(self.spark, self.sf_dir, "documents").select("doc_id", "text")
        return anchor_join.regex_skill_matches(self.ads(), anchor_join.word_taxonomy(docs, "doc_id", "text"))

    def ams_skills(self) -> DataFrame:
        return extract.ams_skills(self.ads())

    def ams_catalogue(self) -> DataFrame:
        """Distinct ads and mentions per provided label."""
        return marts.ams_catalogue(self.ams_skills())

    def all_skills(self) -> DataFrame:
        return marts.all_skills(self.ams_skills(), self.regex_skills())

    def live_sample(self) -> DataFrame:
        """Live-sample shaped ads: nested description flattened to ``description__text``."""
        ads = self.marked_ads()
        text = ads.description_text.alias("description__text")
        return ads.select("id", "publication_date", "headline", text, *extract.ALIAS_BITS)

    def job_skill_lists(self) -> DataFrame:
        return self._stage(
            "job_skill_lists", lambda: extract.job_skill_lists(self.live_sample()), keep=True
        )

    def job_skills(self) -> DataFrame:
        return extract.job_skills(self.job_skill_lists())

    # --- marts ---------------------------------------------------------
    def monthly_counts(self) -> DataFrame:
        return self._stage(
            "monthly_counts",
            lambda: marts.monthly_skill_counts(self.regex_skills(), one_row_per_id_skill=True),
            keep=False,
        )

    def trends(self) -> DataFrame:
        return self._stage(
            "trends",
            lambda: marts.skill_trends(self.monthly_counts(), self.stg_ads(), self.duplicate_ids()),
            keep=True,
        )

    def geography(self) -> DataFrame:
        return self._stage(
            "geography",
            lambda: marts.skill_geography(
                self.regex_skills(),
                self.stg_ads(),
                one_row_per_id_skill=True,
                dup_ids=self.duplicate_ids(),
            ),
            keep=True,
        )

    def cell_bitmaps(self) -> DataFrame:
        """The ids of each (month, place, skill) as bitmaps, written once."""
        pairs = lambda: distinct_bitmaps.located_skills(self.regex_skills(), marts.ad_locations(self.stg_ads()))
        return self._stage("cell_bitmaps", lambda: distinct_bitmaps.cell_bitmaps(pairs()), keep=True)

    # --- data tests ----------------------------------------------------
    def test_tables(self) -> dict[str, DataFrame]:
        """The tables the data tests run on, by their warehouse names."""
        return {
            "historical_job_ads": self.ads(),
            "historical_job_skills": self.ams_skills(),
            "historical_regex_skills": self.regex_skills(),
            "monthly_skill_counts": self.monthly_counts(),
            "mart_dashboard_skill_trends": self.trends(),
            "mart_skill_geography": self.geography(),
        }

    def observed_report(self) -> DataFrame:
        """The data tests from the counts that the stages' writing jobs made; tables that are not written are scanned."""
        return self._tests.report(self.test_tables())

    # --- replace-by-archive --------------------------------------------
    def replace_partition_demo(self, reloaded: str, emptied: str) -> DataFrame:
        """Reload two archives of a table of two, next to the untouched others.

        ``reloaded`` comes back as a newer extract (``source_year`` + 10);
        ``emptied`` comes back with no rows and must disappear. Only these two
        archives are written to a private table; the others are read from the
        ads table as they are. Returns the whole table after the replacement.
        """
        path = stage_path(self.spark, "ads_table")
        ads = self.ads()
        touched = F.col("source_archive").isin(reloaded, emptied)
        archives.write_ads(ads.where(touched), path)
        new_load = ads.where(F.col("source_archive") == reloaded).withColumn(
            "source_year", F.col("source_year") + 10
        )
        archives.replace_archive(new_load, path, reloaded)
        archives.replace_archive(new_load.where(F.lit(False)), path, emptied)
        replaced = archives.read_ads_table(self.spark, path)
        return replaced.unionByName(ads.where(~touched | F.col("source_archive").isNull()))


    def incremental_marts(self, reloaded: str, since: str) -> dict[str, DataFrame]:
        """Mart states after one archive was replaced by its ads since a month, on top of a build of all archives."""
        if self._incremental is None:
            ads = self.marked_ads()
            made = incremental_marts.IncrementalMarts(self.spark, stage_path(self.spark, "incremental"))
            made.build(ads)
            newer = ads.where((F.col("source_archive") == reloaded) & (F.col("publication_month") >= F.lit(since).cast("timestamp_ntz")))
            made.replace(newer, reloaded)
            self._incremental = made
        return self._incremental.marts()

    def archive_versions_demo(self, reloaded: str, emptied: str, since: str) -> DataFrame:
        """Rows per archive and version after a load, a reload, a load that is never published, and a clearance.

        Version 1 holds all archives; version 2 reloads one with its ads since
        a month; version 3 clears another. Returns (source_archive, version,
        rows, current).
        """
        table = VersionedTable(self.spark, stage_path(self.spark, "ads_versions"), "source_archive")
        ads = self.ads().select("id", "publication_month", "source_archive")
        table.stage(ads).publish(whole=True)
        newer = ads.where((F.col("source_archive") == reloaded) & (F.col("publication_month") >= F.lit(since).cast("timestamp_ntz")))
        table.stage(newer, [reloaded]).publish()
        table.stage(newer.limit(1), [reloaded])  # a job that ends here leaves no trace
        table.stage(newer.limit(0), [emptied]).publish()
        return table.part_versions().withColumnRenamed("part", "source_archive")


def warehouse(spark: SparkSession, sf_dir: str, materialize_stages: bool = True) -> SkillWarehouse:
    """The (cached) warehouse of one session and one state of an input folder's files."""
    apply_defaults(spark)
    state = tuple(f for t in binding.INPUTS for f in list_files(spark, f"{sf_dir.rstrip('/')}/{t}.parquet"))
    key = (app_id(spark), sf_dir.rstrip("/"), materialize_stages, state)
    with _LOCK:
        wh = _CACHE.get(key)
        if wh is None or wh.spark is not spark:
            wh = SkillWarehouse(spark, sf_dir, materialize_stages)
            _CACHE[key] = wh
        return wh
