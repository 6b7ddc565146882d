"""Marts that follow a replaced archive without a rebuild (S7 -> D10, D11, D12).

Each archive leaves mergeable states, one row per key and archive, in versioned
tables with a part per archive:

* ``matches``: the best alias per (id, skill) among the archive's ads, as the
  struct whose minimum over all archives is the global winner;
* ``months``: its (month, id) pairs;
* ``places``: per (id, month, location) the ad rows and exact decimal coordinate sums.

The marts are sums over ids: mentions, distinct ads, coordinate sums. When an
archive is replaced, only ids of its old or its new state can change, whatever
archives they are in, too. Their contributions under the old states are taken
off the marts and those under the new states are put on. The only text that is
read is the new archive's; states of other archives are read for the affected
ids alone.

``contributions`` of all states is the full rebuild, and an update gives the
same rows. A state is written aside and published by its table's manifest; the
marts bear the versions they belong to, and an update that finds them behind
(a job that ended in between) sums all states anew instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillgrid.functions.constants import LATITUDE_BOUNDS, LONGITUDE_BOUNDS
from skillgrid.operators import extract, marts
from skillgrid.session import path_exists
from skillgrid.sources.sinks import StagedTables
from skillgrid.sources.versions import Staged, VersionedTable

PLACE = ["municipality", "municipality_code", "region", "region_code"]
_BEST = ["pattern_order", "publication_month", "headline", "description_snippet", "matched_text"]
_SUM = "decimal(38,12)"
# Keys and sums of each mart state; a key stays while it has rows.
MARTS = {
    "monthly": (["publication_month", "skill"], ["mentions", "rows"]),
    "month_ads": (["publication_month"], ["ads", "rows"]),
    "geography": (["publication_month", "skill", *PLACE], ["mentions", "n", "lon_sum", "lat_sum", "rows"]),
    "place_ads": (["publication_month", "municipality_code"], ["ads", "rows"]),
}


def archive_states(ads: DataFrame) -> dict[str, DataFrame]:
    """The states of the ads' archives, each row with its ``source_archive``; the text is read once."""
    owned = ads.withColumn("id", F.struct("source_archive", "id"))
    found = extract.found_skill_matches(owned).groupBy("id", "skill").agg(F.min(F.struct(*_BEST)).alias("best"))
    located = marts.ad_locations(owned, LONGITUDE_BOUNDS, LATITUDE_BOUNDS)
    places = located.groupBy("id", "publication_month", *PLACE).agg(
        F.count("*").alias("n"),
        F.sum(F.col("longitude").cast(_SUM)).cast(_SUM).alias("lon_sum"),
        F.sum(F.col("latitude").cast(_SUM)).cast(_SUM).alias("lat_sum"),
    )
    months = owned.select("id", "publication_month").distinct()

    def parted(df: DataFrame) -> DataFrame:
        rest = [c for c in df.columns if c != "id"]
        return df.select(F.col("id.id").alias("id"), *rest, F.col("id.source_archive").alias("source_archive"))

    return {"matches": parted(found), "months": parted(months), "places": parted(places)}


def best_matches(states: dict[str, DataFrame]) -> DataFrame:
    """``historical_regex_skill_matches`` of the states: one row per (id, skill) over all archives."""
    best = states["matches"].groupBy("id", "skill").agg(F.min("best").alias("w"))
    return best.select("id", "skill", *[F.col(f"w.{c}").alias(c) for c in _BEST]).select(*extract.MATCH_COLUMNS)


def contributions(states: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """What the states' ids add to each mart."""
    # The winner's month is the least struct's second field: headlines and snippets stay out of the shuffle.
    first = states["matches"].groupBy("id", "skill").agg(F.min(F.struct("best.pattern_order", "best.publication_month")).alias("w"))
    skills = first.select("id", F.col("w.publication_month").alias("publication_month"), "skill")
    months = states["months"].select("publication_month", "id").distinct()
    per_ad = states["places"].groupBy("id", "publication_month", *PLACE).agg(
        F.sum("n").alias("n"), F.sum("lon_sum").cast(_SUM).alias("lon_sum"), F.sum("lat_sum").cast(_SUM).alias("lat_sum"))
    located = states["places"].select("publication_month", "municipality_code", "id").distinct()
    counted = {
        "monthly": skills.groupBy("publication_month", "skill").agg(F.count("id").alias("mentions"), F.count("*").alias("rows")),
        "month_ads": months.groupBy("publication_month").agg(F.count("id").alias("ads"), F.count("*").alias("rows")),
        "geography": skills.join(per_ad, ["id", "publication_month"]).groupBy("publication_month", "skill", *PLACE).agg(
            F.count("id").alias("mentions"), F.sum("n").alias("n"), F.sum("lon_sum").cast(_SUM).alias("lon_sum"),
            F.sum("lat_sum").cast(_SUM).alias("lat_sum"), F.count("*").alias("rows")),
        "place_ads": located.groupBy("publication_month", "municipality_code").agg(F.count("id").alias("ads"), F.count("*").alias("rows")),
    }
    return {name: counted[name].select(*keys, *sums) for name, (keys, sums) in MARTS.items()}


def of_ids(states: dict[str, DataFrame], ids: DataFrame) -> dict[str, DataFrame]:
    """The states' rows of some ids (a null id is an id)."""
    wanted = ids.select(F.col("id").alias("_id"))
    return {n: df.join(wanted, df["id"].eqNullSafe(wanted["_id"]), "left_semi") for n, df in states.items()}


def updated(base: dict[str, DataFrame], old: dict[str, DataFrame], new: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The marts after some ids' contributions changed: taken off, put on, keys without rows dropped."""
    out = {}
    for name, (keys, sums) in MARTS.items():
        less = old[name].select(*keys, *[(-F.col(c)).alias(c) for c in sums])
        every = base[name].unionByName(less).unionByName(new[name])
        total = every.groupBy(*keys).agg(*[F.sum(c).cast(base[name].schema[c].dataType).alias(c) for c in sums])
        out[name] = total.where("rows > 0")
    return out


def monthly_skill_counts(states: dict[str, DataFrame]) -> DataFrame:
    return states["monthly"].select("publication_month", "skill", "mentions")


def skill_trends(states: dict[str, DataFrame]) -> DataFrame:
    """``mart_dashboard_skill_trends`` of the mart states."""
    joined = states["monthly"].join(states["month_ads"].drop("rows"), "publication_month")
    return joined.select("publication_month", "skill", "mentions", "ads", marts.share("mentions", "ads").alias("share_of_ads"))


def skill_geography(states: dict[str, DataFrame]) -> DataFrame:
    """``mart_skill_geography`` of the mart states."""
    joined = states["geography"].join(states["place_ads"].drop("rows"), ["publication_month", "municipality_code"], "left")
    mean = lambda c: (F.col(c).cast("double") / F.col("n")).alias
    return joined.select(
        "publication_month", "skill", *PLACE, mean("lon_sum")("longitude"), mean("lat_sum")("latitude"),
        "mentions", "ads", marts.share("mentions", "ads").alias("share_of_ads"))


class IncrementalMarts:
    """States and marts of an ads table under one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.tables = {n: VersionedTable(spark, f"{self.folder}/state_{n}", "source_archive") for n in ("matches", "months", "places")}

    def states(self) -> dict[str, DataFrame]:
        return {n: t.read() for n, t in self.tables.items()}

    def marts(self) -> dict[str, DataFrame]:
        """The mart states as they were last published."""
        return {n: self.spark.read.parquet(f"{self.folder}/{n}") for n in MARTS}

    def _versions(self) -> list[int]:
        return [t.versions()[-1] if t.versions() else 0 for t in self.tables.values()]

    def _current(self) -> bool:
        """Whether the marts belong to the newest states."""
        place = f"{self.folder}/of_versions"
        return path_exists(self.spark, place) and list(self.spark.read.parquet(place).first().versions) == self._versions()

    def _publish(self, load: dict[str, Staged], made: dict[str, DataFrame], whole: bool) -> None:
        staged = StagedTables(self.spark, self.folder)
        try:
            for name, df in made.items():
                staged.write(df, name)
            # The marts belong to the versions that this load is about to make.
            after = self.spark.createDataFrame([([v + 1 for v in self._versions()],)], "versions array<long>")
            staged.write(after, "of_versions")
        except BaseException:
            staged.discard()
            raise
        for one in load.values():
            one.publish(whole=whole)
        staged.publish()

    def build(self, ads: DataFrame) -> None:
        """States and marts of all archives, from their text."""
        load = {n: self.tables[n].stage(df) for n, df in archive_states(ads).items()}
        self._publish(load, contributions({n: s.rows() for n, s in load.items()}), whole=True)

    def replace(self, archive_ads: DataFrame, archive: str) -> None:
        """Replaces one archive (by nothing, if the load is empty): reads its new text and the affected ids' states."""
        owned = archive_ads.withColumn("source_archive", F.lit(archive))
        load = {n: self.tables[n].stage(df, [archive]) for n, df in archive_states(owned).items()}
        before = self.states()
        after = {n: s.view() for n, s in load.items()}
        if self._current():
            gone = before["months"].where(F.col("source_archive") == archive).select("id")
            ids = gone.union(load["months"].rows().select("id")).distinct()
            made = updated(self.marts(), contributions(of_ids(before, ids)), contributions(of_ids(after, ids)))
        else:
            made = contributions(after)
        self._publish(load, made, whole=False)
