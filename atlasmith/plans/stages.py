"""The stage tables of the whole analysis over the adapter views, each kept once it is computed."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from atlasmith.operators import classify, discovery, locations, scores
from atlasmith.plans import adapters as A
from atlasmith.plans import gazetteer
from atlasmith.sources import snapshots
from atlasmith.sources import tables as T


class Stages:
    """A stage's table is written once, in the shared folder, so that later plans stay short and survive lost executors.

    All tables lie in one folder, which close() deletes; stages() closes those whose input has changed.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.folder = snapshots.fresh(spark, "stages")
        self.input = _input(spark, sf_dir)
        self._written = 0

    def _kept(self, df: DataFrame) -> DataFrame:
        self._written += 1
        path = f"{self.folder}/{self._written:03d}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def valid(self) -> bool:
        """Whether the input is what it was, and the tables are still there."""
        there = set(snapshots.names(self.spark, self.folder))
        return self.input == _input(self.spark, self.sf_dir) and all(f"{i:03d}" in there for i in range(1, self._written + 1))

    def close(self) -> None:
        snapshots.delete(self.spark, self.folder)

    @cached_property
    def events(self) -> DataFrame:
        return T.scan_events(A.act_events(self.spark, self.sf_dir))

    @cached_property
    def grid(self) -> DataFrame:
        return self._kept(discovery.event_grid(self.events))

    @cached_property
    def activity(self) -> DataFrame:
        return self._kept(discovery.repo_activity(self.grid, A.TERMS))

    @cached_property
    def discovered(self) -> DataFrame:
        return discovery.repo_discovery(self.activity, A.MINIMUMS)

    @cached_property
    def contributors(self) -> DataFrame:
        return self._kept(discovery.contributor_rollup(self.grid, self.discovered, A.DOMAIN))

    @cached_property
    def metadata(self) -> DataFrame:
        return A.repo_meta(self.spark, self.sf_dir)

    @cached_property
    def taxonomy(self) -> DataFrame:
        return A.taxonomy(self.spark)

    @cached_property
    def classified(self) -> DataFrame:
        return A.classified(self.spark, self.sf_dir)

    @cached_property
    def classification(self) -> DataFrame:
        return self._kept(classify.classify_run(self.metadata, self.activity, self.taxonomy, A.DOMAIN))

    @cached_property
    def locations(self) -> DataFrame:
        return A.actor_geo(self.spark, self.sf_dir)

    @cached_property
    def normalized(self) -> DataFrame:
        tables = [T.read_table(self.spark, self.sf_dir, t) for t in ("customer", "nation", "region")]
        return self._kept(locations.normalize_run(gazetteer.profiles(*tables), gazetteer.star_dims(*tables)))

    @cached_property
    def countries(self) -> DataFrame:
        return A.country_names(self.spark, self.sf_dir)

    @cached_property
    def repo_signals(self) -> DataFrame:
        return self._kept(scores.repo_signals(scores.join_score_inputs(self.classified, self.activity, self.metadata), A.WINDOW[1]))

    @cached_property
    def repo_scores(self) -> DataFrame:
        return self._kept(scores.finish_repositories(self.repo_signals))

    @cached_property
    def contributor_evidence(self) -> DataFrame:
        return self._kept(scores.contributor_evidence(self.contributors, self.classified, self.repo_scores))

    @cached_property
    def contributor_signals(self) -> DataFrame:
        return self._kept(scores.contributor_signals(self.contributor_evidence, A.WINDOW[1]))

    @cached_property
    def contributor_scores(self) -> DataFrame:
        return self._kept(scores.finish_contributors(self.contributor_signals, self.locations))

    @cached_property
    def geo_evidence(self) -> DataFrame:
        return self._kept(scores.geo_evidence(self.contributor_scores, self.contributors, self.classified, self.locations, A.WINDOW[1]))

    @cached_property
    def rankings(self) -> DataFrame:
        return self._kept(scores.score_geographies(self.geo_evidence, minimums=A.SAMPLES))


#: Tables that the adapter views read.
INPUTS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
_open: dict[tuple[str, str], Stages] = {}


def _input(spark: SparkSession, sf_dir: str) -> list[tuple]:
    """Names, sizes and times of the tables' files or folders."""
    return [(t, *snapshots.stamp(spark, f"{sf_dir}/{t}.parquet")) for t in INPUTS]


def stages(spark: SparkSession, sf_dir: str) -> Stages:
    """The stages of this application and input; anew if the input has changed or their tables are gone."""
    key = spark.sparkContext.applicationId, sf_dir
    known = _open.get(key)
    if known is not None and not known.valid():
        known.close()
        known = None
    if known is None:
        known = _open[key] = Stages(spark, sf_dir)
    return known


def close_all() -> None:
    """Delete all stage tables that this process has open."""
    for known in _open.values():
        known.close()
    _open.clear()
