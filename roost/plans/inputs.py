"""The step tables derived from one folder of test tables, stored once per session."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from roost.operators.clusters import cluster_stops
from roost.operators.homework import classify_home_work
from roost.operators.localtime import localize_stops
from roost.operators.stops import detect_stops
from roost.plans import fixture
from roost.sources.stage import new_path, stage

_known: dict[tuple[str, str], Inputs] = {}


class Inputs:
    """Each table is what the previous step stored, as in a full run."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Inputs:
        key = (spark.sparkContext.applicationId, sf_dir)
        return _known.setdefault(key, cls(spark, sf_dir))

    def table(self, name: str) -> DataFrame:
        return fixture.table(self.spark, self.sf_dir, name)

    def path(self, name: str) -> str:
        return new_path(self.spark, name)

    @cached_property
    def pings(self) -> DataFrame:
        return stage(fixture.fixture_pings(self.spark, self.sf_dir), "pings")

    @cached_property
    def tz_codes(self) -> DataFrame:
        return fixture.fixture_tz_codes(self.spark, self.sf_dir)

    @cached_property
    def areas(self) -> DataFrame:
        return fixture.fixture_areas(self.spark, self.sf_dir)

    @cached_property
    def stops(self) -> DataFrame:
        return stage(detect_stops(self.pings), "stops")

    @cached_property
    def clustered(self) -> DataFrame:
        return stage(cluster_stops(self.stops), "clustered")

    @cached_property
    def local(self) -> DataFrame:
        return stage(
            localize_stops(self.clustered, self.tz_codes, fixture.COUNTRY, fixture.DEFAULT_ZONE), "local"
        )

    @cached_property
    def hw(self) -> DataFrame:
        return stage(classify_home_work(self.local), "hw")
