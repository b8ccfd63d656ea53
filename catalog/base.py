"""Registry of queries: each is a DataFrame builder and, where SQL can say the same, its SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from millwright.sources import telemetry

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Fixed value: the generated events are minutes apart, so checks use half-hour buckets and gaps.
HALF_HOUR = 1_800_000
# Queries named ..._sliced go down to milliseconds.
DEEP_SLICE_ROWS = 1


class Tables:
    """The given tables and the relations derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.sf_dir = spark, sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.read("events")

    @cached_property
    def samples(self) -> DataFrame:
        return telemetry.samples_from_events(self.events)

    @cached_property
    def readings(self) -> DataFrame:
        return telemetry.readings_from_events(self.events)

    @cached_property
    def full_messages(self) -> DataFrame:
        return telemetry.full_messages_from_events(self.events)

    @cached_property
    def messages(self) -> DataFrame:
        return telemetry.messages_from_events(self.events)


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return build

    return register
