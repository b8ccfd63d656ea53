"""One row per key: first write wins, last write wins, latest row, snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RECORD_KEY = ("offset", "partition")
#: Parts over which the rows of one key are dealt when a row for it is looked up.
SPREAD = 32


def _one_per_key(df: DataFrame, keys: Sequence[str], pick) -> DataFrame:
    """Aggregates rather than ranks, so copies of one key are folded before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(pick(F.struct(*rest)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def keep_first(df: DataFrame, arrival: Column, keys: Sequence[str] = RECORD_KEY) -> DataFrame:
    return _one_per_key(df, keys, lambda row: F.min_by(row, arrival))


def keep_last(df: DataFrame, arrival: Column, keys: Sequence[str] = RECORD_KEY) -> DataFrame:
    return _one_per_key(df, keys, lambda row: F.max_by(row, arrival))


def latest_per_key(df: DataFrame, key: str, order: Column, fields: Sequence[str]) -> DataFrame:
    return df.groupBy(key).agg(F.max_by(F.struct(*fields), order).alias("_row")).select(key, "_row.*")


def looked_up(rows: DataFrame, table: DataFrame, *keys: str, deal: Sequence[str] = ()) -> DataFrame:
    """``rows`` with the one row of ``table`` for their key, or nulls. A key's rows are dealt over ``SPREAD`` parts by ``deal``, by default all columns."""
    copies = table.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    share = F.pmod(F.xxhash64(*(deal or rows.columns)), F.lit(SPREAD)).cast("int")
    return rows.withColumn("_share", share).join(copies, [*keys, "_share"], "left").drop("_share")
