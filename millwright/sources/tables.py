"""Stored tables: views, Parquet, JDBC, and keyed batch logs."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.operators.keyed import RECORD_KEY, keep_first, keep_last
from millwright.session import new_path

#: Offsets of a range: the files of a keyed table are apart by them.
RANGE_OFFSETS = 1_000_000
#: Folders of a batch whose ranges are smaller than that; where it has more ranges, neighbours share one.
FOLDERS = 256


def read_table(spark: SparkSession, name: str, **jdbc: str) -> DataFrame:
    """A registered table or view; with ``url=...`` the table of that name over JDBC."""
    if jdbc:
        return spark.read.format("jdbc").options(dbtable=name, **jdbc).load()
    return spark.table(name)


def create_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def materialize(df: DataFrame, path: str | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df``, replacing an older version at ``path``, and read it back."""
    path = path or new_path(df.sparkSession, "table")
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize_samples(samples: DataFrame, path: str | None = None) -> DataFrame:
    """(machine_id, ts) by day, so that time filters read only their days.

    Rows are brought together by day for few files per day; a full day is split by the rebalance.
    """
    slim = samples.select("machine_id", F.timestamp_millis("timestamp").alias("ts"))
    return materialize(slim.withColumn("day", F.to_date("ts")).hint("rebalance", "day"), path, ["day"])


def new_run() -> str:
    """An id that sorts after those of all earlier runs."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex}"


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The run that belongs to a checkpoint: kept beside it, so a restarted stream goes on with its own."""
    path = f"{checkpoint}/millwright-run"
    try:
        return spark.read.schema("run string").parquet(path).first()["run"]
    except AnalysisException:
        run = new_run()
        spark.createDataFrame([(run,)], "run string").coalesce(1).write.parquet(path)
        return run


def write_batch(
    batch: DataFrame,
    path: str,
    batch_id: int,
    keep: str = "last",
    keys: Sequence[str] = RECORD_KEY,
    run: str = "0-first",
    range_offsets: int = RANGE_OFFSETS,
) -> None:
    """Store one batch of a keyed table; repeating a batch id of the same run replaces that batch.

    Only the batch itself is deduplicated and written, its files by ranges of offsets. ``keyed_range`` is the first range of a folder
    and ``keyed_width`` the number of ranges it holds, a power of two, so that files don't get more as the batch gets larger. Keys in several batches are settled when
    the table is read, so a write never rewrites the table. ``arrival`` orders rows of a batch.
    """
    pick = keep_last if keep == "last" else keep_first
    width = _width(batch, keys, range_offsets)
    own = _range(keys, range_offsets)
    settled = pick(batch, F.col("arrival"), keys).withColumn("keyed_width", F.lit(width)).withColumn("keyed_range", own - F.pmod(own, F.lit(width)))
    settled.hint("rebalance", "keyed_range").write.mode("overwrite").partitionBy("keyed_range").parquet(f"{path}/keyed_run={run}/keyed_batch={batch_id}")


def _range(keys: Sequence[str], range_offsets: int):
    """The range that holds all copies of a key; one range where the key has no offset."""
    return F.expr(f"offset div {range_offsets}") if "offset" in keys else F.lit(0).cast("bigint")


def _width(batch: DataFrame, keys: Sequence[str], range_offsets: int) -> int:
    """How many ranges share a folder: a power of two, as all of a folder's ranges are then of one folder in a batch of wider ones too."""
    if "offset" not in keys or range_offsets >= RANGE_OFFSETS:
        return 1
    own = _range(keys, range_offsets)
    low, high = batch.agg(F.min(own), F.max(own)).first()
    width = 1
    while low is not None and (high - low) // width >= FOLDERS:
        width *= 2
    return width


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """All rows with the run and batch they came in; folded rows keep those of the row that stayed."""
    stored = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(path)
    for name in ("run", "batch"):
        own = F.col(f"keyed_{name}").cast("string" if name == "run" else "bigint")
        came = F.coalesce(F.col(f"kept_{name}"), own) if f"kept_{name}" in stored.columns else own
        stored = stored.withColumn(f"_{name}", came)
    return stored.withColumn("keyed_width", F.coalesce("keyed_width", F.lit(1)) if "keyed_width" in stored.columns else F.lit(1))


_OWN = ("keyed_run", "keyed_batch", "keyed_range", "keyed_width", "kept_run", "kept_batch", "_run", "_batch")


def read_keyed(
    spark: SparkSession,
    path: str,
    keep: str = "last",
    keys: Sequence[str] = RECORD_KEY,
    offsets: tuple[int, int] | None = None,
    range_offsets: int = RANGE_OFFSETS,
) -> DataFrame:
    """The keyed table: one row per key over all batches, with the columns of all batches.

    ``offsets`` (first, and the one after the last) reads only the files of the ranges they lie in.
    """
    stored = _stored(spark, path)
    if offsets is not None:
        low, high = offsets
        first, last = low // range_offsets, (high - 1) // range_offsets
        # Folders of several ranges begin at a multiple of their number, so those that hold the first range are known.
        wider = {first - first % (1 << k) for k in range(1, 62)}
        folder = F.col("keyed_range").isNotNull() & (F.col("keyed_range").between(first, last) | F.col("keyed_range").isin(sorted(wider)))
        stored = stored.filter(folder & (F.col("offset") >= low) & (F.col("offset") < high))
    pick = keep_last if keep == "last" else keep_first
    return pick(stored, F.struct("_run", "_batch", "arrival"), keys).drop(*_OWN, "arrival")


def compact_ranges(spark: SparkSession, path: str, keep: str = "last", keys: Sequence[str] = RECORD_KEY) -> list[int]:
    """Fold the ranges that several batches have written, in place; folders of one batch are not rewritten. Returns the ranges, where
    they share folders the first of each.

    A folded row keeps the run and batch it came in, so streams may go on writing, and batches may be repeated, before, during and
    after. Folded files are written whole before the files they replace are removed; a reader between sees both, and settles
    them as any copies. Names of ranges and batches come to the driver, no rows.
    """
    stored = _stored(spark, path)
    parts = stored.select("keyed_range", "keyed_run", "keyed_batch", "keyed_width").where("keyed_range IS NOT NULL").distinct().collect()
    # Folders that have ranges in common, as [first range, the one after the last, folders].
    shared: list[list] = []
    for part in sorted(parts, key=lambda p: p.keyed_range):
        end = part.keyed_range + part.keyed_width
        if shared and part.keyed_range < shared[-1][1]:
            shared[-1][1] = max(shared[-1][1], end)
            shared[-1][2].append(part)
        else:
            shared.append([part.keyed_range, end, [part]])
    several = [s for s in shared if len({(p.keyed_run, p.keyed_batch) for p in s[2]}) > 1]
    if not several:
        return []
    pick = keep_last if keep == "last" else keep_first
    to = {p.keyed_range: (first, end - first) for first, end, own in several for p in own}
    names = spark.createDataFrame([(r, *f) for r, f in sorted(to.items())], "keyed_range bigint, _first bigint, _width int")
    folded = pick(stored.filter(F.col("keyed_range").isin(sorted(to))), F.struct("_run", "_batch", "arrival"), keys).join(names, "keyed_range")
    folded = folded.withColumn("keyed_range", F.col("_first")).withColumn("keyed_width", F.col("_width")).withColumn("kept_run", F.col("_run")).withColumn("kept_batch", F.col("_batch"))
    folded = folded.drop("keyed_run", "keyed_batch", "_run", "_batch", "_first", "_width")
    folded.hint("rebalance", "keyed_range").write.partitionBy("keyed_range").parquet(f"{path}/keyed_run={new_run()}/keyed_batch=0")
    files = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for _, _, own in several:
        for part in own:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/keyed_run={part.keyed_run}/keyed_batch={part.keyed_batch}/keyed_range={part.keyed_range}"), True)
    return [first for first, _, _ in several]


def compact(spark: SparkSession, path: str, target: str, keep: str = "last", keys: Sequence[str] = RECORD_KEY, range_offsets: int = RANGE_OFFSETS) -> None:
    """Fold all batches into a run of one batch at ``target``, to be used in place of ``path``; streams stopped before and
    started again on a new checkpoint write later runs beside it."""
    settled = read_keyed(spark, path, keep, keys).withColumn("arrival", F.lit(0).cast("bigint")).withColumn("keyed_range", _range(keys, range_offsets))
    settled.hint("rebalance", "keyed_range").write.mode("overwrite").partitionBy("keyed_range").parquet(f"{target}/keyed_run={new_run()}/keyed_batch=0")
