"""Session settings and the shared folder used for checkpoints and sinks."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STREAMING = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # Sessions are merged before the shuffle, so a hot machine sends sessions, not samples.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def ship_by_value(module: str) -> None:
    """Send the module's functions to the Python workers themselves, not by name, so that workers
    need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def build_session(app: str = "millwright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are planned for.

    Cluster values (executors, memory, ``spark.sql.shuffle.partitions``,
    ``spark.checkpoint.dir``) come from spark-submit; only what the results
    or plans rely on is set here.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in STREAMING.items():
        builder = builder.config(key, value)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def set_streaming(spark: SparkSession) -> None:
    """Give a session made elsewhere the settings the stateful streams rely on."""
    for key, value in STREAMING.items():
        spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where the setting is missing, a local master gets a folder of its own for the session; a cluster
    must name one, as a machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="millwright-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from the written copy."""
    path = new_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
