"""Sums of equal-sized arrays that the tasks hold, as a shuffle of slices; session settings of these operators, and the store of a path."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.session import new_path

SLICES = 64
SCHEMA = "slice int, data binary"


def tune(spark: SparkSession, rows: int = 1000) -> SparkSession:
    """Small Arrow batches, so that a worker holds a few megabytes of text at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return spark


def _store(path: str):
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def sliced(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's array as rows of ``SCHEMA``; slices that hold only zeros are left out."""
    for k, part in enumerate(np.array_split(total.ravel(), SLICES)):
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["slice", "data"])


def _added(df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], dtype) -> DataFrame:
    """The slices of the sum of the arrays that ``task`` emits by ``sliced``."""

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = np.frombuffer(data.as_buffer(), dtype)
                held[k] = held[k] + part if k in held else part.copy()
        for k, part in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["slice", "data"])

    return df.mapInArrow(task, SCHEMA).repartition(SLICES, F.col("slice")).mapInArrow(add, SCHEMA)


def _joined(slices, shape: tuple[int, ...], dtype) -> np.ndarray:
    parts = np.array_split(np.zeros(int(np.prod(shape)), dtype), SLICES)
    for k, data in slices:
        parts[k] = np.frombuffer(data, dtype)
    return np.concatenate(parts).reshape(shape)


def summed(df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], shape: tuple[int, ...], dtype) -> np.ndarray:
    """The sum of the arrays that ``task`` emits by ``sliced``. Only the finished sum, of the fixed ``shape``, comes to the driver."""
    return _joined(((row["slice"], bytes(row["data"])) for row in _added(df, task, dtype).collect()), shape, dtype)


def stored(df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], dtype) -> str:
    """A folder with the sum of the arrays that ``task`` emits by ``sliced``, in one file. Tasks read it by ``loaded``; nothing comes to the driver."""
    path = new_path(df.sparkSession, "cut")
    _added(df, task, dtype).repartition(1).write.parquet(path)
    return path


def loaded(folder: str, shape: tuple[int, ...], dtype) -> np.ndarray:
    """A sum that ``stored`` wrote, read by a task."""
    store, at = _store(folder)
    files = [f.path for f in store.get_file_info(fs.FileSelector(at)) if f.path.endswith(".parquet")]
    tables = [pq.read_table(store.open_input_file(f)) for f in files]
    return _joined(((k, data.as_buffer()) for t in tables for k, data in zip(t["slice"].to_pylist(), t["data"], strict=True)), shape, dtype)
