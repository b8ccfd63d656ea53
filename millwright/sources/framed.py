"""Registry-framed Avro records: a zero byte, a four-byte schema id, then the record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.avro.functions import from_avro

HEADER_BYTES = 5


def decode_framed(records: DataFrame, avro_schema: str, column: str = "value") -> DataFrame:
    """The records of a binary column as columns; needs the Avro package on the class path and fails without it."""
    payload = F.expr(f"substring(`{column}`, {HEADER_BYTES + 1})")
    return records.select(from_avro(payload, avro_schema).alias("_r")).select("_r.*")
