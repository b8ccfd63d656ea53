import pytest
from pyspark.sql import types as T

from millwright.session import build_session

SAMPLE = T.StructType(
    [
        T.StructField("machine_id", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("execution", T.StringType()),
        T.StructField("part_count", T.LongType()),
        T.StructField("program", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_samples(spark):
    """Samples from (machine, offset, timestamp, execution, part_count, program) with defaults."""

    def make(rows):
        full = []
        for row in rows:
            machine, offset, timestamp, *rest = row
            rest = list(rest) + [None] * (3 - len(rest))
            full.append((machine, offset, timestamp, 0, *rest))
        return spark.createDataFrame(full, SAMPLE)

    return make


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)
