"""The table function of state totals, from SQL."""

from millwright.operators import bins
from millwright.plans import jobs
from tests.conftest import rows

RUNS = [("m1", "ACTIVE", 3_700_000, 5_000_000), ("m1", "READY", 5_000_000, 9_100_000), ("m2", "STOPPED", 3_600_000, 3_600_001), ("m2", "ACTIVE", 4_000_000, 4_000_000)]


def test_dist_in_a_select_and_in_a_lateral_join(spark):
    runs = spark.createDataFrame(RUNS, "machine_id string, execution string, start bigint, end bigint")
    jobs.create_dist(runs)
    expected = {w: rows(bins.execution_distribution_totals(runs.filter("start < end"), w * 60_000)) for w in (7, 15, 60)}
    assert rows(spark.sql("SELECT * FROM dist(INTERVAL 7 MINUTES)")) == expected[7]
    joined = spark.sql("SELECT w.minutes, d.* FROM VALUES (7), (15), (60) AS w(minutes), LATERAL dist(make_dt_interval(0, 0, w.minutes, 0)) AS d")
    for width, rows_ in expected.items():
        assert rows(joined.filter(f"minutes = {width}").drop("minutes")) == rows_
