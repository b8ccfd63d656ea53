"""Physical plans: what must not be there, and what must reach the scan."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from millwright.operators import changes, ordered
from millwright.sources.telemetry import samples_from_events

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()



@pytest.mark.parametrize("name", ["executions", "execution_distribution", "completed_program_parts", "part_completed_events", "activity_periods_dense", "session_lookup", "join_bins_left_range", "registry_changes", "asof_program"])
def test_no_nested_loops(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_sliced_windows_never_partition_samples_by_machine_alone(spark):
    events = changes.execution_events(samples_from_events(spark.read.parquet(f"{SF_DIR}/events.parquet")))
    sliced = ordered.slice_by_time(events, rows=50)
    followed = ordered.over_slices(sliced, lead={"n": F.col("timestamp")})
    exchanges = re.findall(r"Exchange hashpartitioning\(_key_machine_id#\d+, ([^)]*)", plan(followed))
    assert any("_slice" in keys for keys in exchanges)
    # The one exchange on machine_id alone holds a summary row per slice.
    borders = [line for line in plan(followed).splitlines() if re.search(r"hashpartitioning\(_key_machine_id#\d+, \d+\)", line)]
    assert len(borders) <= 1


def test_only_needed_columns_are_read(spark):
    text = plan(entry.queries()["activity_periods"](spark, SF_DIR))
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", text)) == {"ts:timestamp_ntz,user_id:bigint"}


def test_windows_over_one_order_share_a_sort(spark):
    events = changes.execution_events(samples_from_events(spark.read.parquet(f"{SF_DIR}/events.parquet")))
    both = ordered.over_slices(
        ordered.slice_by_offset(events), ordered.STREAM_ORDER,
        lag={"p": F.col("execution")}, lead={"n": F.col("timestamp")}, carry={"c": F.col("execution")},
    )
    # Once for the windows, once for the slices' ends, and once for a row per slice.
    assert len(re.findall(r"Exchange hashpartitioning", plan(both))) <= 3
    assert len(re.findall(r"\bSort \[", plan(both))) <= 4


def test_steps_of_one_order_share_one_scan_and_one_shuffle_of_rows(spark):
    events = changes.execution_events(samples_from_events(spark.read.parquet(f"{SF_DIR}/events.parquet")))
    once = ordered.over_slices(ordered.slice_by_offset(events), ordered.STREAM_ORDER, lead={"n": F.col("timestamp")})
    twice = ordered.over_slices(once, ordered.STREAM_ORDER, lag={"p": F.col("n")})
    twice.collect()
    text = plan(twice).split("== Initial Plan ==")[0]
    # Both steps and their summaries read the same shuffle; borders are joined by plain equality.
    assert text.count("FileScan") == 1 and "coalesce(machine_id" not in text
    assert text.count("ReusedExchange") >= 1


def test_machine_filter_reaches_the_scan(spark):
    stored = spark.read.parquet(f"{SF_DIR}/events.parquet").filter(F.col("user_id") == 3)
    assert "EqualTo(user_id,3)" in plan(stored)


def test_counts_are_combined_before_the_shuffle(spark):
    text = plan(entry.queries()["count_per_bucket"](spark, SF_DIR))
    assert text.index("partial_count") > text.index("Exchange")
