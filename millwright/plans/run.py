"""Run a named analysis from the command line: ``spark-submit millwright/plans/run.py JOB SAMPLES OUT``.

``SAMPLES`` is a Parquet table of flat samples or, with ``--messages``, a folder of topic records as
JSON lines. The result is written to ``OUT`` as Parquet.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millwright.operators import bins, changes, ingest, matching, periods, profile
from millwright.plans import jobs
from millwright.session import build_session
from millwright.sources import topic

# Each job takes samples and the parsed options.
JOBS: dict[str, Callable[[DataFrame, argparse.Namespace], DataFrame]] = {
    "active_spans": lambda s, o: jobs.active_spans(s, zone=o.zone, limit=o.limit),
    "active_per_machine_day": lambda s, o: jobs.active_per_machine_day(s, zone=o.zone),
    "most_recent_activity": lambda s, o: jobs.most_recent_activity(s, zone=o.zone),
    "execution_durations": lambda s, o: jobs.execution_durations(s, o.as_of_ms, o.zone),
    "execution_run_duration": lambda s, o: changes.execution_run_duration(s),
    "activity_periods": lambda s, o: periods.activity_periods(s, o.bucket_ms),
    "activity_periods_dense": lambda s, o: periods.activity_periods_dense(s, as_of_ms=o.as_of_ms),
    "sample_condition_runs": lambda s, o: periods.sample_condition_runs(periods.activity_periods_dense(s, as_of_ms=o.as_of_ms)),
    "sufficient_sample_periods": lambda s, o: periods.sufficient_sample_periods(periods.activity_periods_dense(s, as_of_ms=o.as_of_ms)),
    "executions": lambda s, o: jobs.executions(s, o.bucket_ms),
    "execution_distribution": lambda s, o: jobs.execution_distribution(s, o.bucket_ms, o.bin_ms),
    "execution_distribution_totals": lambda s, o: jobs.execution_distribution_totals(s, o.bucket_ms, o.bin_ms),
    "activity_hours": lambda s, o: jobs.activity_hours(s, o.bucket_ms, o.bin_ms),
    "completed_program_parts": lambda s, o: jobs.completed_program_parts(s),
    "part_completed_events": lambda s, o: matching.part_completed_events(s),
    "distinct_programs": lambda s, o: jobs.distinct_programs(s),
    "block_progression": lambda s, o: jobs.block_progression(s, o.machine, o.limit),
    "last_seen": lambda s, o: jobs.last_seen(s, o.zone),
    "meta_stats": lambda s, o: profile.meta_stats(s),
    "sessions": lambda s, o: periods.sessions(s),
}


def options(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("samples")
    parser.add_argument("out")
    parser.add_argument("--messages", action="store_true", help="the input holds topic records")
    parser.add_argument("--zone", default=jobs.clock.PLANT_ZONE)
    parser.add_argument("--bucket-ms", type=int, default=periods.BUCKET_MS)
    parser.add_argument("--bin-ms", type=int, default=bins.BIN_MS)
    parser.add_argument("--as-of-ms", type=int, help="end of what is still open; default the newest sample")
    parser.add_argument("--machine", help="machine of block_progression")
    parser.add_argument("--limit", type=lambda x: None if x == "all" else int(x), default=None, help="rows of active_spans and block_progression; default all")
    return parser.parse_args(arguments)


def run(spark: SparkSession, given: argparse.Namespace) -> None:
    if given.messages:
        samples = ingest.flatten(ingest.decode(topic.json_batch(spark, given.samples)))
    else:
        samples = spark.read.parquet(given.samples)
    JOBS[given.job](samples, given).write.mode("overwrite").parquet(given.out)


if __name__ == "__main__":
    run(build_session(), options())
