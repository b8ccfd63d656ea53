"""Fleet monitoring: status log, probe log, machine registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.operators.keyed import latest_per_key

def status_log(updates: DataFrame) -> DataFrame:
    """Log rows: id, machine_id, status, status_message, ts; any status text is kept, null too."""
    return updates.select("id", "machine_id", "status", "status_message", "ts")


def current_status(log: DataFrame, known: DataFrame) -> DataFrame:
    """Newest log row of each known machine; machines without a log row are left out."""
    newest = latest_per_key(log, "machine_id", F.col("id"), ("status", "id", "ts"))
    return newest.join(known.select("machine_id"), "machine_id").select(
        "machine_id", F.col("status").alias("status_text"), F.col("id").alias("status_id"), "ts"
    )


def status_report(current: DataFrame) -> DataFrame:
    return current.withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))


def ping_rows(probes: DataFrame) -> DataFrame:
    """Probe results with the axis names trimmed."""
    return probes.withColumn("machine_axes", F.transform("machine_axes", lambda axis: F.trim(axis)))


def latest_ping(pings: DataFrame) -> DataFrame:
    fields = ("machine_id", "machine_ip", "machine_port")
    return pings.agg(F.max_by(F.struct(*fields), F.struct("date", "id")).alias("p")).select("p.*")


def accepted_requests(requests: DataFrame, pings: DataFrame) -> DataFrame:
    """Requests equal to the newest ping in all three fields."""
    newest = pings.agg(
        F.max_by(F.struct("machine_id", "machine_ip", "machine_port"), F.struct("date", "id"))
    ).scalar()
    asked = F.struct("machine_id", "machine_ip", "machine_port")
    return requests.filter(asked == newest)


def registry_upsert(machines: DataFrame, accepted: DataFrame, now: Column) -> DataFrame:
    """The registry after the accepted requests: new addresses overwrite, new machines are added."""
    wanted = accepted.groupBy("machine_id").agg(
        F.max(F.struct("machine_ip", "machine_port")).alias("_new")
    )
    both = machines.withColumn("_known", F.lit(True)).join(wanted, "machine_id", "full_outer")
    updated = F.col("_known").isNotNull() & F.col("_new").isNotNull()
    added = F.col("_known").isNull()
    return both.select(
        "machine_id",
        F.coalesce("_new.machine_ip", "machine_ip").alias("machine_ip"),
        F.coalesce("_new.machine_port", "machine_port").alias("machine_port"),
        F.when(updated, now).otherwise(F.col("modified_at")).alias("modified_at"),
        F.when(added, now).otherwise(F.col("created_at")).alias("created_at"),
    )


def registry_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Inserted, updated and deleted rows between two snapshots as change payloads.

    The payload is the new row as JSON, null for a delete; unchanged machines give no row.
    """
    fields = [c for c in new.columns if c != "machine_id"]
    before = old.select("machine_id", F.struct(*fields).alias("_old"))
    after = new.select("machine_id", F.struct(*fields).alias("_new"), F.struct(*new.columns).alias("_row"))
    changed = before.join(after, "machine_id", "full_outer").filter(
        ~F.col("_old").eqNullSafe(F.col("_new"))
    )
    event = F.struct("machine_id", F.col("_row").alias("payload"))
    return changed.select("machine_id", F.to_json(event, {"ignoreNullFields": "false"}).alias("event"))
