"""Named SQL relations the checking queries are put together from."""

from __future__ import annotations

import re

_MS = "epoch_us(ts)//1000"

RELATIONS: dict[str, str] = {
    "samples": f"""
        SELECT 'm' || (user_id % 6) AS machine_id, event_id AS "offset", {_MS} AS "timestamp",
          CAST(user_id % 6 AS INTEGER) AS "partition",
          CASE event_type WHEN 'purchase' THEN 'ACTIVE' WHEN 'click' THEN 'INTERRUPTED'
            WHEN 'view' THEN 'READY' WHEN 'signup' THEN 'STOPPED' END AS execution,
          CASE WHEN event_type='purchase' THEN CAST(floor(value/10) AS BIGINT) END AS part_count,
          CASE WHEN event_type='signup' THEN 'O000' || (event_id % 7) || chr(10) || chr(13) || 'G91' END AS program,
          CAST(event_id % 50 AS INTEGER) AS sequence,
          CASE WHEN event_type='signup' THEN CAST(user_id % 9 AS INTEGER) END AS mprogram,
          CASE WHEN event_type IN ('signup','click') THEN CAST(event_id % 11 AS INTEGER) END AS cprogram,
          CASE WHEN event_type='click' THEN CAST(event_id % 13 AS INTEGER) END AS program_number,
          CASE WHEN event_type='error' THEN '//CNC_MEM/O' || (event_id % 7) END AS program_path_alt,
          CASE WHEN event_type='click' THEN 'G01X' || CAST(floor(value) AS BIGINT)
            WHEN event_type='view' THEN '' END AS block,
          CASE WHEN event_type='click' THEN CAST(floor(value) AS BIGINT) END AS block_num,
          CAST(floor(value*100) AS BIGINT) AS meta_total,
          CASE WHEN event_type IN ('view','error') THEN user_id END AS meta_status
        FROM events""",
    "readings": f"""
        SELECT 'm' || (user_id % 6) AS machine_id, event_id AS "offset", {_MS} AS "timestamp",
          CAST(user_id % 6 AS INTEGER) AS "partition",
          CAST(CAST(floor(value) AS INTEGER) % 6 AS INTEGER) AS run,
          CAST(user_id % 4 AS INTEGER) AS motion,
          CAST(length(event_type) % 3 AS INTEGER) AS mstb,
          CAST(CAST(floor(value) AS INTEGER) % 9 AS INTEGER) AS aut,
          CAST(event_id % 2 AS INTEGER) AS emergency,
          CAST((event_id // 7) % 3 AS INTEGER) AS cprogram,
          CAST((event_id // 31) % 4 AS INTEGER) AS mprogram,
          CAST(event_id // 11 AS BIGINT) AS part_count,
          props AS program,
          CAST(floor(value) AS BIGINT) AS cycle_time
        FROM events""",
    "execs": """
        SELECT machine_id, execution, "timestamp", "offset", "partition"
        FROM samples WHERE execution IS NOT NULL AND execution <> ''""",
    "buckets": """
        SELECT machine_id, "timestamp" - "timestamp" % {bucket} AS bucket, count(*) AS cnt
        FROM samples GROUP BY ALL""",
    "islands": """
        SELECT machine_id, bucket, cnt, dense_rank() OVER (PARTITION BY machine_id ORDER BY origin) AS g
        FROM (SELECT *, bucket - {bucket} * row_number() OVER (PARTITION BY machine_id ORDER BY bucket) AS origin
              FROM buckets)""",
    "periods": """
        SELECT machine_id, a, b, b - a AS duration,
          row_number() OVER (PARTITION BY machine_id ORDER BY a) AS r, cnt
        FROM (SELECT machine_id, min(bucket) AS a, max(bucket) + {bucket} AS b, CAST(sum(cnt) AS BIGINT) AS cnt
              FROM islands GROUP BY machine_id, g)""",
    "placed": """
        SELECT machine_id, p.a, p.b, p.r, e."timestamp", e."offset", e.execution
        FROM execs e JOIN periods p USING (machine_id) WHERE e."timestamp" BETWEEN p.a AND p.b - 1""",
    "placed_lag": """
        SELECT *, lag(execution) OVER (PARTITION BY machine_id, r ORDER BY "timestamp", "offset") AS p FROM placed""",
    "runs": """
        SELECT machine_id, "timestamp" AS start,
          coalesce(nxt, b) AS "end", coalesce(nxt, b) - "timestamp" AS duration, execution, r
        FROM (SELECT *, lead("timestamp") OVER (PARTITION BY machine_id, r ORDER BY "timestamp", "offset") AS nxt
              FROM placed_lag WHERE p IS NULL OR execution <> p)""",
    "bins": """
        SELECT unnest(range(low - low % 3600000, high + 1, {width})) AS b
        FROM (SELECT min(start) AS low, max("end") AS high FROM runs)""",
    "clipped": """
        SELECT machine_id, execution, b, start, least(b + {width}, "end") - greatest(b, start) AS overlap_ms
        FROM bins, runs WHERE start < b + {width} AND b < "end" """,
    "strict_clipped": "SELECT * FROM clipped WHERE start <> b",
    "totals": """
        SELECT machine_id, b, """ + ", ".join(
            f"CAST(coalesce(sum(overlap_ms) FILTER (execution = '{s}'), 0) AS BIGINT) AS {s.lower()}"
            for s in ("ACTIVE", "STOPPED", "INTERRUPTED", "READY")
        ) + """
        FROM clipped GROUP BY machine_id, b""",
    "changes": """
        SELECT machine_id, execution, "timestamp", "offset", "partition" FROM
          (SELECT *, lag(execution) OVER (PARTITION BY machine_id ORDER BY "partition", "offset") AS p FROM execs)
        WHERE p IS NULL OR execution <> p""",
    "spans": """
        SELECT *, stop - start AS duration FROM (
          SELECT machine_id, execution, "offset", "timestamp" // 1000 * 1000 AS start, stop // 1000 * 1000 AS stop, "timestamp"
          FROM (SELECT *, lead("timestamp") OVER (PARTITION BY machine_id ORDER BY "timestamp", "offset") AS stop FROM execs)
          WHERE stop IS NOT NULL)""",
    "series": """
        SELECT unnest(range(low - low % 3600000, high + 1, {dense})) AS a
        FROM (SELECT min("timestamp") AS low, max("timestamp") AS high FROM samples)""",
    "spine": """
        SELECT machine_id, a, a + {dense} AS b FROM series, (SELECT DISTINCT machine_id FROM samples)""",
    "dense": """
        SELECT machine_id, a, b, (SELECT count(*) FROM samples t WHERE t.machine_id = s.machine_id
          AND t."timestamp" BETWEEN s.a AND s.b - 1) AS "count" FROM spine s""",
    "dense_islands": """
        SELECT *, row_number() OVER (PARTITION BY machine_id ORDER BY a)
          - row_number() OVER (PARTITION BY machine_id, cond ORDER BY a) AS origin
        FROM (SELECT *, "count" < {threshold} AS cond FROM dense)""",
    "condition_runs": """
        SELECT machine_id, min(a) AS a, max(b) AS b, cond, max(b) - min(a) AS diff
        FROM dense_islands GROUP BY machine_id, origin, cond""",
    "sessions": """
        SELECT machine_id, min("timestamp") AS "windowStart", max("timestamp") AS "windowEnd", count(*) AS "count" FROM (
          SELECT *, sum(CASE WHEN p IS NULL OR "timestamp" - p > {gap} THEN 1 ELSE 0 END)
            OVER (PARTITION BY machine_id ORDER BY "timestamp", "offset") AS g
          FROM (SELECT *, lag("timestamp") OVER (PARTITION BY machine_id ORDER BY "timestamp", "offset") AS p FROM samples))
        GROUP BY machine_id, g""",
    "parts": """
        SELECT machine_id, "timestamp", "offset", "partition", part_count
        FROM samples WHERE part_count IS NOT NULL AND part_count > 0""",
    "part_changes": """
        SELECT * FROM (SELECT *, lag(part_count) OVER (PARTITION BY machine_id ORDER BY "partition", "offset") AS p FROM parts)
        WHERE p IS NULL OR part_count <> p""",
    "loads": """
        SELECT machine_id, "timestamp", "offset", "partition", sha1(program) AS hash, program AS contents
        FROM samples WHERE program IS NOT NULL AND program <> ''""",
    "increases": """
        SELECT * FROM (
          SELECT machine_id, "timestamp" // 1000 * 1000 AS "timestamp", "offset", part_count,
            lag(part_count) OVER (PARTITION BY machine_id ORDER BY "timestamp" // 1000, "offset") AS p
          FROM parts) WHERE part_count > p""",
    "loads_by_second": """
        SELECT machine_id, "timestamp" // 1000 * 1000 AS "timestamp", arg_max(program, "offset") AS program, count(*) AS n
        FROM samples WHERE program IS NOT NULL GROUP BY ALL""",
}

POSITION = ("program_number", "program_path_alt", "mprogram", "cprogram", "sequence", "block", "block_num")
_AS_TEXT = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in POSITION)
UNPIVOTED = f"""
    SELECT * FROM (UNPIVOT (SELECT machine_id, "timestamp", "offset", {_AS_TEXT} FROM samples)
      ON {", ".join(POSITION)} INTO NAME "key" VALUE "value")"""

# Parameters the checks run with.
PARAMETERS = {
    "bucket": 1_800_000, "width": 300_000, "dense": 1_800_000, "threshold": 10, "gap": 1_800_000,
}


def sql(body: str, **parameters: int) -> str:
    """``body`` with a WITH clause for every relation it needs, in order of dependency."""
    values = {**PARAMETERS, **parameters}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in RELATIONS:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(RELATIONS[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    for name, value in values.items():
        body = body.replace("{" + name + "}", str(value))
    ctes = []
    for name in needed:
        text = RELATIONS[name]
        for parameter, value in values.items():
            text = text.replace("{" + parameter + "}", str(value))
        ctes.append(f"{name} AS ({text})")
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body
