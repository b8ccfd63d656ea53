"""Record schemas: the raw message, the flat sample, and the records derived from them."""

from __future__ import annotations

from pyspark.sql import types as T

I, L, S, D = T.IntegerType(), T.LongType(), T.StringType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


# Field names and types of the axis record, the 45 value fields and the 12
# timing keys, in message order. Load is a double because the devices send fractions.
AXIS = _struct(
    ("id", S), ("name", S), ("index", I), ("suffix", S), ("divisor", L),
    ("flag", I), ("unit", I), ("unith", S), ("decimal", I),
)
VALUES = _struct(
    ("max_axis", I), ("addinfo", I), ("cnc_type", S), ("mt_type", S), ("series", S),
    ("version", S), ("axes_count_chk", S), ("axes_count", I), ("ether_type", I),
    ("ether_device", I), ("axes", T.ArrayType(AXIS)), ("alarm", I), ("hdck", I),
    ("tool_group", I), ("message_number", I), ("message_text", S), ("mprogram", I),
    ("part_count", L), ("mode", S), ("estop", S), ("aut", I), ("emergency", I), ("run", I),
    ("execution", S), ("tool_id", I), ("sequence", I), ("cprogram", I),
    ("program_number", I), ("program_header", S), ("mstb", I), ("edit", I), ("block", S),
    ("motion", I), ("actf", L), ("acts", L), ("actual", T.ArrayType(D)),
    ("relative", T.ArrayType(D)), ("absolute", T.ArrayType(D)), ("load", T.ArrayType(D)),
    ("block_num", L), ("cycle_time", L), ("program_name", S), ("program_path", S),
    ("program", S), ("program_size", L),
)
META_KEYS = (
    "info", "part_count", "cycle_time", "status", "tool", "dynamic", "message",
    "program_name", "program", "program_header", "block", "total",
)
STATES = ("ACTIVE", "STOPPED", "INTERRUPTED", "READY")
LEGACY_TEXT = ("program_name_alt", "program_path_alt", "program_number_alt")

ARRAY_FIELDS = tuple(f.name for f in VALUES if isinstance(f.dataType, T.ArrayType))
VALUE_FIELDS = tuple(VALUES.names)

MESSAGE = _struct(("values", VALUES), ("meta", T.MapType(S, L)))

# A topic record as the Kafka source delivers it, with key and value already text.
TOPIC_RECORD = _struct(
    ("key", S), ("value", S), ("partition", I), ("offset", L), ("timestamp", T.TimestampType()),
)

_ID = (("machine_id", S), ("offset", L), ("timestamp", L), ("partition", I))

FLAT = _struct(
    *_ID,
    *((f.name, S if f.name in ARRAY_FIELDS else f.dataType) for f in VALUES),
    *((f"meta_{k}", L) for k in META_KEYS),
)
EXECUTION = _struct(
    ("machine_id", S), ("execution", S), ("timestamp", L), ("offset", L), ("partition", I),
)
EXECUTION_RUN = _struct(
    ("machine_id", S), ("execution", S), ("start", L), ("end", L),
    ("offset", L), ("partition", I), ("duration", L),
)
EXECUTION_SESSION = _struct(*((f.name, f.dataType) for f in EXECUTION), ("session", L))
PART_COMPLETED = _struct(
    ("machine_id", S), ("timestamp", L), ("offset", L), ("part_count", L),
    ("part_count_timestamp", L), ("program", S), ("program_hash", S), ("program_timestamp", L),
)
