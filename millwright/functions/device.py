"""Device rules over raw readings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Axis unit names by unit code.
AXIS_UNITS = (
    "mm", "inch", "degree", "mm/minute", "inch/minute", "rpm", "mm/round", "inch/round",
    "%", "Ampere", "Second",
)


def execution_state(run: Column, motion: Column, mstb: Column) -> Column:
    return (
        F.when(run.isin(3, 4), "ACTIVE")
        .when((run == 2) | (motion == 2) | (mstb != 0), "INTERRUPTED")
        .when(run == 0, "STOPPED")
        .otherwise("READY")
    )


def operating_mode(aut: Column) -> Column:
    return F.when(aut.isin(5, 6), "MANUAL").when(aut.isin(0, 3), "MANUAL_DATA_INPUT").otherwise("AUTOMATIC")


def emergency_stop(emergency: Column) -> Column:
    return F.when(emergency == 1, "TRIGGERED").otherwise("ARMED")


def scaled(raw: Column, exponent: Column) -> Column:
    """Each raw integer divided by ten to its own number of decimals."""
    return F.zip_with(raw, exponent, lambda v, e: v / F.pow(F.lit(10.0), e))


def cycle_time_ms(minutes: Column, milliseconds: Column) -> Column:
    return minutes * 60_000 + milliseconds


def machine_id(*words: Column) -> Column:
    """Four 32-bit ids as lower-case hex, eight digits each."""
    return F.concat_ws("-", *[F.lpad(F.lower(F.hex(w)), 8, "0") for w in words])


def axis_unit(code: Column) -> Column:
    """The unit's name, null for an unknown code."""
    names = F.array(*map(F.lit, AXIS_UNITS))
    return F.when(code.between(0, len(AXIS_UNITS) - 1), F.get(names, code.cast("int")))


def valid_port(text: Column) -> Column:
    """The port number, or null when it is no integer in the accepted range."""
    port = F.trim(text).try_cast("int")
    return F.when((port > 0) & (port < 65535), port)
