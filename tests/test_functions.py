"""Column functions."""

import pytest
from pyspark.sql import functions as F

from millwright.functions import clock, device, text


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


@pytest.mark.parametrize(
    "program, header",
    [
        ("O1", "O1"),
        ("O1\n", "O1 "),
        ("O1(A)\nG91", "O1(A) G91"),
        ("%\nO1(A)\n(B)\n#1=2\n\n X\nG00\n(C)", "% O1(A) (B) #1=2   X"),
        ("a\n\nb", "a "),
        ("a\nb\n", "a b"),
        ("", ""),
    ],
)
def test_program_header(spark, program, header):
    assert value(spark, text.program_header(F.lit(program))) == header


def test_program_header_of_a_very_long_program(spark):
    comments = F.concat(F.lit("%\nO1\n"), F.repeat(F.lit("(X)\n"), 200_000), F.lit("G00\n"))
    assert value(spark, F.length(text.program_header(comments))) == 4 + 200_000 * 4


def test_text(spark):
    assert value(spark, text.one_line(F.lit("a\n\r\nb\rc"))) == "a b c"
    assert value(spark, text.first_line(F.lit("N1 G0\nN2"))) == "N1 G0"
    assert value(spark, text.first_line(F.lit("N1"))) == "N1"
    assert value(spark, text.content_hash(F.lit("abc"))) == "a9993e364706816aba3e25717850c26c9cd0d89d"


@pytest.mark.parametrize(
    "run, motion, mstb, state",
    [
        (3, 2, 1, "ACTIVE"), (4, 0, 0, "ACTIVE"), (2, 0, 0, "INTERRUPTED"), (0, 2, 0, "INTERRUPTED"),
        (0, 0, 1, "INTERRUPTED"), (0, 0, 0, "STOPPED"), (1, 0, 0, "READY"),
    ],
)
def test_execution_state(spark, run, motion, mstb, state):
    assert value(spark, device.execution_state(F.lit(run), F.lit(motion), F.lit(mstb))) == state


def test_device(spark):
    assert [value(spark, device.operating_mode(F.lit(a))) for a in (5, 6, 0, 3, 1)] == [
        "MANUAL", "MANUAL", "MANUAL_DATA_INPUT", "MANUAL_DATA_INPUT", "AUTOMATIC",
    ]
    assert value(spark, device.emergency_stop(F.lit(1))) == "TRIGGERED"
    assert value(spark, device.emergency_stop(F.lit(2))) == "ARMED"
    raw = F.array(F.lit(1500), F.lit(25))
    assert value(spark, device.scaled(raw, F.array(F.lit(3), F.lit(0)))) == [1.5, 25.0]
    assert value(spark, device.cycle_time_ms(F.lit(2), F.lit(30))) == 120_030
    words = [F.lit(w) for w in (0x1A, 0xBC91F2D0, 0, 0xFFFFFFFF)]
    assert value(spark, device.machine_id(*words)) == "0000001a-bc91f2d0-00000000-ffffffff"
    assert value(spark, device.axis_unit(F.lit(10))) == "Second"
    assert value(spark, device.axis_unit(F.lit(11))) is None
    assert value(spark, device.axis_unit(F.lit(-1))) is None


@pytest.mark.parametrize(
    "given, port", [("1", 1), (" 8193 ", 8193), ("65534", 65534), ("65535", None), ("0", None), ("-4", None), ("x", None), (None, None)]
)
def test_port(spark, given, port):
    assert value(spark, device.valid_port(F.lit(given).cast("string"))) == port


def test_clock(spark):
    at = F.lit(1_704_067_200_987)
    assert value(spark, clock.to_second(at)) == 1_704_067_200_000
    assert str(value(spark, clock.local_time(clock.truncated(at)))) == "2023-12-31 19:00:00"
    assert str(value(spark, clock.local_date(clock.exact(at)))) == "2023-12-31"
    assert value(spark, clock.local_iso(clock.exact(at))) == "2023-12-31T19:00:00"
    assert value(spark, clock.hours(F.lit(5_400_000))) == 1.5
