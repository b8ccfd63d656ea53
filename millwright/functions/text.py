"""Program and block text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def one_line(text: Column | str) -> Column:
    """Runs of line breaks become one space."""
    return F.regexp_replace(text, "[\n\r]+", " ")


def first_line(text: Column | str) -> Column:
    return F.substring_index(text, "\n", 1)


def content_hash(text: Column | str) -> Column:
    return F.sha1(text)


def present(text: Column | str) -> Column:
    """Neither null nor empty."""
    col = F.col(text) if isinstance(text, str) else text
    return col.isNotNull() & (col != "")


def program_header(text: Column | str) -> Column:
    """The opening comment block of a program on one line.

    The first two lines always belong to it. It ends at the first later line break that is not
    followed by a comment, a macro, a space or another line break. Splitting at that line break
    avoids a repeated regex group, which overflows the stack on long programs.
    """
    text = F.col(text) if isinstance(text, str) else text
    at = F.instr(text, "\n")
    rest = F.split(F.substr(text, at + 1), "\n(?![(\n #])", 2)[0]
    return F.when(at == 0, text).otherwise(
        F.concat_ws(" ", first_line(text), F.translate(rest, "\n", " "))
    )
