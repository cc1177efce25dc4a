"""Guarded parsing of raw text.

Patterns are anchored with ``\\A`` and ``\\z``: Java's ``$`` would also accept a
trailing newline. Casts are always ``try_cast``, as a filter placed before a cast
does not protect it once the optimizer has moved either of them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The shapes a raw field must have to be accepted.
ISO_TIMESTAMP = r"\A\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"
SIGNED_NUMBER = r"\A-?\d+(\.\d+)?\z"
UNSIGNED_NUMBER = r"\A\d+(\.\d+)?\z"
SIGNED_INTEGER = r"\A-?\d+\z"
UNSIGNED_INTEGER = r"\A\d+\z"
BELOW_ZERO = r"\A-[0.]*[1-9]"


def is_blank(column: str) -> Column:
    """Null, empty or spaces only."""
    return F.col(column).isNull() | (F.trim(column) == "")


def blank_to_null(column: str) -> Column:
    trimmed = F.trim(column)
    return F.when(trimmed != "", trimmed)


def iso_timestamp(column: str) -> Column:
    """Text of the form ``yyyy-MM-dd HH:mm:ss`` as a zone-free timestamp, else null."""
    return F.when(F.col(column).rlike(ISO_TIMESTAMP), F.col(column).try_cast("timestamp_ntz"))


def below_zero(column: str) -> Column:
    """True for a well-formed number under zero; ``-0`` is not under zero. Null stays null."""
    return F.col(column).rlike(SIGNED_NUMBER) & F.col(column).rlike(BELOW_ZERO)


def rounded_number(column: str, to: str) -> Column:
    """Text such as ``225.0`` as a whole number, rounded half up as a numeric cast would."""
    number = F.round(F.col(column).try_cast("decimal(20,6)"), 0)
    return F.when(F.col(column).rlike(UNSIGNED_NUMBER), number.try_cast(to))


def state_code(column: str) -> Column:
    """Two-letter code in upper case; anything of another length is unknown."""
    return F.when(F.length(F.trim(column)) == 2, F.upper(F.trim(column)))


def lower_trim(column: str) -> Column:
    return F.lower(F.trim(column))
