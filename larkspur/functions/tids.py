"""Timestamps in record keys: 13 characters of 5 bits, microseconds above a 10-bit clock id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larkspur.types import TID_ALPHABET

_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def tid_micros(rkey: Column) -> Column:
    """Microseconds of a record key; null unless it is 13 characters of the alphabet. 65 bits are folded into 64, so the first character's top bit is lost."""
    whole = (F.octet_length(rkey) == 13) & rkey.rlike(r"\A[2-7a-z]{13}\z")
    number = F.conv(F.translate(F.substring(rkey, 1, 11), TID_ALPHABET, _DIGITS), 32, 10).cast("bigint")
    return F.when(whole, number.bitwiseAND(F.lit((1 << 54) - 1)))


def tid_time(rkey: Column) -> Column:
    """The same as TIMESTAMP_NTZ in UTC, whatever the session's time zone."""
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(secs=(tid_micros(rkey).cast("decimal(18,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)"))


def tid_encode(micros: Column, clock: int | Column = 7) -> Column:
    """The record key of non-negative microseconds below 2**54 and a clock id of 0 to 1023."""
    clock = F.lit(clock) if isinstance(clock, int) else clock
    digits = F.concat(F.lpad(F.lower(F.conv(micros.cast("string"), 10, 32)), 11, "0"), F.lpad(F.lower(F.conv(clock.cast("string"), 10, 32)), 2, "0"))
    return F.translate(digits, _DIGITS.lower(), TID_ALPHABET)
