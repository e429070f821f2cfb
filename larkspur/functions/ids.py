"""Stable 64-bit ids of URIs and records: XXH64 with seed 0, as BIGINT bits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larkspur.types import POST

#: Spark's xxhash64 starts from 42 and lets each column's hash seed the next one's; hashing this number first leaves seed 0.
_SEED_ZERO = -365884300664092260


def xxh64(value: Column) -> Column:
    """XXH64 with seed 0 of a string's UTF-8 or of binary; null of null."""
    return F.when(value.isNotNull(), F.xxhash64(F.lit(_SEED_ZERO), value))


def uri_id(uri: Column) -> Column:
    return xxh64(uri.cast("string"))


def little_endian(number: Column) -> Column:
    """The eight bytes of a BIGINT, lowest first."""
    digits = F.lpad(F.hex(number), 16, "0")
    return F.unhex(F.concat(*[F.substring(digits, i, 2) for i in range(15, 0, -2)]))


def record_id(tag: str, did_id: Column, rkey: Column) -> Column:
    """XXH64 of the tag, a zero byte, the author's id in little-endian bytes and the record key."""
    return xxh64(F.concat(F.lit(tag.encode() + b"\0"), little_endian(did_id), rkey.cast("binary")))


def post_uri(did: Column, rkey: Column) -> Column:
    return F.concat(F.lit("at://"), did, F.lit(f"/{POST}/"), rkey)
