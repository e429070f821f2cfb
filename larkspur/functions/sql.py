"""The scalar functions under names for SQL text, as temporary SQL functions: the planner sees through them."""

from __future__ import annotations

from pyspark.sql import SparkSession

from larkspur.functions.ids import _SEED_ZERO
from larkspur.functions.tids import _DIGITS
from larkspur.types import POST, TID_ALPHABET

FUNCTIONS = {
    "uri_id": ("uri STRING", "BIGINT", f"CASE WHEN uri IS NOT NULL THEN xxhash64({_SEED_ZERO}L, uri) END"),
    "post_uri": ("did STRING, rkey STRING", "STRING", f"concat('at://', did, '/{POST}/', rkey)"),
    "tid_micros": ("rkey STRING", "BIGINT", f"CASE WHEN octet_length(rkey) = 13 AND rkey RLIKE r'\\A[2-7a-z]{{13}}\\z' THEN CAST(conv(translate(substr(rkey, 1, 11), '{TID_ALPHABET}', '{_DIGITS}'), 32, 10) AS BIGINT) & {(1 << 54) - 1}L END"),
    "tid_to_ts": ("rkey STRING", "TIMESTAMP_NTZ", "TIMESTAMP_NTZ '1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, CAST(CAST(tid_micros(rkey) AS DECIMAL(18,0)) / 1000000 AS DECIMAL(18,6)))"),
}


def register(spark: SparkSession) -> None:
    """Define them all in the session; the last one uses the one before."""
    for name, (arguments, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {kind} RETURN {body}")
