"""Typed fields out of a raw JSON payload (``variant``)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmeter.functions.times import try_timestamp
from fleetmeter.functions.values import NULL_TOKENS, null_if_tokens
from fleetmeter.schemas import PAYLOAD_FIELDS


def payload_field(payload: Column, name: str, type_: str, on_bad_value: str = "fail") -> Column:
    """One field cast to a type; a value that does not fit fails or becomes NULL."""
    if on_bad_value not in ("fail", "null"):
        raise ValueError(f"on_bad_value must be 'fail' or 'null', not {on_bad_value!r}")
    get = F.variant_get if on_bad_value == "fail" else F.try_variant_get
    return get(payload, f"$.{name}", type_)


def extract_readings(
    bronze: DataFrame,
    fields: Mapping[str, str] = PAYLOAD_FIELDS,
    on_bad_value: str = "fail",
    null_tokens: Sequence[str] = NULL_TOKENS,
) -> DataFrame:
    """Bronze rows to typed readings.

    Texts that stand for NULL become NULL; without ``null_tokens`` they are kept. Fields are
    taken out in one projection, before any shuffle, so the variant itself is never moved.
    ``timestamp`` becomes ``reading_time``, NULL when it cannot be parsed.
    """
    payload = F.col("json_data")

    def field(name: str, type_: str) -> Column:
        value = payload_field(payload, name, type_, on_bad_value)
        return null_if_tokens(value, null_tokens) if type_ == "string" and null_tokens else value

    columns = [field(name, type_).alias(name) for name, type_ in fields.items()]
    passed = [c for c in bronze.columns if c != "json_data"]
    readings = bronze.select(*columns, *passed)
    if "timestamp" in fields:
        readings = readings.withColumn("reading_time", try_timestamp(F.col("timestamp")))
    return readings
