"""Bounded samples of rows to fit a model on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PARTS = 1 << 20


def per_label(df: DataFrame, label: str, key: Column, rows: int) -> DataFrame:
    """About ``rows`` rows of each value of ``label``, and no more than twice as many of all
    values together: those whose key has the smallest hashes. Equal input gives the same rows.
    Labels that are NULL are left out."""
    df = df.where(F.col(label).isNotNull())
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    part = F.pmod(F.xxhash64(key), F.lit(_PARTS))
    share = F.lit(0)
    for value, n in counts.items():
        share = F.when(F.col(label) == F.lit(value), F.lit(-(-rows * _PARTS // n))).otherwise(share)
    return df.where(part < share).orderBy(part, key).limit(2 * rows * max(1, len(counts)))
