"""Scalar value functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for NULL in delivered files.
NULL_TOKENS = ("NULL", "")

# Ties such as 2.675 are not exact in binary; this step puts them on the upper side
# before rounding, so that the result does not depend on the order of a sum.
_TIE_STEP = 1e-9


def round_fixed(x: Column, digits: int) -> Column:
    """Round half away from zero, stable against the last bits of a float sum."""
    return F.round(x + F.signum(x) * F.lit(_TIE_STEP), digits)


def null_if_tokens(text: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    return F.when(~text.isin(*tokens), text)


def out_of_range(x: Column, low: float, high: float) -> Column:
    """True only for a present value outside ``[low, high]``; never NULL."""
    return F.when((x < low) | (x > high), True).otherwise(False)


def mask_text(text: Column) -> Column:
    """Every letter and digit becomes ``*``; punctuation stays."""
    return F.regexp_replace(text, "[a-zA-Z0-9]", "*")
