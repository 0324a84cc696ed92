"""Scalar helpers as column expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

# Odd multipliers (one per salt) and modulus of the multiplicative row hash.
HASH_MULTIPLIERS = (2654435761, 2246822519, 3266489917)
HASH_MODULUS = 1 << 32
HIGH_MULTIPLIER = 1103515245


def scale_and_round(c: Column, factor: float = 10.0, digits: int = 0) -> Column:
    """Multiply and round half to even."""
    return F.bround(c * F.lit(factor), digits)


def ratio(numerator: Column, denominator: Column, epsilon: float = 0.0) -> Column:
    """Division that gives null, not an error, where the divisor is zero."""
    return F.try_divide(numerator, denominator + F.lit(epsilon))


def md5_upper(c: Column) -> Column:
    return F.upper(F.md5(c))


def zero_pad(c: Column, width: int = 4) -> Column:
    """Left pad with zeros; longer text stays whole."""
    text = c.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def run_id() -> Column:
    """One random identifier per call, the same on every row."""
    return F.lit(str(uuid.uuid4()))


def row_hash(key: Column, salt: int = 0) -> Column:
    """Hash of an integer key in [0, 2^32): depends on the key only, not on the row layout.

    Splits within splits need different salts: with the same one, the part held
    out inside a training part would be empty.
    """
    whole = key.cast("bigint")
    # The bits from 31 up are folded in; keys below 2^31 keep their hash.
    high = F.pmod(F.shiftright(whole, 31), F.lit(1 << 31)) * F.lit(HIGH_MULTIPLIER)
    low = F.pmod(F.pmod(whole, F.lit(1 << 31)) + F.pmod(high, F.lit(1 << 31)), F.lit(1 << 31))
    return F.pmod(low * F.lit(HASH_MULTIPLIERS[salt]), F.lit(HASH_MODULUS))
