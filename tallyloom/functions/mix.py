"""Deterministic pseudo-random integers by plain integer arithmetic.

A key always gets the same values, whatever the partitioning, retries or lost executors;
``rand()`` promises none of that.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MODULUS = 2_147_483_647


def mixed(key: Column, salt: int) -> Column:
    """Spread a non-negative key over 0..MODULUS-1; salts give unrelated sequences.

    The squaring step breaks the straight lattice that linear steps alone leave on
    consecutive keys. Every product stays below 2**63.
    """
    key = key.cast("bigint")
    low, high = key.bitwiseAND(MODULUS), F.shiftright(key, 31)
    first = (low * 16807 + high * 69621 + salt * 7919) % MODULUS
    second = (first * first + salt) % MODULUS
    return (second * 48271 + first) % MODULUS


# Salt of the second draw of a wide number.
WIDE = 1_000


def wide(key: Column, salt: int) -> Column:
    """Spread a key over 62 bits: two draws of 31 bits, joined."""
    return mixed(key, salt) * 2_147_483_648 + mixed(key, salt + WIDE)


def pick_int(key: Column, salt: int, low: int, high: int) -> Column:
    """Uniform integer in low..high, both included, for ranges far below 2**31."""
    return mixed(key, salt) % (high - low + 1) + low


def pick_wide(key: Column, salt: int, low: int, high: int | Column) -> Column:
    """Uniform integer in low..high, both included, for ranges far below 2**62."""
    return wide(key, salt) % (high - low + 1) + low


def pick(key: Column, salt: int, values: list[str]) -> Column:
    """Uniform choice from a small literal list."""
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, pick_int(key, salt, 1, len(values)).cast("int"))
