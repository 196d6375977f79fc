"""Counter-based randomness.

Every random value is a function of a seed and the row's keys, so results do not
depend on partitioning, retries or lost executors.  One md5 gives 32 hex digits;
operators that need several draws read different digits of the same hash.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_32 = 4294967296.0
_TWO_52 = 4503599627370496.0


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once per row, however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def key_text(*keys) -> Column:
    """Join keys (column names, Columns or literals marked with F.lit) with '|'."""
    cols = [F.col(k) if isinstance(k, str) else (k if isinstance(k, Column) else F.lit(k)) for k in keys]
    return F.concat_ws("|", *[c.cast("string") for c in cols])


def order_key(seed: int, *keys) -> Column:
    """Hex md5 of seed and keys: a reproducible shuffle order."""
    return F.md5(key_text(F.lit(seed), *keys))


def hex_uniform(h: Column, at: int = 1) -> Column:
    """Uniform double in [0, 1) from eight hex digits of ``h`` starting at ``at``."""
    return F.conv(F.substring(h, at, 8), 16, 10).cast("double") / F.lit(_TWO_32)


def hex_uniform_wide(h: Column, at: int = 1) -> Column:
    """Like hex_uniform with 52 bits: reaches every index of a table of any size."""
    return F.conv(F.substring(h, at, 13), 16, 10).cast("double") / F.lit(_TWO_52)


def uniform(seed: int, *keys) -> Column:
    return hex_uniform(order_key(seed, *keys))


PRIME = 2147483647


def coefficients(h: Column) -> Column:
    """Four numbers below PRIME from an md5: the coefficients of a cubic hash."""
    return F.struct(*[(F.conv(F.substring(h, 8 * k + 1, 8), 16, 10).cast("long") % PRIME).alias(f"c{k}") for k in range(4)])


def cubic(c: Column, i: Column) -> Column:
    """Cubic polynomial of i modulo PRIME: four-wise independent numbers for the places of a
    row at a few integer operations each, instead of a hash per place."""
    i = i.cast("long")
    return (((c.c0 * i + c.c1) % PRIME * i + c.c2) % PRIME * i + c.c3) % PRIME


def cubic_uniform(c: Column, i: Column) -> Column:
    return cubic(c, i).cast("double") / F.lit(float(PRIME))


def py_hash(*keys) -> str:
    """The same md5 inside an Arrow task."""
    return hashlib.md5("|".join(map(str, keys)).encode("utf-8")).hexdigest()


def py_uniform(h: str, at: int = 1) -> float:
    return int(h[at - 1 : at + 7], 16) / _TWO_32
