"""Deterministic hashing for shuffles and draws.

Seeded shuffles must give the same answer on every re-computation of a
partition (executor loss, speculative tasks), so nothing here uses ``rand()``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Multiplicative (Knuth) hash of the fold key, modulo 2**32.
MULT = 2654435761
MOD32 = 4294967296
_HALF = 65536


def mult_hash32(id_col: Column | str, seed: int = 42) -> Column:
    """``(id * 2654435761 + seed) mod 2**32`` without 64-bit overflow.

    ``id`` is reduced mod 2**32 and split into 16-bit halves, so every
    intermediate stays below 2**49 whatever the key range (ANSI mode would
    raise on overflow of the direct product for keys above ~3.5e9).
    """
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    x = F.pmod(c.cast("long"), F.lit(MOD32))
    hi = F.floor(x / _HALF).cast("long")
    lo = F.pmod(x, F.lit(_HALF))
    prod = lo * F.lit(MULT) + F.pmod(hi * F.lit(MULT), F.lit(_HALF)) * F.lit(_HALF)
    return F.pmod(prod + F.lit(seed), F.lit(MOD32))


def digest52(*cols: Column) -> Column:
    """52 bits of the MD5 of the values joined by colons, as a long: a draw that any SQL engine can repeat."""
    text = F.concat_ws(":", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def uniform01(*cols: Column) -> Column:
    """A value in [0, 1) that is a pure function of ``cols`` (52-bit grid)."""
    return digest52(*cols).cast("double") / float(1 << 52)


def draw_index(n: Column | int, *cols: Column) -> Column:
    """An integer in [0, n) that is a pure function of ``cols``."""
    nn = F.lit(n) if isinstance(n, int) else n
    return F.pmod(digest52(*cols), nn.cast("long"))
