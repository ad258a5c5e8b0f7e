"""Random numbers as a pure function of (seed, row key).

``rand()`` and ``monotonically_increasing_id()`` change with the partition
layout.  A digest of the row's own key does not, so a retried task and a run on
another cluster give the same values, without any state or shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SHARE_STEPS = 1_000_000


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def seeded_text(seed: str | int, *keys: Column | str) -> Column:
    """``seed|key1|key2``; NULL if a key is NULL."""
    parts = [F.lit(str(seed))]
    for key in keys:
        parts += [F.lit("|"), _column(key).cast("string")]
    return F.concat(*parts)


def shuffle_key(seed: str | int, *keys: Column | str) -> Column:
    """Sort key of a seeded shuffle."""
    return F.md5(seeded_text(seed, *keys))


def draw(seed: str | int, *keys: Column | str) -> Column:
    """A bigint in [0, 2**60)."""
    return F.conv(F.substring(shuffle_key(seed, *keys), 1, 15), 16, 10).cast("bigint")


def draw_below(limit: int | Column, seed: str | int, *keys: Column | str) -> Column:
    """A bigint in [0, limit); ``limit`` must be positive."""
    bound = limit if isinstance(limit, Column) else F.lit(limit).cast("bigint")
    return draw(seed, *keys) % bound


def draw_between(low: int, high: int, seed: str | int, *keys: Column | str) -> Column:
    """A bigint in [low, high]."""
    if high < low:
        raise ValueError(f"empty range: {low}..{high}")
    return F.lit(low).cast("bigint") + draw_below(high - low + 1, seed, *keys)


def in_share(share: float, seed: str | int, *keys: Column | str) -> Column:
    """True for about ``share`` of all keys."""
    if not 0.0 <= share <= 1.0:
        raise ValueError(f"a share lies between 0 and 1, not {share}")
    return draw_below(SHARE_STEPS, seed, *keys) < F.lit(round(share * SHARE_STEPS))
