"""A seeded permutation of 0..n-1 by arithmetic, for any n.

The place of a number is found from the number alone: no sort, no table, no state.  A
number is written as two digits of the mixed base a x b, the smallest near-square
that holds n; rounds add to one digit a draw keyed by the other, which can be undone
round by round and so never maps two numbers to one place (a Feistel network over two
digits; Black and Rogaway 2002).  Places of n and above, fewer than a of a x b, are mapped
again until they fall below n, which keeps the mapping one-to-one on 0..n-1.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablekin.functions.draw import draw_below

#: Rounds after which pairs of places are spread evenly (measured by chi-squared); few places need more.
ROUNDS, SMALL, SMALL_ROUNDS = 6, 64, 16


def base_of(size: int) -> tuple[int, int]:
    """(a, b) with a x b >= size and fewer than a places to spare."""
    a = max(1, isqrt(max(size - 1, 0)) + 1)
    return a, max(1, -(-size // a))


def _bigint(value: int) -> Column:
    return F.lit(value).cast("bigint")


def permuted(index: Column, size: int, seed: str | int, *keys: Column | str) -> Column:
    """The place of ``index`` (0..size-1) in the permutation that ``seed`` and ``keys`` choose.

    Each key column value chooses a permutation of its own, so 0..k-1 of one row are sent to k
    different places.
    """
    a, b = base_of(size)
    low, high = _bigint(a), _bigint(b)

    rounds = ROUNDS if size >= SMALL else SMALL_ROUNDS

    def mix(state: Column, number: Column) -> Column:
        """One round: an even one changes x by a draw from y, an odd one y by a draw from x."""
        x, y = state["x"], state["y"]
        even = number % 2 == 0
        moved_x = (x + draw_below(low, seed, number, *keys, y)) % low
        moved_y = (y + draw_below(high, seed, number, *keys, x)) % high
        return F.struct(F.when(even, moved_x).otherwise(x).alias("x"), F.when(even, y).otherwise(moved_y).alias("y"))

    def turn(place: Column) -> Column:
        start = F.struct((place % low).alias("x"), F.call_function("div", place, low).alias("y"))
        numbers = F.sequence(F.lit(0), F.lit(rounds - 1))
        return F.aggregate(numbers, start, mix, lambda s: s["y"] * low + s["x"])

    def walk(place: Column, steps: int, step=turn) -> Column:
        tries = F.sequence(F.lit(1), F.lit(steps))
        return F.aggregate(tries, place, lambda at, _: F.when(at < size, at).otherwise(step(at)))

    spare = a * b - size
    place = turn(index.cast("bigint"))
    if spare == 0:
        return place
    # A walk passes each spare place once at most; two nested folds count that far with short lists.
    side = isqrt(spare) + 1
    inside = F.transform(
        F.array(place), lambda p: F.when(p < size, p).otherwise(walk(p, side, lambda at: walk(at, side)))
    )
    return inside[0]
