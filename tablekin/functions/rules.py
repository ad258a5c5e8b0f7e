"""Column value rules, looked up by name and given keyword arguments.

Every rule is a ``Column`` expression over a seeded draw, so filling a column
stays inside whole-stage code generation.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablekin.functions.draw import draw_below, draw_between, seeded_text


@dataclass(frozen=True)
class RuleContext:
    """What a rule may use: the seed, the row's key columns and "now"."""

    seed: str
    keys: tuple[Column | str, ...]
    anchor: datetime


def int_between(ctx: RuleContext, min_value: int = 0, max_value: int = 9999) -> Column:
    return draw_between(min_value, max_value, ctx.seed, *ctx.keys)


def fixed_point(
    ctx: RuleContext, left_digits: int = 5, right_digits: int = 2, positive: bool = False
) -> Column:
    """A decimal with the given digits; without ``positive`` it may be negative."""
    precision = left_digits + right_digits
    if not 0 < precision <= 18:
        raise ValueError("left_digits + right_digits must lie between 1 and 18")
    top = 10**precision - 1
    steps = draw_between(1 if positive else -top, top, ctx.seed, *ctx.keys)
    scaled = steps.cast(f"decimal({precision},0)") * F.lit(f"1e-{right_digits}").cast(
        f"decimal({right_digits + 1},{right_digits})"
    )
    return scaled.cast(f"decimal({precision},{right_digits})")


_OFFSET = re.compile(r"([+-]?\d+)([yMwd])")


def _as_date(value: str | date, anchor: datetime) -> date:
    """``today``, an ISO date, or an offset such as ``-10y``, ``-6M``, ``-2w``, ``+30d``."""
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    if value in ("today", "now"):
        return anchor.date()
    found = _OFFSET.fullmatch(value)
    if not found:
        return date.fromisoformat(value)
    amount, unit = int(found[1]), found[2]
    days = {"y": 365.25, "M": 30.4375, "w": 7, "d": 1}[unit] * amount
    return anchor.date() + timedelta(days=int(days))


def date_between(
    ctx: RuleContext, start_date: str | date = "-30y", end_date: str | date = "today"
) -> Column:
    start, end = _as_date(start_date, ctx.anchor), _as_date(end_date, ctx.anchor)
    days = draw_between(0, (end - start).days, ctx.seed, *ctx.keys)
    return F.date_add(F.lit(start), days.cast("int"))


def timestamp_between(ctx: RuleContext, start: datetime, end: datetime) -> Column:
    """A second in [start, end]."""
    seconds = draw_between(0, int((end - start).total_seconds()), ctx.seed, *ctx.keys)
    origin = F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz")
    return origin + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def _month_start(day: datetime) -> datetime:
    return datetime(day.year, day.month, 1)


def _year_start(day: datetime) -> datetime:
    return datetime(day.year, 1, 1)


def _decade_start(day: datetime) -> datetime:
    return datetime(day.year - day.year % 10, 1, 1)


def date_window(window_start: Callable[[datetime], datetime]) -> Callable[..., Column]:
    return lambda ctx: date_between(ctx, window_start(ctx.anchor).date(), ctx.anchor.date())


def timestamp_window(window_start: Callable[[datetime], datetime]) -> Callable[..., Column]:
    return lambda ctx: timestamp_between(ctx, window_start(ctx.anchor), ctx.anchor)


def pick(ctx: RuleContext, elements: Sequence) -> Column:
    if not elements:
        raise ValueError("a pick list must not be empty")
    index = draw_below(len(elements), ctx.seed, *ctx.keys).cast("int") + F.lit(1)
    return F.element_at(F.array(*[F.lit(element) for element in elements]), index)


def hex_digest(ctx: RuleContext) -> Column:
    return F.sha2(seeded_text(ctx.seed, *ctx.keys), 256)


def padded_key(ctx: RuleContext, length: int = 12) -> Column:
    """The row key as zero-padded text; a key longer than ``length`` is kept whole."""
    texts = [
        F.when(F.length(text) < length, F.lpad(text, length, "0")).otherwise(text)
        for text in (F.col(k) if isinstance(k, str) else k for k in ctx.keys)
        for text in [text.cast("string")]
    ]
    return F.concat_ws("-", *texts)


# The rule names that a table specification may use.
VALUE_RULES: Mapping[str, Callable[..., Column]] = {
    "date_between": date_between,
    "date_this_decade": date_window(_decade_start),
    "date_this_year": date_window(_year_start),
    "date_time_this_decade": timestamp_window(_decade_start),
    "date_time_this_month": timestamp_window(_month_start),
    "date_time_this_year": timestamp_window(_year_start),
    "pydecimal": fixed_point,
    "pyint": int_between,
    "random_element": pick,
    "sha256": hex_digest,
}


def rule_column(
    ctx: RuleContext,
    name: str,
    args: Mapping | None = None,
    pick_lists: Mapping[str, Sequence[str]] | None = None,
) -> Column:
    """The expression of rule ``name``.

    ``unique.<rule>`` gives text that no two row keys share: an entry of the pick
    list ``<rule>`` (or nothing) followed by the padded row key.  Text rules such as
    names or addresses are pick lists given by the caller.
    """
    args, lists = dict(args or {}), pick_lists or {}
    if name.startswith("unique."):
        base = name.removeprefix("unique.")
        length = args.pop("length", 12)
        if args:
            raise ValueError(f"rule {name!r} does not take {sorted(args)}")
        number = padded_key(ctx, length)
        return F.concat(pick(ctx, lists[base]), F.lit("-"), number) if base in lists else number
    if name in lists:
        return pick(ctx, lists[name])
    if name not in VALUE_RULES:
        raise ValueError(f"no value rule and no pick list named {name!r}")
    return VALUE_RULES[name](ctx, **args)
