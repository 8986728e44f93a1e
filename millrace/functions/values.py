"""Small value expressions: literals, text, deterministic picks, ratios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def modulo_group(number: Column, groups: int) -> Column:
    """``number % groups`` as text, the group key of the aggregation examples."""
    return (number % F.lit(groups)).cast("string")


def labelled(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


# Hex digits of a digest: 60 bits, which every SQL engine holds in a 64-bit number.
_DIGITS = 15


def pick(row_id: Column, seed: int, choices: int | Column) -> Column:
    """A number in ``[0, choices)`` fixed by ``row_id`` and ``seed`` alone; null for a null id.

    It does not depend on partitioning, so a recomputed task picks the same again. It comes from a digest,
    so that far ids don't repeat near ones' picks and every number below 2^60 can be drawn.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("long").cast("string")).cast("binary"))
    count = choices if isinstance(choices, Column) else F.lit(choices)
    return F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("long") % count.cast("long")


def pick_sql(row_id: str, seed: int, choices: str | int) -> str:
    """The SQL text of :func:`pick`, for checks in another engine."""
    digest = f"md5('{seed}:' || CAST(({row_id}) AS VARCHAR))"
    return f"(CAST('0x' || substr({digest}, 1, {_DIGITS}) AS BIGINT) % ({choices}))"


def pick_from(row_id: Column, seed: int, values: Sequence[str]) -> Column:
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (pick(row_id, seed, len(values)) + 1).cast("int"))


def ratio(part: Column, whole: Column, default: float | None = None) -> Column:
    """``part / whole``; ``default`` where ``whole`` is zero."""
    quotient = F.try_divide(part.cast("double"), whole.cast("double"))
    return quotient if default is None else F.coalesce(quotient, F.lit(default))


def percent(part: Column, whole: Column, default: float | None = None) -> Column:
    return ratio(part, whole, default) * 100


def overhead_percent(value: Column, base: Column) -> Column:
    """How far ``value`` lies above ``base``, in percent of ``base``."""
    return (ratio(value, base) - 1) * 100


def throughput(input_rows: Column, seconds: Column) -> Column:
    """Input (not output) rows per second."""
    return ratio(input_rows, seconds)
