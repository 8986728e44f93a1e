"""Hash keys and dates of messages."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_FIELDS = ("message_id", "sequence_id", "partition_id")
# Columns that describe one delivery of a message, not the message.
DELIVERY_FIELDS = ("arrival_ts", "arrival_index")
# Stands for a null key part, so that nulls neither vanish nor meet a real value.
NULL_MARK = "\u0000"


def pack(columns: Iterable[str]) -> Column:
    """Named columns as one struct."""
    return F.struct(*columns)


def key_text(columns: Sequence[str] = KEY_FIELDS, separator: str = "|") -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in columns]
    return F.concat_ws(separator, *parts)


def composite_key(columns: Sequence[str] = KEY_FIELDS, separator: str = "|") -> Column:
    """SHA-256 hex of the key parts.

    With ``separator=""`` the parts are merely run together, and ``(m, 1, 11)`` then collides with
    ``(m, 11, 1)``; the default keeps them apart.
    """
    return F.sha2(key_text(columns, separator), 256)


def payload_key(columns: Iterable[str]) -> Column:
    """SHA-256 hex of the columns as JSON with sorted names."""
    return F.sha2(F.to_json(pack(sorted(columns))), 256)


def payload_columns(columns: Iterable[str], key: Sequence[str] = KEY_FIELDS) -> list[str]:
    """The columns a payload hash covers: the key and everything but the delivery fields.

    A hash over ``arrival_*`` would differ between two deliveries of one message and could never
    show that they are the same.
    """
    kept = [c for c in columns if c not in DELIVERY_FIELDS]
    return sorted(set(kept) | set(key))


def epoch_date(seconds: Column) -> Column:
    """UTC date of epoch seconds, whatever the session time zone; the fraction is dropped."""
    days = F.floor(seconds / F.lit(86400)).cast("int")
    return F.date_add(F.lit(datetime.date(1970, 1, 1)), days)


def epoch_time(seconds: Column) -> Column:
    """Instant of epoch seconds, to the microsecond (for watermarks)."""
    return F.timestamp_micros(F.round(seconds * F.lit(1e6)).cast("long"))


def epoch_seconds(wall: Column) -> Column:
    """Epoch seconds of a zone-less timestamp read as UTC, whatever the session time zone."""
    days = F.date_diff(wall, F.lit(datetime.date(1970, 1, 1))).cast("long")
    whole = days * 86400 + F.hour(wall) * 3600 + F.minute(wall) * 60
    micros = (F.date_part(F.lit("SECOND"), wall) * 1_000_000).cast("long")
    return (whole * 1_000_000 + micros).cast("double") / F.lit(1e6)
