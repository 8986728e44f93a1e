"""Measured size bounds for broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20
_FIXED_WIDTH = 16


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the rows' size in memory, from one aggregate over ``df``."""
    width = F.lit(0).cast("long")
    for field in df.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            # As text a number takes up to two bytes or more per stored one, an element 16 at most besides.
            text = F.to_json(F.struct(F.col(f"`{field.name}`")), {"ignoreNullFields": "false"})
            width = width + 9 * F.coalesce(F.octet_length(text), F.lit(0))
        width = width + _FIXED_WIDTH
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its measured size is within ``limit``, else ``df`` as it is."""
    return F.broadcast(df) if measured_bytes(df) <= limit else df
