"""Size checks: what is broadcast has been measured first."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT = 128 * 1024 * 1024

# Upper estimate of a hashed row: map entry and row header, then per column
# a fixed slot and the padding of variable-length values.
_ROW_BYTES = 64
_COLUMN_BYTES = 16


@dataclass(frozen=True)
class Size:
    """Measured rows and in-memory bytes of a frame, and its key counts."""

    rows: int
    bytes: int
    keys: int  # rows with a key
    distinct_keys: int

    @property
    def unique(self) -> bool:
        """True when no two rows share a key."""
        return self.keys == self.distinct_keys


def row_bytes(columns: int) -> int:
    """Upper estimate of a hashed row without its text."""
    return _ROW_BYTES + _COLUMN_BYTES * columns


def is_whole(frame: DataFrame, column: str) -> bool:
    return isinstance(frame.schema[column].dataType, T.IntegralType)


def key_word(key: str) -> Column:
    """The number of the 64 neighbouring keys that ``key`` is one of."""
    return F.shiftright(F.col(key).cast("bigint"), 6)


def word_bit(key: str) -> Column:
    """The bit of ``key`` among its 64 neighbours."""
    place = F.col(key).cast("bigint").bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def _text_bytes(frame: DataFrame) -> Column:
    texts = [
        F.coalesce(F.octet_length(f.name), F.lit(0)).cast("bigint")
        for f in frame.schema.fields
        if isinstance(f.dataType, (T.StringType, T.BinaryType))
    ]
    return reduce(lambda a, b: a + b, texts, F.lit(0).cast("bigint"))


def measure(frames: Mapping[str, tuple[DataFrame, str]]) -> dict[str, Size]:
    """Sizes of several frames with their key columns, in one Spark job.

    Each frame is reduced to one row on the executors; the driver gets
    ``len(frames)`` rows.
    """
    parts = []
    for name, (frame, key) in frames.items():
        width = row_bytes(len(frame.columns))
        parts.append(
            frame.agg(
                F.lit(name).alias("name"),
                F.count(F.lit(1)).alias("rows"),
                (F.count(F.lit(1)) * width + F.coalesce(F.sum(_text_bytes(frame)), F.lit(0))).alias("bytes"),
                F.count(key).alias("keys"),
                F.count_distinct(key).alias("distinct_keys"),
            )
        )
    rows = reduce(DataFrame.unionAll, parts).collect()
    return {r["name"]: Size(r["rows"], r["bytes"], r["keys"], r["distinct_keys"]) for r in rows}
