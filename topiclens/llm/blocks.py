"""Dealing documents to blocks of bounded bytes.

Operators that look at whole texts several times group documents into blocks of about
``BLOCK_BYTES`` by a hash of the row.  A block is the unit that keyed facts travel back to:
hashes are made distinct inside a block before they are shuffled, so a word, passage or
line that stands in a third of all rows sends one row per block and not one per occurrence.
The number of blocks grows with the input; the size of one does not.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize  # noqa: F401  (shared scratch tables)

BLOCK_BYTES = 4 << 20


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """Total UTF-8 bytes of a column (0 for an empty table)."""
    return int(df.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0)


def block_count(df: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES) -> int:
    return max(1, math.ceil(text_bytes(df, text) / block_bytes))


def block_column(blocks: int, key: str = "doc_id", text: str = "text") -> Column:
    """The block of a row: a hash of its key (of its text, where the key is null)."""
    spread = F.when(F.col(key).isNull(), F.col(text))
    return F.pmod(F.xxhash64(F.col(key), spread), F.lit(blocks)).cast("int").alias("block")


def dealt(df: DataFrame, blocks: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with a column ``block``; the rows of a block land in one partition."""
    return df.select("*", block_column(blocks, key, text)).repartition("block")


HOT_SHARE = 1 / 1024


def lookup(left: DataFrame, right: DataFrame, key: str, rows: int, count: str = "n") -> DataFrame:
    """Inner join of many rows with a table of one row per key, whose ``count`` says how many rows of ``left`` it has.

    At most 1 / ``HOT_SHARE`` keys can hold more than that share of the rows, so they are
    broadcast, with that proven bound, and their rows stay where they are; the rest, whose
    groups are small, is joined by shuffle.  ``count`` is dropped.
    """
    hot = right.filter(F.col(count) > max(1.0, rows * HOT_SHARE)).drop(count)
    cold = right.filter(F.col(count) <= max(1.0, rows * HOT_SHARE)).drop(count)
    few = F.broadcast(hot)
    rest = left.join(F.broadcast(hot.select(key)), key, "left_anti")
    return left.join(few, key).unionByName(rest.join(cold, key))
