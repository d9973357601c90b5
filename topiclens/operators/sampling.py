"""Seeded, repeatable sampling and the membership joins around it.

Every sample is ordered by ``md5("<key>:<seed>")`` then the key, so the same rows come
out whatever the partitioning and whichever engine evaluates it.  Up to ``GROUP_LIMIT_MAX`` rows
per group, ``row_number() <= n`` is planned by Spark as ``WindowGroupLimit``: a partial limit runs
before the shuffle, so a label holding a third of all rows sends at most ``n`` rows per map task.
Above it, a label's threshold in the hash is found from counts per hash bin, and no label is gathered.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialize
from .indexing import with_global_index, with_running_sum


def as_list(v) -> list:
    """A scalar or a list argument, always as a list."""
    if v is None:
        return []
    if isinstance(v, (list, tuple, set, frozenset)):
        return list(v)
    return [v]


def seeded_hash(key: Column | str, seed: int) -> Column:
    """Sample order: lower-case hex md5 of ``"<key>:<seed>"``."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(k.cast("string"), F.lit(f":{seed}")))


# Spark plans a group limit for at most this many rows per group (spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT_MAX = 1000
BIN_DIGITS = 3  # hex digits of the hash in one level of bins: 4096 bins per label


def _cuts(binned: DataFrame, label: str, bin_col: str, left: Column) -> DataFrame:
    """Per label: the bin in which the running count reaches what is ``left``, and how much of it is needed.

    A label's rows here are its bins (at most 16 ** BIN_DIGITS), whatever the number of its rows.
    """
    counts = binned.groupBy(label, bin_col).agg(F.count(F.lit(1)).alias("_c"), F.first(left).alias("_left"))
    upto = F.sum("_c").over(Window.partitionBy(label).orderBy(bin_col))
    return (counts.withColumn("_before", upto - F.col("_c")).filter(F.col("_before") < F.col("_left"))
            .groupBy(label).agg(F.max(F.struct(F.col(bin_col).alias("cut"), "_before", "_left", "_c")).alias("_m"))
            .select(F.col(label).alias("_label"), F.col("_m.cut").alias(f"{bin_col}_cut"),
                    (F.col("_m._left") - F.col("_m._before")).alias("_need")))


def _below_threshold(df: DataFrame, label: str, key: str, n: int, seed: int) -> DataFrame:
    """The ``n`` first rows of every label in hash order, without gathering a label.

    Counts per leading bin of the hash give each label's cut bin; its rows alone are counted again by the
    next digits, and only the few rows in that last bin are ranked.  All other rows are kept or
    dropped by comparing their bins with the cuts (one row per label).
    """
    names = df.columns
    h = F.col("_hash")
    given = df.withColumn("_hash", seeded_hash(key, seed)).withColumns({
        "_hi": F.substring(h, 1, BIN_DIGITS), "_lo": F.substring(h, BIN_DIGITS + 1, BIN_DIGITS)})
    high = materialize(_cuts(given, label, "_hi", F.lit(n)), "high_cuts")
    same = F.col(label).eqNullSafe(F.col("_label"))
    at_high = given.join(high, same).drop("_label")
    edge = at_high.filter(F.col("_hi") == F.col("_hi_cut"))
    low = materialize(_cuts(edge, label, "_lo", F.col("_need")), "low_cuts")
    both = given.join(high.drop("_need").join(low.withColumnRenamed("_label", "_low_label"),
                                              F.col("_label").eqNullSafe(F.col("_low_label"))).drop("_low_label"), same)
    inside = both.filter((F.col("_hi") < F.col("_hi_cut")) | (F.col("_hi") == F.col("_hi_cut")) & (F.col("_lo") < F.col("_lo_cut")))
    last = both.filter((F.col("_hi") == F.col("_hi_cut")) & (F.col("_lo") == F.col("_lo_cut")))
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_hash", key))
    last = last.withColumn("_rn", rank).filter(F.col("_rn") <= F.col("_need"))
    return inside.select(*names).unionByName(last.select(*names))


def stratified_sample_n(df: DataFrame, label: str, key: str, n: int, seed: int = 16,
                        strict: bool = False) -> DataFrame:
    """Exactly ``n`` rows per label (all rows of a smaller label unless ``strict``)."""
    if not n:  # P7: a falsy n keeps everything
        return df
    if n <= GROUP_LIMIT_MAX:
        w = Window.partitionBy(label).orderBy(seeded_hash(key, seed), F.col(key))
        out = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
    else:
        out = _below_threshold(df, label, key, n, seed)
    if strict:
        short = (df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
                 .filter(F.col("_n") < n).limit(1).collect())
        if short:
            raise ValueError(f"label {short[0][0]!r} has only {short[0][1]} rows, {n} requested")
    return out


# Up to this n a sample is a top-k (each task keeps n rows, one task merges them);
# above it the rows are ranked by a distributed sort and filtered, so no task holds n rows.
TOP_K_MAX = 100_000


def sample_n(df: DataFrame, key: str, n: int, seed: int = 16) -> DataFrame:
    """``n`` rows chosen by seeded hash order (the same rows for any partitioning)."""
    order = [seeded_hash(key, seed), F.col(key)]
    if n <= TOP_K_MAX:
        return df.orderBy(*order).limit(int(n))  # TakeOrderedAndProject
    ranked = with_global_index(df.withColumn("_h", order[0]), ["_h", key], "_rank")
    return ranked.filter(F.col("_rank") < int(n)).drop("_h", "_rank")


def chunk_sample(df: DataFrame, order: list[Column | str], match: Column, size: int,
                 hash_key: Column, seed: int = 16, base: DataFrame | None = None) -> DataFrame:
    """The chunked reader's sample.

    Rows are numbered in ``order`` (the file order); chunk ``c`` holds rows
    ``[c*size, (c+1)*size)``.  From each chunk, ``int(size/20)`` of its matching rows are
    taken in seeded order (all of them when fewer match); chunks are kept from the first
    one until the running total reaches ``size``.  Output: the input columns + ``chunk``.

    Only a prefix of the order is read, sorted and numbered, as the reader stops early: its end comes
    from a sketch of the order (a bounded sample of the order columns), and it is widened until its whole
    chunks hold ``size`` rows, at most to the whole table.  ``base`` may give a cheaper table with the same
    rows and order columns (``df`` before a join that adds columns) for counting and sketching.
    Order entries that are not column names make the whole table the prefix.
    """
    per_chunk = int(size / 20)
    if per_chunk <= 0:
        return df.limit(0).withColumn("chunk", F.lit(0).cast("long"))
    base = df if base is None else base
    total = base.count()
    reach = PREFIX_CHUNKS * size
    marks = []
    if reach < total and all(isinstance(c, str) for c in order):
        marks = base.select(*order).sample(min(1.0, SKETCH_ROWS / total), seed).orderBy(*order).collect()
    while True:
        end = math.ceil(len(marks) * reach / total) if total else 0
        whole = end >= len(marks)
        prefix = df if whole else df.filter(_up_to(order, df.schema, marks[end]))
        numbered = with_global_index(prefix, order, "_row_ix")
        chunked = numbered.withColumn("chunk", F.floor(F.col("_row_ix") / F.lit(size)).cast("long"))
        w = Window.partitionBy("chunk").orderBy(seeded_hash(hash_key, seed), *order)
        picked = materialize(chunked.filter(match).withColumn("_rn", F.row_number().over(w))
                             .filter(F.col("_rn") <= per_chunk).drop("_rn", "_row_ix"), "picked")
        counts = picked.groupBy("chunk").agg(F.count(F.lit(1)).alias("_n"))
        if not whole:  # the last chunk of a prefix may go on beyond it
            full = numbered.count() // size
            counts = counts.filter(F.col("chunk") < full)
        found = counts.agg(F.count(F.lit(1)).alias("chunks"), F.coalesce(F.sum("_n"), F.lit(0)).alias("rows")).first()
        if whole or found["rows"] >= size:
            break
        reach = int(reach * max(2.0, 1.5 * size / max(1, found["rows"])))
    if found["chunks"] <= FEW_CHUNKS:
        upto = counts.withColumn("_upto", F.sum("_n").over(Window.orderBy("chunk")))  # at most FEW_CHUNKS small rows
    else:
        upto = with_running_sum(counts, "chunk", "_n", "_upto")
    keep = upto.filter(F.col("_upto") - F.col("_n") < size).select("chunk")
    return picked.join(keep, "chunk", "left_semi")


# A first prefix has room for this many chunks (20 full ones reach the size); the sketch holds about so many rows.
PREFIX_CHUNKS = 30
SKETCH_ROWS = 2_000
FEW_CHUNKS = 100_000


def _up_to(order: list[str], schema: StructType, mark: Row) -> Column:
    """Rows at or before ``mark`` in ``order`` (nulls first); the leading column alone can be pushed to the scan."""
    def literal(c: str) -> Column:
        return F.lit(mark[c]).cast(schema[c].dataType)

    lead = F.lit(True) if mark[order[0]] is None else F.col(order[0]) <= literal(order[0])
    after = F.lit(True)
    for c in reversed(order):
        same, value = F.col(c).eqNullSafe(literal(c)), literal(c)
        before = F.lit(False) if mark[c] is None else F.coalesce(F.col(c) < value, F.lit(True))
        after = before | (same & after)
    return (F.col(order[0]).isNull() | lead) & after


def semi_join(left: DataFrame, right: DataFrame, on, broadcast_right: bool = False) -> DataFrame:
    """Rows of ``left`` with a match in ``right`` (EXISTS)."""
    r = F.broadcast(right) if broadcast_right else right
    return left.join(r, on, "left_semi")


def anti_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` without a match in ``right`` (NOT EXISTS)."""
    return left.join(right, on, "left_anti")
