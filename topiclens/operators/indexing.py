"""Dense 0-based row numbers in a global order, without a single-partition window.

``row_number() over (order by ...)`` with no partition moves every row into one task.
Here the rows are range-partitioned and sorted (a normal distributed sort), tagged with
their partition and position, and written once to the shared folder.  Range bounds are
sampled and partitions coalesced at run time, so two readings of the sort need not agree;
the per-partition sizes are therefore counted from the written copy.  The offset table has
one row per partition and is broadcast (bounded by the partition count).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the lower 33 bits


def with_global_index(df: DataFrame, order: list[Column | str], name: str = "row_ix",
                      num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 0-based position of the row in ``order`` (ties broken arbitrarily)."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    if num_partitions:
        ranged = df.repartitionByRange(num_partitions, *cols)
    else:
        ranged = df.repartitionByRange(*cols)
    tagged = materialize(ranged.sortWithinPartitions(*cols)
                         .withColumn("_pid", F.spark_partition_id())
                         .withColumn("_mid", F.monotonically_increasing_id()), "global_index")
    local_ix = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _ROW_BITS)
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: the running sum below runs over a tiny table
    offsets = sizes.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"),
    ).fillna(0, ["_off"])
    out = tagged.join(F.broadcast(offsets), "_pid").withColumn(
        name, (F.col("_off") + local_ix).cast("long"))
    return out.drop("_pid", "_mid", "_off")


def with_running_sum(df: DataFrame, order: str, value: str, name: str = "running") -> DataFrame:
    """Add ``name`` = sum of ``value`` over all rows up to and including this one in ``order``.

    Distributed prefix sum: range partitions, a running window inside each partition
    (partitioned by the range partition id, so no partition grows past its range split),
    written once, and per-partition offsets counted from the written copy.
    """
    ranged = df.repartitionByRange(order).withColumn("_pid", F.spark_partition_id())
    inside = Window.partitionBy("_pid").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = materialize(ranged.withColumn("_local", F.sum(value).over(inside)), "running_sum")
    totals = local.groupBy("_pid").agg(F.sum(value).alias("_t"))
    offsets = totals.select(
        "_pid",
        F.coalesce(F.sum("_t").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
    )
    return (local.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_off") + F.col("_local"))
            .drop("_pid", "_local", "_off"))
