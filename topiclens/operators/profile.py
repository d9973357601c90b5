"""A12 ``suggest_types``: the narrowest lossless type of every column, in one scan.

All statistics (min, max, null count, "all integral", "all exact as FLOAT", "all look like
timestamps") come from a single ``agg`` with partial aggregation; the answer has one row
per column.

Per column the result gives:

* ``numpy_type``: what pandas downcasts (unsigned, then signed, then float, each only when every
  value is kept) would choose when a candidate replaces the type so far only if it is
  *strictly* smaller, starting from the column's own type; strings become ``datetime64[ns]``
  when every value starts like ``YYYY-MM-DD HH:MM:SS`` else ``category``; any null leaves a
  numeric column as it is.
* ``suggested_type``: the Spark type to store it in (Spark has no unsigned types, so the
  narrowest *signed* type holding the range; strings become TIMESTAMP or CATEGORY, meaning
  a string with an integer code).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import TIMESTAMP_PREFIX_PATTERN

_INT_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOAT_TYPES = (T.FloatType, T.DoubleType, T.DecimalType)

# Integer ranges of the candidate storage types.
SIGNED_RANGES = [("TINYINT", "int8", -128, 127), ("SMALLINT", "int16", -32768, 32767),
                 ("INT", "int32", -2147483648, 2147483647),
                 ("BIGINT", "int64", -9223372036854775808, 9223372036854775807)]
_WIDTH = {"int8": 1, "uint8": 1, "int16": 2, "uint16": 2, "int32": 4, "uint32": 4, "float32": 4,
          "int64": 8, "uint64": 8, "float64": 8, "object": 8}
UNSIGNED_RANGES = [("uint8", 255), ("uint16", 65535), ("uint32", 4294967295), ("uint64", 18446744073709551615)]


def type_name(dt: T.DataType) -> str:
    if isinstance(dt, T.LongType):
        return "BIGINT"
    if isinstance(dt, T.IntegerType):
        return "INT"
    if isinstance(dt, T.ShortType):
        return "SMALLINT"
    if isinstance(dt, T.ByteType):
        return "TINYINT"
    if isinstance(dt, T.DoubleType):
        return "DOUBLE"
    if isinstance(dt, T.FloatType):
        return "FLOAT"
    if isinstance(dt, T.StringType):
        return "STRING"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP"
    if isinstance(dt, T.DateType):
        return "DATE"
    return dt.simpleString().upper()


def _numpy_name(dt: T.DataType) -> str:
    return {"BIGINT": "int64", "INT": "int32", "SMALLINT": "int16", "TINYINT": "int8",
            "DOUBLE": "float64", "FLOAT": "float32"}.get(type_name(dt), "object")


def suggest_types(df: DataFrame) -> DataFrame:
    """``(column_name, current_type, numpy_type, suggested_type)``, one row per column."""
    aggs, plans = [], []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        dt = f.dataType
        if isinstance(dt, _INT_TYPES + _FLOAT_TYPES):
            aggs += [F.min(c).cast("double").alias(f"mn{i}"), F.max(c).cast("double").alias(f"mx{i}"),
                     F.count_if(c.isNull()).alias(f"nn{i}")]
            if isinstance(dt, T.LongType):  # the one integer type wider than a float32
                aggs.append(F.coalesce(F.bool_and(c.cast("float").cast("decimal(38,0)") == c), F.lit(True)).alias(f"ff{i}"))
            if isinstance(dt, _FLOAT_TYPES):
                aggs += [F.coalesce(F.bool_and(c == F.floor(c)), F.lit(True)).alias(f"ii{i}"),
                         F.coalesce(F.bool_and(c.cast("float").cast("double") == c), F.lit(True)).alias(f"ff{i}")]
            plans.append(("num", i, f))
        elif isinstance(dt, T.StringType):
            aggs.append(F.coalesce(F.bool_and(F.coalesce(c.rlike(TIMESTAMP_PREFIX_PATTERN), F.lit(True))),
                                   F.lit(True)).alias(f"ts{i}"))
            plans.append(("str", i, f))
        else:
            plans.append(("other", i, f))
    stats = df.agg(*aggs) if aggs else df.sparkSession.range(1).select()
    rows = []
    for kind, i, f in plans:
        cur = type_name(f.dataType)
        if kind == "str":
            ts = F.col(f"ts{i}")
            numpy_t = F.when(ts, "datetime64[ns]").otherwise("category")
            spark_t = F.when(ts, "TIMESTAMP").otherwise("CATEGORY")
        elif kind == "num":
            mn, mx, nn = F.col(f"mn{i}"), F.col(f"mx{i}"), F.col(f"nn{i}")
            integral = F.lit(True) if isinstance(f.dataType, _INT_TYPES) else F.col(f"ii{i}")
            is_float_col = isinstance(f.dataType, _FLOAT_TYPES)
            exact_float = F.col(f"ff{i}") if is_float_col or isinstance(f.dataType, T.LongType) else F.lit(False)
            signed_np, signed_w = F.lit("int64"), F.lit(8)
            signed_sp = F.lit("BIGINT")
            for sp, np_, lo, hi in reversed(SIGNED_RANGES):
                ok = (mn >= F.lit(float(lo))) & (mx <= F.lit(float(hi)))
                signed_np = F.when(ok, np_).otherwise(signed_np)
                signed_w = F.when(ok, _WIDTH[np_]).otherwise(signed_w)
                signed_sp = F.when(ok, sp).otherwise(signed_sp)
            unsigned_np, unsigned_w = F.lit("uint64"), F.lit(8)
            for np_, hi in reversed(UNSIGNED_RANGES):
                unsigned_np = F.when(mx <= F.lit(float(hi)), np_).otherwise(unsigned_np)
                unsigned_w = F.when(mx <= F.lit(float(hi)), _WIDTH[np_]).otherwise(unsigned_w)
            keep = F.lit(_numpy_name(f.dataType))
            best, width = keep, F.lit(_WIDTH[_numpy_name(f.dataType)])
            for fits, np_, w in ((integral & (mn >= 0), unsigned_np, unsigned_w), (integral, signed_np, signed_w),
                                 (exact_float, F.lit("float32"), F.lit(4))):
                smaller = fits & (w < width)
                best, width = F.when(smaller, np_).otherwise(best), F.when(smaller, w).otherwise(width)
            numpy_t = F.when((nn > 0) | mn.isNull(), keep).otherwise(best)
            float_sp = F.when(exact_float & F.lit(is_float_col), "FLOAT").otherwise(cur)
            spark_t = (F.when(nn > 0, cur).when(mn.isNull(), cur)
                       .when(integral, signed_sp).otherwise(float_sp))
        else:
            numpy_t = F.lit("datetime64[ns]" if cur == "TIMESTAMP" else "object")
            spark_t = F.lit(cur)
        rows.append(F.struct(F.lit(i).alias("ordinal"), F.lit(f.name).alias("column_name"),
                             F.lit(cur).alias("current_type"), numpy_t.alias("numpy_type"),
                             spark_t.alias("suggested_type")))
    return stats.select(F.explode(F.array(*rows)).alias("r")).select(
        "r.ordinal", "r.column_name", "r.current_type", "r.numpy_type", "r.suggested_type")
