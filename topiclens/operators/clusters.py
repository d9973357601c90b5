"""Cluster evaluation and visual words.

The contingency table has (labels x clusters) rows, so everything after it is tiny; the
only document- or image-sized steps are the ``groupBy`` that builds it (map-side partial
counts, so a hot label costs one row per map task) and the label/cluster lookups.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ..session import materialize
from .nearest import nearest_centroid  # noqa: F401  (J9)
from .pca import gramian_rows


def label_codes(df: DataFrame, label: str, name: str = "label_code") -> DataFrame:
    """``df`` plus ``name`` = 0-based code of ``label`` in sorted label order.

    Codes are numbered on the *distinct* labels (partial aggregate first) with a distributed
    index (no single-partition window), then joined back.  A null label gets code -1.
    """
    from .indexing import with_global_index

    codes = with_global_index(df.select(label).filter(F.col(label).isNotNull()).distinct(), [label], "_code")
    coded = df.join(codes.select(label, F.col("_code").cast("int").alias(name)), label, "left")
    return coded.withColumn(name, F.coalesce(F.col(name), F.lit(-1)))


def distinct_labels(df: DataFrame, label: str) -> DataFrame:
    """A10: one row ``(n_labels)``, the number of different non-null labels."""
    return df.agg(F.count_distinct(F.col(label)).alias("n_labels"))


def contingency(df: DataFrame, true_col: str = "label_code", pred_col: str = "cluster") -> DataFrame:
    """``(label_code, cluster, n)`` counts of (true, predicted)."""
    return (df.groupBy(F.col(true_col).alias("label_code"), F.col(pred_col).alias("cluster"))
            .agg(F.count(F.lit(1)).alias("n")))


def confusion_wide(cont: DataFrame) -> DataFrame:
    """A7 wide: one row per label code, one column per code, square over the union of codes.

    The column set is the union of label and cluster codes (k values), read first so the
    pivot gets explicit values and does not run an extra job per column.
    """
    codes = sorted({r[0] for r in cont.select("label_code").union(cont.select("cluster")).distinct().collect()})
    labels = cont.sparkSession.createDataFrame([(c,) for c in codes], "label_code int")
    wide = (cont.groupBy("label_code").pivot("cluster", codes).agg(F.sum("n")))
    out = labels.join(wide, "label_code", "left").fillna(0)
    return out.select("label_code", *[F.col(str(c)).cast("long").alias(f"c{c}") for c in codes])


def purity_matrix(cont: DataFrame) -> DataFrame:
    """``(label_code, cluster, n, purity)`` with purity = n / cluster size."""
    return cont.withColumn("purity", F.col("n") / F.sum("n").over(Window.partitionBy("cluster")))


def match_clusters(cont: DataFrame, leftover: str = "smallest_missing") -> DataFrame:
    """``(cluster, label_code)``: map each cluster to a label by descending purity.

    Each cluster may only claim its own best label (W6: ties to the smallest label); a
    label goes to the purest claiming cluster (ties to the smallest cluster).  Clusters
    left over get the smallest label nobody claimed (``smallest_missing``), or missing
    labels in ascending order by cluster id (``one_to_one``); when no label is left (more
    clusters than labels) a leftover cluster keeps its own best label.
    """
    pur = purity_matrix(cont)
    best = (pur.withColumn("_r", F.row_number().over(
        Window.partitionBy("cluster").orderBy(F.col("purity").desc(), F.col("label_code"))))
        .filter(F.col("_r") == 1).select("cluster", F.col("label_code").alias("best"), "purity"))
    ranked = best.withColumn("_w", F.row_number().over(
        Window.partitionBy("best").orderBy(F.col("purity").desc(), F.col("cluster"))))
    winners = ranked.filter(F.col("_w") == 1).select("cluster", F.col("best").alias("label_code"))
    losers = ranked.filter(F.col("_w") > 1).select("cluster", "best")
    labels = cont.select("label_code").distinct()
    missing = labels.join(winners.select("label_code"), "label_code", "left_anti")
    if leftover == "smallest_missing":
        smallest = missing.agg(F.min("label_code").alias("label_code"))  # one row
        fill = losers.crossJoin(smallest)
    elif leftover == "one_to_one":
        lr = losers.withColumn("_i", F.row_number().over(Window.orderBy("cluster")))
        mr = missing.withColumn("_i", F.row_number().over(Window.orderBy("label_code")))
        fill = lr.join(mr, "_i", "left")
    else:
        raise ValueError("leftover must be 'smallest_missing' or 'one_to_one'")
    # with no label left to give, a leftover cluster keeps its own best label
    fill = fill.select("cluster", F.coalesce("label_code", "best").alias("label_code"))
    out = winners.unionByName(fill)
    return out.select("cluster", F.col("label_code").cast("int").alias("label_code"))


def apply_matching(df: DataFrame, mapping: DataFrame, pred_col: str = "cluster",
                   out_col: str = "matched") -> DataFrame:
    """Replace cluster ids by their matched label (k-row lookup, broadcast)."""
    m = F.broadcast(mapping.select(F.col("cluster").alias(pred_col), F.col("label_code").alias(out_col)))
    return df.join(m, pred_col, "left")


def adjusted_rand_index(cont: DataFrame) -> DataFrame:
    """One row ``(ari)`` from a contingency table (Hubert and Arabie 1985).

    1.0 when the denominator is 0 (both partitions trivial and equal).
    """
    def c2(x: Column) -> Column:
        return x.cast("double") * (x.cast("double") - 1) / 2

    # one pass: cells, row sums, column sums and the total are the cube's grouping levels
    sums = cont.cube("label_code", "cluster").agg(F.sum("n").alias("n"), F.grouping_id().alias("level"))

    def at(level: int, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("level") == level, value)), F.lit(0.0))

    pairs = c2(F.col("n"))
    t = sums.agg(at(0, pairs).alias("I"), at(1, pairs).alias("A"), at(2, pairs).alias("B"),
                 at(3, F.col("n").cast("double")).alias("N"))
    p = F.col("N") * (F.col("N") - 1) / 2
    expected = F.coalesce(F.col("A") * F.col("B") / F.nullif(p, F.lit(0.0)), F.lit(0.0))
    denom = (F.col("A") + F.col("B")) / 2 - expected
    return t.select(F.when(denom == 0, F.lit(1.0))
                    .otherwise((F.col("I") - expected) / denom).alias("ari"))


def evaluate_clusters(df: DataFrame, true_col: str = "label_code", pred_col: str = "cluster",
                      leftover: str = "smallest_missing") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(contingency after matching, ARI after matching, ARI on raw clusters)."""
    # labels x clusters rows, written once: everything below reads these and not the points
    raw = materialize(contingency(df, true_col, pred_col), "contingency")
    mapping = match_clusters(raw, leftover)
    matched = apply_matching(raw, mapping, "cluster")
    cont = matched.groupBy("label_code", F.col("matched").alias("cluster")).agg(F.sum("n").alias("n"))
    return cont, adjusted_rand_index(cont), adjusted_rand_index(raw)


# ---------------------------------------------------------------------------
# A6 visual-word histogram, R4 wide form
# ---------------------------------------------------------------------------


def bovw_histogram(assigned: DataFrame, image_col: str = "image_id", word_col: str = "word_id") -> DataFrame:
    """``(image_id, word_id, cnt)`` visual-word counts per image."""
    return (assigned.groupBy(F.col(image_col).alias("image_id"), F.col(word_col).alias("word_id"))
            .agg(F.count(F.lit(1)).alias("cnt")))


def long_to_wide(long_df: DataFrame, row_key: str, col_key: str, value: str, col_values: list,
                 rows: DataFrame | None = None, prefix: str = "w") -> DataFrame:
    """One column per ``col_values`` entry, missing cells 0.

    ``rows`` (ids) keeps rows with no entry as all-zero rows.  For thousands of columns
    :func:`long_to_vector` gives the same table as one sparse vector per row.
    """
    wide = long_df.groupBy(row_key).pivot(col_key, list(col_values)).agg(F.first(value))
    if rows is not None:
        wide = rows.select(row_key).join(wide, row_key, "left")
    cols = [F.coalesce(F.col(str(v)), F.lit(0).cast(long_df.schema[value].dataType)).alias(f"{prefix}{v}")
            for v in col_values]
    return wide.select(row_key, *cols)


def long_to_vector(long_df: DataFrame, row_key: str, col_key: str, value: str,
                   rows: DataFrame | None = None) -> DataFrame:
    """R3/R4 at any width: ``(row_key, indices, weights)``, the non-zero cells of a row in column order.

    ``rows`` (ids) keeps rows with no entry as empty vectors.
    """
    cells = long_df.groupBy(row_key).agg(F.array_sort(F.collect_list(F.struct(
        F.col(col_key).alias("i"), F.col(value).alias("v")))).alias("_c"))
    if rows is not None:
        cells = rows.select(row_key).join(cells, row_key, "left")
    kind = long_df.schema[value].dataType.simpleString()
    return cells.select(row_key, F.coalesce(F.col("_c.i"), F.array().cast("array<int>")).alias("indices"),
                        F.coalesce(F.col("_c.v"), F.array().cast(f"array<{kind}>")).alias("weights"))


DENSE_CELLS = 1 << 17  # cells of the dense rows that are laid out at once: 1 MB


def _dense_blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """``(ids, rows x width)`` for batches of ``(id, map of column to value)``, about ``DENSE_CELLS`` at once."""
    step = max(1, DENSE_CELLS // max(1, width))
    for whole in batches:
        for lo in range(0, whole.num_rows, step):
            batch = whole.slice(lo, step)
            m = batch.column("_m")
            at = m.offsets.to_numpy().astype(np.int64)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(at))
            out = np.zeros((batch.num_rows, width))
            out[owner, m.keys.to_numpy()[at[0]:at[-1]]] = m.items.to_numpy()[at[0]:at[-1]]
            yield batch.column(0), out


def _row_cells(long_df: DataFrame, row_key: str, col_key: str, value: str, rows: DataFrame | None) -> DataFrame:
    """``(row_key, _m)``: the cells of a row as one map from column to value."""
    cells = long_df.groupBy(row_key).agg(F.map_from_entries(F.collect_list(F.struct(
        F.col(col_key).cast("int").alias("i"), F.col(value).cast("double").alias("v")))).alias("_m"))
    if rows is not None:
        cells = rows.select(row_key).join(cells, row_key, "left")
    return cells.select(row_key, F.coalesce("_m", F.create_map().cast("map<int,double>")).alias("_m"))


def long_to_dense(long_df: DataFrame, row_key: str, col_key: str, value: str, width: int, rows: DataFrame | None = None,
                  summary: Callable[[np.ndarray], dict[str, np.ndarray]] | None = None, summary_schema: str = "") -> DataFrame:
    """R3/R4 as dense rows: ``(row_key, row ARRAY<DOUBLE>)`` of ``width`` cells, missing cells 0.

    The cells of a row are gathered as one map and laid out inside the row: no pivot, no plan that grows with the width.
    With ``summary`` the dense rows are read in the task that lays them out: it gets a matrix of some whole rows and
    returns columns of one value per row (``summary_schema``), which stand in place of ``row``.
    """
    sparse = _row_cells(long_df, row_key, col_key, value, rows)
    made = StructType([sparse.schema[row_key], *(StructType.fromDDL(summary_schema) if summary else
                                                 [StructField("row", ArrayType(DoubleType()))])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, out in _dense_blocks(batches, width):
            if summary:
                found = summary(out)
                columns = [pa.array(found[name]) for name in made.names[1:]]
            else:
                columns = [pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * width, pa.int32()), pa.array(out.ravel()))]
            yield pa.RecordBatch.from_arrays([ids, *columns], made.names)

    return sparse.mapInArrow(run, made)


def dense_sums(block: np.ndarray) -> dict[str, np.ndarray]:
    """Of each dense row: its width, its cells other than 0, their sum and their sum times the place (from 1), added in order."""
    n, width = block.shape
    flat = block.ravel()
    at = np.flatnonzero(flat != 0)
    owner, place, held = at // max(1, width), at % max(1, width), flat[at]
    total, by_place = (np.bincount(owner, x, n).astype(np.float64) for x in (held, held * (place + 1)))  # whole numbers if none is held
    return {"width": np.full(n, width, np.int32), "n_nonzero": np.bincount(owner, minlength=n).astype(np.int32),
            "total": total, "by_place": by_place}


# ---------------------------------------------------------------------------
# M1 standard scaling and covariance on long (id, dim, value) tables
# ---------------------------------------------------------------------------


def explode_vector(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, dim, value)`` from an array column."""
    return df.select(F.col(id_col).alias("id"),
                     F.posexplode(F.col(vec_col).cast("array<double>")).alias("dim", "value"))


def column_stats(long_df: DataFrame) -> DataFrame:
    """``(dim, n, mean, std)`` per dimension (sample standard deviation)."""
    return long_df.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"),
                                      F.stddev_samp("value").alias("std"))


def standard_scale_long(long_df: DataFrame, ddof: int = 1) -> DataFrame:
    """M1: ``(id, dim, value)`` centred and divided by the std (``ddof=0``: population std)."""
    st = column_stats(long_df)
    if ddof == 0:
        st = st.withColumn("std", F.col("std") * F.sqrt((F.col("n") - 1) / F.col("n")))
    # d rows (one per dimension): broadcast
    j = long_df.join(F.broadcast(st), "dim")
    return j.select("id", "dim", F.when(F.col("std") > 0, (F.col("value") - F.col("mean")) / F.col("std"))
                    .otherwise(0.0).alias("value"))


def covariance(df: DataFrame, vec_col: str) -> DataFrame:
    """``(dim_i, dim_j, cov)`` sample covariance of an array column for ``i <= j``, any width.

    Each task adds up the Gramian of its centred rows with matrix products; their row blocks are
    summed in two levels by key (:func:`operators.pca.gramian_rows`).  The means come from one earlier pass.
    """
    x = df.select(F.col(vec_col).cast("array<double>").alias("x")).filter("x is not null")
    if x.isEmpty():
        return df.sparkSession.createDataFrame([], "dim_i int, dim_j int, cov double")
    first = x.agg(F.count(F.lit(1)).alias("n"), Summarizer.mean(array_to_vector("x")).alias("m")).first()
    n, mean = first["n"], first["m"].toArray()
    rows = gramian_rows(x, mean, np.ones(len(mean)), n)
    cells = rows.select("dim_i", F.posexplode("row").alias("dim_j", "v")).filter("dim_j >= dim_i")
    return cells.select("dim_i", "dim_j", (F.col("v") / F.nullif(F.lit(n - 1), F.lit(0))).alias("cov"))


def covariance_long(long_df: DataFrame, dims: int) -> DataFrame:
    """:func:`covariance` of a long ``(id, dim, value)`` table with ``dims`` values per id."""
    rows = long_df.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("dim", "value"))).alias("_v"))
    return covariance(rows.filter(F.size("_v") == dims).select(F.col("_v.value").alias("x")), "x")
