"""Vocabulary, bag of words and TF-IDF on long (doc_id, term, ...) tables.

Plan shape (no collect, at most one shuffle per step):

* ``term_counts``: counted inside each document row (numbers of a batch's tokens, sort, run lengths) as
  ``(doc_id, term, tf)``: no shuffle, a document never leaves its partition.
* ``build_vocabulary``: ``groupBy(term)`` with map-side partial aggregation; a hot term
  ("the" in every document) is combined before the shuffle.
* ``filter_extremes`` keeps at most ``keep_n`` terms, ranked by a distributed index, so the
  vocabulary that later joins broadcast has a proven size bound; without ``keep_n`` (or
  above ``BROADCAST_VOCAB_MAX_TERMS``) the joins are left to AQE's runtime size check.
* ``tfidf``: one shuffle on ``doc_id`` for the per-document norm window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .indexing import with_global_index

# Above this many terms (about 10 MB) a vocabulary is not broadcast by hint; AQE decides
# from the runtime size instead.
BROADCAST_VOCAB_MAX_TERMS = 200_000
SLICE_ROWS = 1_024  # documents whose tokens are numbered together


def explode_tokens(tokens_df: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """``(doc_id, pos, term)``."""
    return tokens_df.select("doc_id", F.posexplode(tokens_col).alias("pos", "term"))


def collect_tokens(long_df: DataFrame, term_col: str = "term") -> DataFrame:
    """R2: ``(doc_id, tokens, text)`` back from ``(doc_id, pos, term)``, in position order.

    Rows are dealt by document first: lists of parts of a document, made before the shuffle, save nothing."""
    g = long_df.repartition("doc_id").groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", F.col(term_col).alias("term")))).alias("_p")
    )
    return g.select("doc_id", F.col("_p.term").alias("tokens"),
                    F.array_join(F.col("_p.term"), " ").alias("text"))


def term_counts(tokens_df: DataFrame, tokens_col: str = "tokens", keep: list[str] | None = None) -> DataFrame:
    """``(doc_id, term, tf)`` for every distinct token of every document, with no shuffle (``keep``: more columns).

    A document is one row, so its counts need its row only.  The tokens of some documents become numbers
    (their places among the distinct ones); ``document x tokens + token`` is sorted, and each run of equal
    numbers is one ``(term, run length)``.
    """
    ids = ["doc_id", *(keep or [])]
    rows = tokens_df.select(*ids, F.col(tokens_col).alias("_tokens"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (b.slice(at, SLICE_ROWS) for b in batches for at in range(0, b.num_rows, SLICE_ROWS)):
            lists = part.column("_tokens")
            n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            words = lists.flatten().dictionary_encode(null_encoding="encode")
            if not len(words):
                continue
            size = len(words.dictionary)
            key = np.repeat(np.arange(len(n)) * size, n) + words.indices.to_numpy()
            key.sort()
            lead = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            doc, term = np.divmod(key[lead], size)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c).take(pa.array(doc)) for c in ids), words.dictionary.take(pa.array(term)),
                 pa.array(np.diff(np.append(lead, len(key))))], [*ids, "term", "tf"])

    kind = rows.schema["_tokens"].dataType.elementType
    return rows.mapInArrow(run, StructType([*(rows.schema[c] for c in ids), StructField("term", kind), StructField("tf", LongType())]))


def build_vocabulary(counts: DataFrame) -> DataFrame:
    """A1: ``(term, df, cf)``: documents holding the term and total occurrences."""
    return counts.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").cast("long").alias("cf")
    )


def filter_extremes(vocab: DataFrame, n_docs: int, no_below: int = 0, no_above: float = 1.0,
                    keep_n: int | None = 100_000) -> DataFrame:
    """A2: keep ``no_below <= df <= int(no_above * N)``, then the ``keep_n`` most frequent.

    Ids are ``0..`` in ``(df desc, term)`` order over the kept terms.  The ranking is a
    distributed sort with per-partition offsets (``with_global_index``), so neither a
    single task nor the driver ever holds more than one range partition of the vocabulary;
    ``keep_n`` then is a filter on the id.
    """
    upper = int(no_above * n_docs)
    kept = vocab.filter((F.col("df") >= no_below) & (F.col("df") <= upper))
    order = [F.col("df").desc(), F.col("term").asc()]
    indexed = with_global_index(kept, order, "term_id")
    if keep_n is not None:
        indexed = indexed.filter(F.col("term_id") < int(keep_n))
    return indexed.select("term", F.col("term_id").cast("int").alias("term_id"), "df", "cf")


def _vocab_side(vocab_ids: DataFrame, keep_n: int | None) -> DataFrame:
    if keep_n is not None and keep_n <= BROADCAST_VOCAB_MAX_TERMS:
        return F.broadcast(vocab_ids)
    return vocab_ids


def bag_of_words(counts: DataFrame, vocab_ids: DataFrame, keep_n: int | None = 100_000) -> DataFrame:
    """A3: ``(doc_id, term_id, tf)``; terms outside the vocabulary are dropped."""
    v = _vocab_side(vocab_ids.select("term", "term_id"), keep_n)
    return counts.join(v, "term").select("doc_id", "term_id", "tf")


# ---------------------------------------------------------------------------
# TF-IDF (SMART codes)
# ---------------------------------------------------------------------------


def _local_weight(code: str, tf: Column, doc: Window) -> Column:
    tf = tf.cast("double")
    if code == "n":
        return tf
    if code == "l":
        return 1.0 + F.log2(tf)
    if code == "a":
        return 0.5 + 0.5 * tf / F.max(tf).over(doc)
    if code == "b":
        return F.when(tf > 0, 1.0).otherwise(0.0)
    if code == "L":
        return (1.0 + F.log2(tf)) / (1.0 + F.log2(F.avg(tf).over(doc)))
    raise ValueError(f"unsupported term-frequency code {code!r}")


def _global_weight(code: str, df: Column, n_docs: int) -> Column:
    df = df.cast("double")
    if code == "n":
        return F.lit(1.0)
    if code == "f":
        return F.log2(F.lit(float(n_docs)) / df)
    if code == "t":
        return F.log2(F.lit(float(n_docs + 1)) / df)
    if code == "p":
        return F.greatest(F.lit(0.0), F.log2((F.lit(float(n_docs)) - df) / df))
    raise ValueError(f"unsupported document-frequency code {code!r}")


def weight_matrix(bow: DataFrame, df_table: DataFrame, n_docs: int, smartirs: str = "nfc",
                  key: str = "doc_id", item: str = "term_id", count: str = "tf",
                  drop_zero: bool = True, eps: float = 1e-12, broadcast_df: bool = True) -> DataFrame:
    """A4/A5: ``(key, item, weight)`` from counts and document frequencies.

    ``df_table`` is ``(item, df)``.  Default ``nfc`` = raw count x log2(N/df), L2-normalised per key.
    A key whose weights are all zero keeps zero weights (no NaN).
    """
    if len(smartirs) != 3:
        raise ValueError("smartirs must have three letters")
    tf_code, df_code, norm_code = smartirs
    doc = Window.partitionBy(key)
    d = df_table.select(item, "df")
    j = bow.join(F.broadcast(d) if broadcast_df else d, item)
    w = _local_weight(tf_code, F.col(count), doc) * _global_weight(df_code, F.col("df"), n_docs)
    out = j.select(key, item, w.alias("weight"))
    if norm_code == "c":
        norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(doc))
        out = out.select(key, item, F.when(norm > 0, F.col("weight") / norm).otherwise(0.0).alias("weight"))
    elif norm_code != "n":
        raise ValueError(f"unsupported normalisation code {norm_code!r}")
    if drop_zero:
        out = out.filter(F.abs("weight") >= eps)
    return out


def tfidf(bow: DataFrame, vocab_ids: DataFrame, n_docs: int, smartirs: str = "nfc",
          keep_n: int | None = 100_000, drop_zero: bool = True) -> DataFrame:
    """A4: ``(doc_id, term_id, weight)``; N counts every document of the corpus."""
    return weight_matrix(bow, vocab_ids.select("term_id", "df"), n_docs, smartirs,
                         drop_zero=drop_zero,
                         broadcast_df=keep_n is not None and keep_n <= BROADCAST_VOCAB_MAX_TERMS)


def nonzero_counts(long_df: DataFrame, item: str, value: str, n_rows: int, items: DataFrame | None = None) -> DataFrame:
    """``(item, n_rows, n_nonzero)`` over the whole matrix: all its rows, and those with a positive value.

    ``n_rows`` counts every row of the matrix (document, image), those without an entry included; ``items``
    adds the columns that have no entry at all.
    """
    found = long_df.groupBy(item).agg(F.count_if(F.col(value) > 0).alias("n_nonzero"))
    if items is not None:
        found = items.select(item).join(found, item, "left").fillna(0, ["n_nonzero"])
    return found.select(item, F.lit(n_rows).cast("long").alias("n_rows"), "n_nonzero")
