"""The stateless part of the text pipeline on streaming DataFrames.

Cleaning (T1-T3), tokenising (T7) and vectorising with an already fitted vocabulary are
row-by-row expressions, so they run unchanged on ``readStream`` input: no state store, no
watermark, and each micro-batch is independent.  Vectorising uses ``CountVectorizerModel``
built from the fitted vocabulary, then the fitted IDF weights and an L2 norm, all in the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions import text as TX
from ..plans import models as MD

DOC_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def read_text_stream(spark: SparkSession, path: str, schema: T.StructType = DOC_SCHEMA,
                     fmt: str = "json", max_files_per_trigger: int | None = None) -> DataFrame:
    """A file-source stream of documents with an explicit schema."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def clean_stream(stream: DataFrame, text_col: str = "text") -> DataFrame:
    """T1 -> T2 -> T3 -> T7: adds ``clean`` and ``tokens``."""
    clean = TX.clean_text(text_col)
    return stream.withColumn("clean", clean).withColumn("tokens", TX.tokenize("clean"))


def vectorize_stream(stream: DataFrame, terms: list[str], dfs: list[int], n_docs: int) -> DataFrame:
    """Sparse TF-IDF ``features`` (log2 IDF, L2 norm) from a fitted vocabulary."""
    idf = [math.log2(n_docs / d) for d in dfs]
    return MD.tfidf_vectors(MD.count_vectors(stream, terms), idf).drop("counts")


def write_parquet(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Start the query writing Parquet; the checkpoint folder makes it restartable."""
    w = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


__all__ = ["read_text_stream", "clean_stream", "vectorize_stream", "write_parquet"]
