"""topiclens: text-topic mining and clustering evaluation as Spark DataFrame jobs.

Sub-packages
------------
sources    readers and writers (JSON lines, Parquet tables, image files, review selection)
functions  Column expressions (text cleaning, regex tokenising, image arrays)
operators  DataFrame operators (sampling, vocabulary, TF-IDF, topic diagnostics, clustering metrics)
plans      multi-step jobs and ``pyspark.ml`` stages (LDA, KMeans, PCA, pipelines)
streaming  the stateless parts of the text pipeline on streaming DataFrames
"""

__version__ = "0.1.0"
