"""Readers and writers.

Every reader takes an explicit schema, so nothing is inferred by a pass over the data and
nested JSON fields that are not selected are pruned at the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as TX
from ..operators import sampling as S

BUSINESS_SCHEMA = T.StructType([
    T.StructField("business_id", T.StringType()),
    T.StructField("categories", T.StringType()),
])
REVIEW_SCHEMA = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("stars", T.IntegerType()),
    T.StructField("text", T.StringType()),
])
PHOTO_SCHEMA = T.StructType([
    T.StructField("photo_id", T.StringType()),
    T.StructField("label", T.StringType()),
])


SPREAD_MIN_BYTES = 4 << 20


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan over the cluster's cores when it has fewer splits than cores.

    A big input already has many splits (files, row groups) and is returned as is, so the
    extra shuffle only happens for small single-file inputs, where one task would otherwise
    run all the per-row regex work.  The check reads only file metadata (no job).
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    # estimated from file sizes by the planner (no job); tiny tables are not worth a shuffle
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size >= SPREAD_MIN_BYTES else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables of a test-data folder, spread over the cores if needed."""
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def json_scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Line-delimited JSON with an explicit schema (splittable, no inference pass)."""
    return spark.read.schema(schema).json(path)


def write_json(df: DataFrame, path: str) -> str:
    """Write JSON lines (one file per partition)."""
    df.write.mode("overwrite").json(path)
    return path


def save_table(df: DataFrame, path: str) -> str:
    """Keep an intermediate result as Parquet (the lineage stops at the written table)."""
    df.write.mode("overwrite").parquet(path)
    return path


def load_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a table written by :func:`save_table`."""
    return spark.read.parquet(path)


def photo_path(photos_dir: str, photo_id: Column | str) -> Column:
    """P5: ``<dir>/<photo_id>.jpg``."""
    pid = F.col(photo_id) if isinstance(photo_id, str) else photo_id
    return F.concat(F.lit(photos_dir.rstrip("/") + "/"), pid.cast("string"), F.lit(".jpg"))


def with_photo_path(photos: DataFrame, photos_dir: str, id_col: str = "photo_id") -> DataFrame:
    """S3: photo metadata plus ``photo_path``."""
    return photos.withColumn("photo_path", photo_path(photos_dir, id_col))


def load_photo_meta(spark: SparkSession, json_path: str, photos_dir: str) -> DataFrame:
    """S3: read photo metadata JSON and add ``photo_path``."""
    return with_photo_path(json_scan(spark, json_path, PHOTO_SCHEMA), photos_dir)


def file_stem(name: Column | str, ext: str = ".jpg") -> Column:
    """Text before the first ``ext`` (the dot is literal)."""
    c = F.col(name) if isinstance(name, str) else name
    return F.split(c, "\\Q" + ext + "\\E").getItem(0)


def base_name(path: Column | str) -> Column:
    """Last path component of a file URI."""
    c = F.col(path) if isinstance(path, str) else path
    return F.element_at(F.split(c, "/"), -1)


def list_files(spark: SparkSession, directory: str, glob: str = "*.jpg") -> DataFrame:
    """``(path, file_name, photo_id, length)`` of a directory; file contents are never read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .load(directory).select("path", "length"))
    return files.select("path", base_name("path").alias("file_name"),
                        file_stem(base_name("path")).alias("photo_id"), "length")


def available_photos(photos: DataFrame, files: DataFrame, id_col: str = "photo_id") -> DataFrame:
    """Photos whose file exists (left semi-join on the id)."""
    return S.semi_join(photos, files.select(id_col), id_col)


def sample_photos(photos: DataFrame, files: DataFrame | None, n_per_label: int, seed: int = 16,
                  id_col: str = "photo_id", label_col: str = "label") -> DataFrame:
    """``sampPhotos``: keep photos with a file, then ``n_per_label`` per label (falsy: all)."""
    avail = available_photos(photos, files, id_col) if files is not None else photos
    return S.stratified_sample_n(avail, label_col, id_col, n_per_label, seed)


def retention_manifest(files: DataFrame, keep: DataFrame, id_col: str = "photo_id") -> DataFrame:
    """Files that are *not* in the keep set.  A manifest only: nothing is deleted."""
    return S.anti_join(files, keep.select(id_col), id_col)


def load_images(spark: SparkSession, path: str, drop_invalid: bool = True) -> DataFrame:
    """Decode images with Spark's ``image`` source (BGR bytes, one row per file)."""
    return (spark.read.format("image").option("dropInvalid", drop_invalid).load(path)
            .select(F.col("image.origin").alias("origin"), F.col("image.height").alias("height"),
                    F.col("image.width").alias("width"), F.col("image.nChannels").alias("n_channels"),
                    F.col("image.mode").alias("mode"), F.col("image.data").alias("data")))


def select_reviews(businesses: DataFrame, reviews: DataFrame, category: str, stars,
                   size: int, order: list, hash_key: Column, seed: int = 16,
                   biz_key: str = "business_id", cat_col: str = "categories",
                   stars_col: str = "stars", chunked: bool = True) -> DataFrame:
    """S7 (``loadReviews``): reviews of businesses whose categories contain ``category``,
    with stars in ``stars``, sampled.

    ``chunked=True`` reproduces the chunked reader (W2); ``chunked=False`` takes a plain
    seeded sample of ``size`` rows (W3), the unbiased choice.
    """
    ids = businesses.filter(TX.contains_ci(cat_col, category)).select(biz_key).distinct()
    qualifying = S.semi_join(reviews, ids, biz_key)
    star_ok = F.col(stars_col).isin(*S.as_list(stars))
    if chunked:
        # the chunk boundaries count *every* review line, so the filter goes inside W2
        flagged = reviews.join(ids.withColumn("_biz_ok", F.lit(True)), biz_key, "left")
        match = star_ok & F.coalesce(F.col("_biz_ok"), F.lit(False))
        return S.chunk_sample(flagged, order, match, size, hash_key, seed, base=reviews).drop("_biz_ok")
    filtered = qualifying.filter(star_ok)
    return filtered.orderBy(S.seeded_hash(hash_key, seed), *order).limit(int(size))
