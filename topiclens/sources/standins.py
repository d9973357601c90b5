"""Stand-in inputs derived by Spark from the test tables.

The reference reads review/business JSON, photo metadata and photo files.  The test data
has none of those, so each is derived from a given table (see FIXTURES.md part 2); the
derivations are plain projections, so every query still reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as TX
from ..session import materialize
from .readers import read_table

PHOTOS_DIR = "/data/photos"
PATCH = 8  # patches are 8 x 8 pixels built from the 64 values of an embedding

# Per-channel means subtracted before the pretrained network (B, G, R order).
NETWORK_CHANNEL_MEANS = [103.939, 116.779, 123.68]


def businesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as businesses: ``business_id = p_partkey``, ``categories = p_name``."""
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("business_id"), F.col("p_name").alias("categories"))


LINEITEM_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as reviews: ``business_id = l_partkey``, ``stars = l_linenumber``."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(*LINEITEM_ORDER).withColumn("business_id", F.col("l_partkey")).withColumn(
        "stars", F.col("l_linenumber"))


def lineitem_key() -> Column:
    """A string key of a lineitem row for the seeded sample order."""
    return F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, lang, tokens)``: T1 then ``[a-z]{2,}`` tokens of every document.

    Stripping the ends cannot change ``[a-z]{2,}`` tokens, so only ``lower`` is applied."""
    d = documents(spark, sf_dir)
    return d.select("doc_id", "lang", TX.tokenize(F.lower("text")).alias("tokens"))


def photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as photo metadata: ``photo_id = vec_id`` (string), ``label``."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").cast("string").alias("photo_id"), "label")


def photo_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The photo directory listing: a file ``<vec_id>.jpg`` exists when ``vec_id % 3 <> 0``.

    This predicate stands for "which files are on disk" (a third of the photos are
    missing); it is not a cost cap, every embedding row is read.
    """
    e = read_table(spark, sf_dir, "embeddings").filter(F.col("vec_id") % 3 != 0)
    name = F.concat(F.col("vec_id").cast("string"), F.lit(".jpg"))
    return e.select(name.alias("file_name")).select(
        "file_name", F.split("file_name", "\\Q.jpg\\E").getItem(0).alias("photo_id"))


def embeddings_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(vec_id, label, vec ARRAY<DOUBLE>)``."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vec"))


def descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local descriptors: each embedding cut in 8 slices of 8 values,
    ``(image_id, desc_ix, descriptor ARRAY<DOUBLE>)``."""
    e = embeddings_double(spark, sf_dir)
    return e.select(F.col("vec_id").alias("image_id"),
                    F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(7)),
                                             lambda i: F.slice("vec", i * 8 + 1, 8))).alias("desc_ix", "descriptor"))


def fixed_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed 32-word dictionary: the slices of the vectors with ``vec_id < 4``,
    ``word_id = vec_id * 8 + desc_ix``."""
    d = descriptors(spark, sf_dir).filter(F.col("image_id") < 4)
    return d.select((F.col("image_id") * 8 + F.col("desc_ix")).cast("int").alias("word_id"),
                    F.col("descriptor").alias("centroid"))


def gray_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 x 8 gray images: pixel ``i`` = ``floor(255 * (e_i - min) / (max - min))``."""
    e = embeddings_double(spark, sf_dir).withColumn("_mn", F.array_min("vec")).withColumn("_mx", F.array_max("vec"))
    mn, mx = F.col("_mn"), F.col("_mx")
    px = F.transform("vec", lambda v: F.floor(F.lit(255.0) * (v - mn) / (mx - mn)).cast("int"))
    return e.select(F.col("vec_id").alias("image_id"), F.lit(PATCH).alias("height"),
                    F.lit(PATCH).alias("width"), F.lit(1).alias("n_channels"), px.alias("pixels"))


def color_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 x 8 three-channel images (BGR interleaved): channel ``c`` of pixel ``i`` is gray
    pixel ``(i + 21c) mod 64``."""
    g = gray_patches(spark, sf_dir)
    n = PATCH * PATCH
    px = F.transform(F.sequence(F.lit(0), F.lit(3 * n - 1)),
                     lambda j: F.element_at("pixels", ((F.floor(j / 3) + (j % 3) * 21) % n).cast("int") + 1))
    return g.select("image_id", "height", "width", F.lit(3).alias("n_channels"), px.alias("pixels"))


def label_mean_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(word_id = label, centroid)``: per-label mean embedding (k rows of d values)."""
    e = embeddings_double(spark, sf_dir)
    long = e.select("label", F.posexplode("vec").alias("dim", "v"))
    means = long.groupBy("label", "dim").agg(F.avg("v").alias("m"))
    return means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("dim", "m"))).alias("s")).select(
        F.col("label").cast("int").alias("word_id"), F.col("s.m").alias("centroid"))


def part_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(token, lemma, pos)`` from part names: first word ADJ, second word NOUN."""
    p = read_table(spark, sf_dir, "part").select(F.split("p_name", " ").alias("w"))
    adj = p.select(F.col("w")[0].alias("token"), F.lit("ADJ").alias("pos"))
    noun = p.select(F.col("w")[1].alias("token"), F.lit("NOUN").alias("pos"))
    return adj.union(noun).distinct().select("token", F.col("token").alias("lemma"), "pos")


def raw_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, tokens)``: every run of non-blank characters of the lower-cased documents, with all its marks and digits."""
    d = documents(spark, sf_dir)
    return d.select("doc_id", F.regexp_extract_all(F.lower("text"), F.lit(r"[^\x20\x09-\x0D]+"), 0).alias("tokens"))


def suffix_lexicon(tokens: DataFrame) -> DataFrame:
    """``(token, lemma, pos)`` of the alphabetic tokens: a lemma loses the ending ``ing``, ``ed`` or ``s``; the
    part of speech stands for what a tagger would say (VERB with such an ending, ADJ for an even length, else NOUN).

    The distinct words are written: the planner would drop ``distinct`` under a later ``min`` per word, and sort every token."""
    every = tokens.select(F.explode(F.array_distinct("tokens")).alias("token"))
    words = materialize(every.filter(F.col("token").rlike("^[a-z]+$")).distinct(), "lexicon_words")
    stem = F.regexp_replace("token", "(ing|ed|s)$", "")
    lemma = F.when(F.length(stem) >= 3, stem).otherwise(F.col("token"))
    pos = F.when(lemma != F.col("token"), "VERB").when(F.length("token") % 2 == 0, "ADJ").otherwise("NOUN")
    return words.select("token", lemma.alias("lemma"), pos.alias("pos"))


def event_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a text file would give it: the time as ``YYYY-MM-DD HH:MM:SS`` text, once with a broken month."""
    e = read_table(spark, sf_dir, "events")
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    broken = F.concat(F.substring(text, 1, 5), F.lit("13"), F.substring(text, 8, 12))
    return e.select("event_id", text.alias("ts"), F.when(F.col("event_id") % 7 == 0, broken).otherwise(text).alias("ts_broken"),
                    F.concat(F.lit("at "), text).alias("ts_note"), "event_type")
