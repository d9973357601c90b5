"""The registered queries of this package: thin contracts over the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann_search import nearest
from .fill_in_middle import fill_in_middle, restored
from .impact_search import ranked_search
from .license_scan import license_scan
from .line_dedup import line_dedup
from .maxent_lm import fit_and_score
from .packing import pack_documents
from .pii import digest, personal_spans
from .quality_rules import quality_measures
from .simhash_dedup import simhash_dedup
from .source_mixing import mix_sources
from .substring_dedup import substring_dedup
from .url_filters import judge_urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base score and log10 probability under the maximum-entropy model."""
    scored, _ = fit_and_score(_table(spark, sf_dir, "documents"))
    return scored


def op2_multiprobe_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20."""
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the line-first quality rules for every document."""
    out = quality_measures(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "n_lost_words")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat a kept line."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_removed", "text")


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (3-word shingles, 2 bits)."""
    out = simhash_dedup(_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return out.select("doc_id", "fingerprint", "component_id")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words under a 13-word window that starts in an earlier document, removed."""
    out = substring_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 4096 tokens."""
    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path(), max_len=4096, end_id=2)


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, fitting rule and verdict of every page url."""
    return judge_urls(_table(spark, sf_dir, "pages"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    return mix_sources(_table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal-data spans of every document, with the terms that disclose them."""
    return digest(personal_spans(_table(spark, sf_dir, "documents")))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked_search(_table(spark, sf_dir, "benchmark"), _table(spark, sf_dir, "documents"), k=10)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, part sizes and hashes of every document's output and of the text rebuilt from it."""
    out = restored(fill_in_middle(_table(spark, sf_dir, "documents")))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"), F.sha2("text", 256).alias("restored_sha256"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document; ``spans`` lists the notices as label:first:last:edits."""
    span = F.transform("matches", lambda m: F.concat_ws(":", m["label"], *(
        m[c].cast("string") for c in ("first_word", "last_word", "edits"))))
    return license_scan(_table(spark, sf_dir, "documents")).withColumn("spans", F.array_join(span, ",")).drop("matches")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of ``corpus_pipeline`` over ``documents``."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
