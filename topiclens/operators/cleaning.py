"""Word correction (T6) and token cleaning (T8) as joins against word tables.

Per-row language models are replaced by tables: a ``vocabulary(term)`` of known words and
an optional ``lexicon(token, lemma, pos)``.  The work is done on *distinct* words (a
partial aggregate before the shuffle, so a word used in every document costs one row per
map task), then joined back to documents by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as TX
from ..session import materialize
from .joins import key_counts, lookup_join


def default_stop_words(language: str = "english") -> list[str]:
    """The stop-word list Spark ships for ``StopWordsRemover`` (loaded on the driver, small)."""
    from pyspark.ml.feature import StopWordsRemover

    return list(StopWordsRemover.loadDefaultStopWords(language))


def word_table(spark, words, col: str = "term") -> DataFrame:
    """A one-column table from a small Python list (stop words, custom words)."""
    return spark.createDataFrame([(w,) for w in dict.fromkeys(words)], f"{col} string")


# ---------------------------------------------------------------------------
# T6 correct_repeated
# ---------------------------------------------------------------------------


def correction_candidates(word: Column) -> Column:
    """The four candidate spellings, in the order they are tried."""
    return F.array(
        word,
        TX.drop_repeated(word, 2),
        TX.drop_repeated(word, 3),
        TX.drop_repeated(word, 3, keep_double=True),
    )


def word_corrections(words: DataFrame, vocabulary: DataFrame, lexicon: DataFrame | None = None,
                     word_col: str = "word") -> DataFrame:
    """``(word, correction)`` for distinct words: the first candidate whose form, else whose
    lemma, is in ``vocabulary(term)``.  Words without any known candidate get no row."""
    distinct = words.select(F.col(word_col).alias("word")).distinct()
    cand = distinct.select("word", F.posexplode(correction_candidates(F.col("word"))).alias("k", "form"))
    if lexicon is not None:
        # one lemma per form whatever the partitioning: the smallest
        lem = lexicon.groupBy(F.col("token").alias("form")).agg(F.min("lemma").alias("lemma"))
        cand = cand.join(lem, "form", "left").withColumn("lemma", F.coalesce("lemma", "form"))
    else:
        cand = cand.withColumn("lemma", F.col("form"))
    # each candidate gives two tries: its form (order 2k) then its lemma (order 2k+1)
    tries = cand.select("word", F.explode(F.array(
        F.struct((F.col("k") * 2).alias("ord"), F.col("form").alias("result")),
        F.struct((F.col("k") * 2 + 1).alias("ord"), F.col("lemma").alias("result")),
    )).alias("t")).select("word", "t.ord", "t.result")
    known = tries.join(vocabulary.select(F.col("term").alias("result")).distinct(), "result", "left_semi")
    return known.groupBy("word").agg(F.min_by("result", "ord").alias("correction"))


def correct_repeated(docs: DataFrame, vocabulary: DataFrame, lexicon: DataFrame | None = None,
                     text_col: str = "text", id_col: str = "doc_id", n: int = 3,
                     whole_word: bool = True, materialize_found: bool = True) -> DataFrame:
    """``docs`` with ``text_col`` corrected.

    Words holding a letter ``n`` times in a row are replaced by their correction.  With
    ``whole_word`` (default) only whole words are replaced; ``whole_word=False`` replaces
    every occurrence of the word as a regular expression, in first-appearance order.
    """
    found = docs.select(id_col, F.posexplode(TX.find_repeated(text_col, n)).alias("pos", "word"))
    if materialize_found:
        # two branches read the found words; scan the text for them once
        found = materialize(found, "found_words")
    fixes = word_corrections(found, vocabulary, lexicon).filter(F.col("word") != F.col("correction"))
    first = found.groupBy(id_col, "word").agg(F.min("pos").alias("pos"))
    per_doc = (lookup_join(first, fixes, "word")
               .groupBy(id_col)
               .agg(F.array_sort(F.collect_list(F.struct(F.col("pos"), "word", "correction"))).alias("_fix")))
    joined = docs.join(per_doc, id_col, "left")
    txt = F.col(text_col)
    if whole_word:
        # the map is its own column: a lambda re-evaluates any expression it references
        joined = joined.withColumn("_map", F.map_from_arrays(F.col("_fix.word"), F.col("_fix.correction")))
        pieces = TX.word_pieces(txt)
        fixed = F.array_join(F.transform(pieces, lambda p: F.coalesce(F.element_at(F.col("_map"), p), p)), "")
        new = F.when(F.col("_fix").isNull(), txt).otherwise(fixed)
    else:
        new = F.when(F.col("_fix").isNull(), txt).otherwise(
            F.aggregate(F.col("_fix"), txt, lambda acc, e: F.regexp_replace(acc, e["word"], e["correction"])))
    return joined.withColumn(text_col, new).drop("_fix", "_map")


# ---------------------------------------------------------------------------
# T8 clean_tokens
# ---------------------------------------------------------------------------


def clean_token_arrays(df: DataFrame, tokens_col: str = "tokens", stop_words=None,
                       custom_stop_words=None, drop_numbers: bool = True) -> DataFrame:
    """T8 without a lexicon, inside each document row: the token array is filtered in place
    (no explode, no shuffle).  Word lists are fixed and small; ``isin`` on them becomes a
    hash-set lookup.  Without a lexicon the lemma is the token, so custom stop words (tested
    on the lemma) and stop words (tested on the form) test the same string."""
    words = list(dict.fromkeys(list(stop_words or []) + list(custom_stop_words or [])))

    def keep(t):
        drop = TX.is_punct(t) | TX.is_space(t) | TX.is_digit(t)
        if drop_numbers:
            drop = drop | TX.like_number(t)
        if words:
            drop = drop | t.isin(*words)
        return ~drop

    return df.withColumn(tokens_col, F.filter(F.col(tokens_col), keep))


def clean_tokens(tokens: DataFrame, stop_words: DataFrame | None = None,
                 lexicon: DataFrame | None = None, pos_to_keep=None,
                 custom_stop_words: DataFrame | None = None,
                 drop_numbers: bool = True) -> DataFrame:
    """T8 on long tokens ``(doc_id, pos, term)`` -> ``(doc_id, pos, term)`` of kept lemmas.

    Dropped: stop words (surface form), punctuation, spaces, digits, number-like words;
    tokens whose part of speech is not in ``pos_to_keep`` (needs ``lexicon``); lemmas in
    ``custom_stop_words``.  Without a lexicon the lemma is the token itself.
    """
    # every test looks at the word alone: the distinct words are judged, and tokens meet the verdict by key
    counts = key_counts(tokens, "term")
    w = counts.select("term")
    if stop_words is not None:
        # a fixed word list: its size is bounded, so it is broadcast
        w = w.join(F.broadcast(stop_words.select("term").distinct()), "term", "left_anti")
    keep = ~(TX.is_punct("term") | TX.is_space("term") | TX.is_digit("term"))
    if drop_numbers:
        keep = keep & ~TX.like_number("term")
    w = w.filter(keep)
    if lexicon is not None:
        # a token has one lemma: the smallest among its entries (those with a kept tag)
        lex = lexicon.filter(F.col("pos").isin(*pos_to_keep)) if pos_to_keep else lexicon
        lex = lex.groupBy(F.col("token").alias("term")).agg(F.min("lemma").alias("lemma"))
        w = w.join(lex, "term", "inner" if pos_to_keep else "left")
        w = w.withColumn("lemma", F.coalesce("lemma", "term"))
    else:
        w = w.withColumn("lemma", F.col("term"))
    if custom_stop_words is not None:  # a word list too: broadcast
        w = w.join(F.broadcast(custom_stop_words.select(F.col("term").alias("lemma")).distinct()), "lemma", "left_anti")
    judged = materialize(w.select("term", "lemma"), "judged_words")
    t = lookup_join(tokens, judged, "term", counts=counts)  # a common word may hold a third of the tokens
    return t.select("doc_id", "pos", F.col("lemma").alias("term"))
