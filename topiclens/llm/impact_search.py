"""Ranked lexical search by the Best Position Algorithm over impact lists.

Terms are runs of ASCII letters and digits and of characters beyond ASCII, with A-Z folded.  A
document's score for an item is an integer sum of impacts, ``w * ((10^9 tf) div (1000 tf + 8 m))``,
over the item's terms with repeats; ``w`` depends on the term's document frequency and ``m`` on
the document's length against the mean (see ``Weights``).

1. One pass over the documents counts N, L and the document frequency of the items' terms; each
   task sums before the small shuffle.
2. A second pass cuts the documents into slices of bounded bytes.  In a slice every item term has
   an impact list (documents by falling impact).  For an item, the lists are read downwards side by
   side; each document met is looked up in all lists at once (direct access), which marks its
   places there.  A list's best position is the end of its gapless run of marked places, which
   direct accesses push far below the last place read.  A document not met yet lies under the best
   position of every list, so the sum of the impacts there bounds its score; reading stops when
   that bound is strictly below the k-th score, so equal scores are all met.
3. A task carries its best k per item from slice to slice (they raise the k-th score) and returns
   them once; the parts are merged in two grouped steps.

No list, document set or index is gathered anywhere: the slices are independent, a lost executor
repeats its own tasks only.  Items are taken in blocks of ``ITEM_BYTES`` of text, each block
against all documents, so what is sent to the tasks has a fixed bound.

Terms are told apart by 64-bit hashes: a false match of one of T item terms with one of V other
words has probability T * V / 2^64.

Defined results: null and empty texts (of documents or items) have no terms and are neither found
nor answered; every row is a document or an item of its own, so repeated rows are ranked (answered)
as often as they come; equal scores go by ascending ``doc_id``, a null id last; without documents
or items the result is empty.  Only ``doc_id``, ``text`` and ``item_id``, ``text`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .arrow_text import Spans, Texts, runs_of, slices, span_hashes, texts_of
from .blocks import block_count

ITEM_BYTES = 4 << 20
SLICE_BYTES = 16 << 20
MERGE_PARTS = 64

IS_TERM = np.zeros(256, dtype=bool)
IS_TERM[48:58] = IS_TERM[65:91] = IS_TERM[97:123] = True
IS_TERM[128:] = True


def terms_of(t: Texts) -> tuple[np.ndarray, Spans]:
    """The hash of every term of a batch, and the terms."""
    spans = runs_of(t, IS_TERM[t.buf])
    return span_hashes(t, spans, lower=True), spans


@dataclass(frozen=True)
class Items:
    """A block of items: the distinct terms, and each item's terms with their counts."""

    ids: list
    terms: np.ndarray
    wanted: list[tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def of(table: pa.Table) -> Items:
        t = texts_of(table.column("text"))
        hashes, spans = terms_of(t)
        terms, code = np.unique(hashes, return_inverse=True)
        wanted = [np.unique(code[a:b], return_counts=True) for a, b in zip(spans.first[:-1], spans.first[1:])]
        return Items(table.column("item_id").to_pylist(), terms, wanted)


@dataclass(frozen=True)
class Weights:
    """Counts over all documents, and what follows from them."""

    documents: int
    length: int
    weight: np.ndarray

    @staticmethod
    def of(documents: int, length: int, found_in: np.ndarray) -> Weights:
        top = 2 * documents + 2
        return Weights(documents, length, np.array(
            [math.floor(1000 * math.log(top / (2 * int(df) + 1))) for df in found_in], dtype=np.int64))

    def impact(self, term: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 100 - 75 + (75 * n * self.documents) // max(1, self.length)
        return self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def _term_ids(hashes: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the hashes that are item terms, and which terms they are."""
    if not len(terms):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    hit = np.flatnonzero(terms[at] == hashes)
    return hit, at[hit]


@dataclass(frozen=True)
class ImpactLists:
    """The postings of a slice by (term, document); ``ranked`` lists those of a term by falling impact."""

    n_docs: int
    first: np.ndarray
    docs: np.ndarray
    impact: np.ndarray
    ranked: np.ndarray
    place: np.ndarray

    @staticmethod
    def of(hashes: np.ndarray, owner: np.ndarray, n_terms: np.ndarray, items: Items, weights: Weights) -> ImpactLists:
        n_docs = len(n_terms)
        hit, term = _term_ids(hashes, items.terms)
        scoring = weights.weight[term] > 0
        pairs, tf = np.unique(term[scoring] * n_docs + owner[hit[scoring]], return_counts=True)
        term, docs = pairs // max(1, n_docs), pairs % max(1, n_docs)
        impact = weights.impact(term, tf.astype(np.int64), n_terms[docs])
        first = np.searchsorted(term, np.arange(len(items.terms) + 1))
        ranked = np.lexsort((docs, -impact, term))
        place = np.empty(len(ranked), dtype=np.int64)
        place[ranked] = np.arange(len(ranked)) - first[term[ranked]]
        return ImpactLists(n_docs, first, docs, impact, ranked, place)


def _common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the values that two ascending arrays share, looked up from the shorter one."""
    if len(a) > len(b):
        j, i = _common(b, a)
        return i, j
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    same = np.flatnonzero(b[at] == a)
    return same, at[same]


def best_positions(lists: ImpactLists, terms: np.ndarray, times: np.ndarray, k: int,
                   others: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The k best documents of a slice and their scores (those below the k-th of ``others`` may lack).

    ``others`` are scores that earlier slices have reached.  The third value is the number of
    documents that were met.
    """
    spans = [(int(lists.first[t]), int(lists.first[t + 1]), int(c)) for t, c in zip(terms, times)]
    spans = [x for x in spans if x[1] > x[0]]
    seen = [np.zeros(b - a, dtype=bool) for a, b, _ in spans]
    best = [0] * len(spans)
    known = np.zeros(lists.n_docs, dtype=bool)
    docs = scores = np.zeros(0, dtype=np.int64)
    depth, step, met = 0, k, 0
    while spans:
        read = [lists.ranked[a + depth:min(b, a + depth + step)] for a, b, _ in spans]
        fresh = np.unique(lists.docs[np.concatenate(read)])
        fresh = fresh[~known[fresh]]
        if len(fresh):
            known[fresh] = True
            met += len(fresh)
            total = np.zeros(len(fresh), dtype=np.int64)
            for (a, b, c), mark in zip(spans, seen):
                at, which = _common(lists.docs[a:b], fresh)
                total[which] += c * lists.impact[a + at]
                mark[lists.place[a + at]] = True
            docs, scores = np.concatenate((docs, fresh)), np.concatenate((scores, total))
            if len(docs) > k:
                keep = np.lexsort((docs, -scores))[:k]
                docs, scores = docs[keep], scores[keep]
        bound = 0
        for j, (a, b, c) in enumerate(spans):
            rest = seen[j][best[j]:]
            if len(rest):
                gap = int(np.argmin(rest))
                best[j] += len(rest) if rest[gap] else gap
            if best[j] < b - a:
                bound += c * int(lists.impact[lists.ranked[a + best[j]]])
        reached = np.concatenate((others, scores))
        kth = int(np.partition(reached, len(reached) - k)[len(reached) - k]) if len(reached) >= k else 0
        if bound == 0 or bound < kth:
            break
        depth += step
        step *= 2
    some = scores > 0
    return docs[some], scores[some], met


def _count_terms(docs: DataFrame, items: Items) -> Weights:
    terms = items.terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(terms) + 2, dtype=np.int64)  # ... and the documents, and their terms
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                t = texts_of(batch.column("text"))
                hashes, spans = terms_of(t)
                hit, term = _term_ids(hashes, terms)
                pairs = np.unique(term * len(t) + spans.owner[hit])
                found[:-2] += np.bincount(pairs // len(t), minlength=len(terms))
                found[-2] += int((spans.counts > 0).sum())
                found[-1] += len(hashes)
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(found[some], pa.int64())], ["term", "n"])

    parts = docs.select("text").mapInArrow(run, "term long, n long")
    total = np.zeros(len(terms) + 2, dtype=np.int64)
    for row in parts.groupBy("term").agg(F.sum("n").alias("n")).collect():  # one row per item term and two more
        total[row["term"]] = row["n"]
    return Weights.of(int(total[-2]), int(total[-1]), total[:-2])


def _search(docs: DataFrame, items: Items, weights: Weights, k: int, item_field: StructField) -> DataFrame:
    id_field = docs.schema["doc_id"]
    schema = StructType([StructField("q", IntegerType()), StructField("item_id", item_field.dataType),
                         StructField("doc_id", id_field.dataType), StructField("score", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: list[list] = [[] for _ in items.ids]
        item_type = id_type = None
        for whole in batches:
            id_type = whole.column("doc_id").type
            for batch in slices(whole, "text", SLICE_BYTES):
                by_id = pc.sort_indices(batch.column("doc_id"), null_placement="at_end").to_numpy(zero_copy_only=False)
                rank = np.empty(len(by_id), dtype=np.int64)
                rank[by_id] = np.arange(len(by_id))
                hashes, spans = terms_of(texts_of(batch.column("text")))
                lengths = np.empty(len(by_id), dtype=np.int64)
                lengths[rank] = spans.counts
                lists = ImpactLists.of(hashes, rank[spans.owner], lengths, items, weights)
                for q, (terms, times) in enumerate(items.wanted):
                    others = np.array([-x[0] for x in tops[q]], dtype=np.int64)
                    found, scores, _ = best_positions(lists, terms, times, k, others)
                    if len(found):
                        ids = batch.column("doc_id").take(pa.array(by_id[found])).to_pylist()
                        new = [(-int(s), i is None, 0 if i is None else i) for s, i in zip(scores, ids)]
                        tops[q] = sorted(tops[q] + new)[:k]
        rows = [(q, item, None if x[1] else x[2], -x[0]) for q, item in enumerate(items.ids) for x in tops[q]]
        if rows:
            q, item, doc, score = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int32()), pa.array(item, item_type), pa.array(doc, id_type),
                 pa.array(score, pa.int64())], schema.names)

    parts = docs.select("doc_id", "text").mapInArrow(run, schema).withColumn("part", F.spark_partition_id() % MERGE_PARTS)
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    for keys in (("q", "part"), ("q",)):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        parts = parts.withColumn("rank", rank).filter(F.col("rank") <= k)
    return parts.select("item_id", "rank", "doc_id", "score")


def ranked_search(items: DataFrame, docs: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item, best first.

    ``items`` has ``item_id`` and ``text``, ``docs`` has ``doc_id`` and ``text``.
    """
    asked = items.select("item_id", "text").filter(F.octet_length("text") > 0)
    blocks = block_count(asked, block_bytes=ITEM_BYTES)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    out = None
    for b in range(blocks):
        few = Items.of(asked.filter(block == b).toArrow())
        part = _search(docs, few, _count_terms(docs, few), k, items.schema["item_id"])
        out = part if out is None else out.unionByName(part)
    return out
