"""Topic diagnostics on long tables.

Inputs are the exported forms of any topic model:

* ``topic_term(topic, term, p)`` with ``p = p(w|t)`` (rows of a topic sum to 1),
* ``doc_topic(doc_id, topic, p)`` with ``p = p(t|d)``,
* ``doc_len(doc_id, n_tokens)`` and ``term_freq(term, freq)`` from the corpus.

All formulas are joins and aggregates.  The tables indexed by topic have ``k`` rows (or
``k x k``), so only those are broadcast; term- and document-sized tables are joined by
key and left to AQE.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType


def top_terms(topic_term: DataFrame, n: int, topic: str = "topic", term: str = "term",
              weight: str = "p") -> DataFrame:
    """``(topic, term, weight, rank)`` top ``n`` per topic (weight desc, term asc)."""
    w = Window.partitionBy(topic).orderBy(F.col(weight).desc(), F.col(term))
    return (topic_term.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= n))


def topic_prevalence(doc_topic: DataFrame, doc_len: DataFrame | None = None) -> DataFrame:
    """``(topic, size, share)``: sum of p(t|d), weighted by document length if given."""
    dt = doc_topic
    if doc_len is not None:
        dt = dt.join(doc_len, "doc_id")
        mass = F.col("p") * F.col("n_tokens")
    else:
        mass = F.col("p")
    sizes = dt.groupBy("topic").agg(F.sum(mass).cast("double").alias("size"))
    return sizes.withColumn("share", F.col("size") / F.sum("size").over(Window.partitionBy()))


def term_frequency(long_counts: DataFrame, term: str = "term", count: str = "tf") -> DataFrame:
    """``(term, freq)``: corpus frequency of each term."""
    return long_counts.groupBy(term).agg(F.sum(count).cast("long").alias("freq"))


def topic_term_estimate(topic_term: DataFrame, prevalence: DataFrame) -> DataFrame:
    """``(topic, term, est_freq)`` = p(w|t) x topic size."""
    sizes = F.broadcast(prevalence.select("topic", "size"))  # k rows
    return topic_term.join(sizes, "topic").select(
        "topic", "term", (F.col("p") * F.col("size")).alias("est_freq"))


def term_topic_distribution(estimates: DataFrame) -> DataFrame:
    """``(term, topic, share)``: how one term's estimated frequency splits over topics."""
    return estimates.select(
        "term", "topic",
        F.coalesce(F.col("est_freq") / F.nullif(F.sum("est_freq").over(Window.partitionBy("term")), F.lit(0.0)),
                   F.lit(0.0)).alias("share"))


def _p_term(term_freq: DataFrame) -> DataFrame:
    """``(term, pw)``: corpus share of each term (the total is a one-row table)."""
    total = term_freq.agg(F.sum("freq").cast("double").alias("_total"))
    return term_freq.crossJoin(F.broadcast(total)).select(
        "term", (F.col("freq") / F.col("_total")).alias("pw"))


def _p_topic_given_term(topic_term: DataFrame, prevalence: DataFrame) -> DataFrame:
    pt = F.broadcast(prevalence.select("topic", F.col("share").alias("pt")))
    j = topic_term.join(pt, "topic").withColumn("joint", F.col("p") * F.col("pt"))
    total = F.nullif(F.sum("joint").over(Window.partitionBy("term")), F.lit(0.0))
    return j.withColumn("ptw", F.coalesce(F.col("joint") / total, F.lit(0.0)))


def term_saliency(topic_term: DataFrame, prevalence: DataFrame, term_freq: DataFrame,
                  n: int | None = 30) -> DataFrame:
    """D3: ``(term, saliency, rank)``: p(w) * sum_t p(t|w) ln(p(t|w)/p(t)) (Chuang et al. 2012)."""
    ptw = _p_topic_given_term(topic_term, prevalence)
    distinct = ptw.groupBy("term").agg(
        F.sum(F.when(F.col("ptw") > 0, F.col("ptw") * F.log(F.col("ptw") / F.col("pt"))).otherwise(0.0))
        .alias("distinctiveness"))
    sal = distinct.join(_p_term(term_freq), "term").select(
        "term", (F.col("pw") * F.col("distinctiveness")).alias("saliency"))
    order = [F.col("saliency").desc(), F.col("term")]
    if not n:
        return sal
    # distributed top-n, then a rank over the n kept rows
    return sal.orderBy(*order).limit(n).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def term_relevance(topic_term: DataFrame, term_freq: DataFrame, lam: float = 0.6,
                   n: int | None = 30) -> DataFrame:
    """``(topic, term, relevance, rank)``: lam ln p(w|t) + (1-lam) ln(p(w|t)/p(w))
    (Sievert and Shirley 2014); top ``n`` per topic, or every term without ``rank`` (``n=None``)."""
    j = topic_term.filter(F.col("p") > 0).join(_p_term(term_freq), "term")
    rel = j.select("topic", "term",
                   (F.lit(lam) * F.log("p") + F.lit(1.0 - lam) * F.log(F.col("p") / F.col("pw")))
                   .alias("relevance"))
    return top_terms(rel, n, weight="relevance") if n else rel


def topic_distance(topic_term: DataFrame) -> DataFrame:
    """``(topic_a, topic_b, jsd)`` for ``topic_a < topic_b``: Jensen-Shannon divergence
    (natural log) between the two term distributions; a term missing from a topic has p=0."""
    topics = topic_term.select("topic").distinct()
    pairs = F.broadcast(topics.select(F.col("topic").alias("topic_a")).crossJoin(
        topics.select(F.col("topic").alias("topic_b"))).filter(F.col("topic_a") < F.col("topic_b")))
    # k*(k-1)/2 pairs: a tiny table, joined to the term rows of each side
    a = topic_term.join(pairs, topic_term["topic"] == pairs["topic_a"]).select(
        "topic_a", "topic_b", "term", F.col("p").alias("pa"))
    b = topic_term.join(pairs, topic_term["topic"] == pairs["topic_b"]).select(
        "topic_a", "topic_b", "term", F.col("p").alias("pb"))
    j = a.join(b, ["topic_a", "topic_b", "term"], "full").fillna(0.0, ["pa", "pb"])
    m = (F.col("pa") + F.col("pb")) / 2

    def kl(p):
        return F.when(F.col(p) > 0, F.col(p) * F.log(F.col(p) / m)).otherwise(0.0)

    return j.groupBy("topic_a", "topic_b").agg((0.5 * F.sum(kl("pa") + kl("pb"))).alias("jsd"))


def topic_map_2d(distance: DataFrame, prevalence: DataFrame) -> DataFrame:
    """``(topic, x, y, share)``: classical scaling of the k x k distance table.

    The input has k*(k-1)/2 rows (k = number of topics), so it is brought to the driver
    and decomposed with numpy; nothing document- or term-sized leaves the executors.
    """
    rows = distance.select("topic_a", "topic_b", "jsd").collect()
    prev = {r["topic"]: r["share"] for r in prevalence.select("topic", "share").collect()}
    topics = sorted(set(prev) | {r[0] for r in rows} | {r[1] for r in rows})
    ix = {t: i for i, t in enumerate(topics)}
    k = len(topics)
    d = np.zeros((k, k))
    for a, b, v in rows:
        d[ix[a], ix[b]] = d[ix[b], ix[a]] = v
    j = np.eye(k) - np.ones((k, k)) / k
    bmat = -0.5 * j @ (d ** 2) @ j
    vals, vecs = np.linalg.eigh(bmat)
    order = np.argsort(vals)[::-1][:2]
    coords = np.zeros((k, 2))
    for c, o in enumerate(order):
        v = vecs[:, o] * math.sqrt(max(vals[o], 0.0))
        if v[np.argmax(np.abs(v))] < 0:  # fixed sign: largest-magnitude coordinate positive
            v = -v
        coords[:, c] = v
    from pyspark.sql import types as T

    spark = distance.sparkSession
    schema = T.StructType([T.StructField("topic", distance.schema["topic_a"].dataType),
                           T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType()),
                           T.StructField("share", T.DoubleType())])
    data = [(t, float(coords[ix[t], 0]), float(coords[ix[t], 1]), float(prev.get(t, 0.0))) for t in topics]
    return spark.createDataFrame(data, schema)


WORD_BITS = 62  # ranks in one BIGINT of a mask


def _bits(words: np.ndarray, n: int) -> np.ndarray:
    """Rows of mask words as rows of ``n`` zeros and ones."""
    ranks = np.arange(n)
    return ((words[:, ranks // WORD_BITS] >> (ranks % WORD_BITS)) & 1).astype(np.float64)


def _pair_counts(masks: DataFrame, n_top: int) -> DataFrame:
    """``(topic, rank_j, rank_i, d)``: documents holding both ranks, for ``rank_i >= rank_j``.

    Each task multiplies the bit matrices of its distinct masks (weighted by their documents) into
    one n_top x n_top block per topic and sends its rows, which are summed by key.
    """
    kind = masks.schema["topic"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict = {}
        for batch in batches:
            topic = batch.column("topic").dictionary_encode()
            code = topic.indices.to_numpy(zero_copy_only=False)
            words = batch.column("mask").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            docs = batch.column("docs").to_numpy(zero_copy_only=False).astype(np.float64)
            for t, name in enumerate(topic.dictionary.to_pylist()):
                rows = np.flatnonzero(code == t)
                for lo in range(0, len(rows), 4096):
                    some = rows[lo:lo + 4096]
                    x = _bits(words[some], n_top)
                    blocks[name] = blocks.get(name, 0) + (x * docs[some, None]).T @ x
        for name, block in blocks.items():
            held = np.flatnonzero(block.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(held), arrow_kind), pa.array(held + 1, pa.int32()),
                 pa.array(block[held].tolist(), pa.list_(pa.float64()))], ["topic", "rank_j", "row"])

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_kind = to_arrow_type(kind)
    schema = StructType([StructField("topic", kind), StructField("rank_j", IntegerType()),
                         StructField("row", ArrayType(DoubleType()))])
    sums = masks.mapInArrow(run, schema).groupBy("topic", "rank_j").agg(
        vector_to_array(Summarizer.sum(array_to_vector("row"))).alias("row"))
    return sums.select("topic", "rank_j", F.posexplode("row").alias("i", "d")).select(
        "topic", "rank_j", (F.col("i") + 1).alias("rank_i"), F.col("d").cast("long").alias("d")).filter("rank_i >= rank_j")


def u_mass(doc_terms: DataFrame, top: DataFrame, n_docs: int | DataFrame, eps: float = 1e-12,
           smoothing: str = "eps", n_top: int | None = None) -> DataFrame:
    """``(topic, coherence)`` by u_mass over each topic's ranked top terms.

    ``doc_terms(doc_id, term)``: the terms present in each document, one row per pair.
    ``top(topic, term, rank)``: the ranked top terms (rank 1 = highest weight; ``n_top`` = the largest
    rank, when known).
    For pairs with rank_i > rank_j: ln((D(wi,wj)/N + eps) / (D(wj)/N)) (``smoothing="eps"``)
    or ln((D(wi,wj) + 1) / D(wj)) (``"plus_one"``, Mimno et al. 2011).  Mean over pairs.

    Plan: each (document, topic) becomes one bit mask of the top terms it holds, in as many words of
    ``WORD_BITS`` bits as ``n_top`` needs; masks are counted (partial aggregate, so common masks collapse
    before the shuffle), and pair counts come from products of the distinct masks' bit matrices.
    No self-join of documents, no row per pair and document.
    """
    top = top.select("topic", "term", "rank")
    # the caller usually knows how many top terms it kept; otherwise read it (a small job)
    t_max = n_top if n_top is not None else (top.agg(F.max("rank")).first()[0] or 0)
    words = max(1, -(-t_max // WORD_BITS))
    # k*T rows: bounded by the number of topics times the top-term count
    # doc_terms has one row per (document, term) (a bag of words); only rows of top terms
    # survive the broadcast join, so the shuffle below moves a small fraction of it
    present = doc_terms.select("doc_id", "term").join(F.broadcast(top), "term")
    place = F.col("rank").cast("int") - 1
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(WORD_BITS)))
    parts = [F.bit_or(F.when(F.floor(place / WORD_BITS) == w, bit).otherwise(F.lit(0).cast("long"))).alias(f"_w{w}")
             for w in range(words)]
    masks = (present.groupBy("doc_id", "topic").agg(*parts)
             .groupBy("topic", *[f"_w{w}" for w in range(words)]).agg(F.count(F.lit(1)).alias("docs"))
             .select("topic", F.array(*[f"_w{w}" for w in range(words)]).alias("mask"), "docs"))
    counted = _pair_counts(masks, max(1, t_max))
    occ = counted.filter("rank_i = rank_j").select("topic", "rank_j", F.col("d").alias("d_w"))
    co = counted.filter("rank_i > rank_j").select("topic", "rank_j", "rank_i", F.col("d").alias("d_ij"))
    pairs = (top.alias("i").join(top.alias("j"), (F.col("i.topic") == F.col("j.topic"))
                                 & (F.col("i.rank") > F.col("j.rank")))
             .select(F.col("i.topic").alias("topic"), F.col("i.rank").cast("int").alias("rank_i"),
                     F.col("j.rank").cast("int").alias("rank_j")))
    full = (pairs.join(co, ["topic", "rank_i", "rank_j"], "left").fillna(0, ["d_ij"])
            .join(occ, ["topic", "rank_j"], "left"))
    if isinstance(n_docs, DataFrame):
        full = full.crossJoin(F.broadcast(n_docs.select(F.col(n_docs.columns[0]).alias("_n"))))
        n = F.col("_n").cast("double")
    else:
        n = F.lit(float(n_docs))
    if smoothing == "eps":
        score = F.log((F.col("d_ij") / n + F.lit(eps)) / (F.col("d_w") / n))
    elif smoothing == "plus_one":
        score = F.log((F.col("d_ij") + 1.0) / F.col("d_w"))
    else:
        raise ValueError("smoothing must be 'eps' or 'plus_one'")
    return full.groupBy("topic").agg(F.avg(score).alias("coherence"))


def coherence_of_models(doc_terms: DataFrame, tops: DataFrame, n_docs: int | DataFrame, n_top: int | None = None,
                        **options) -> DataFrame:
    """``(model, coherence)``, the mean u_mass of every model's topics, in one pass over ``doc_terms``.

    ``tops(model, topic, term, rank)`` holds the ranked top terms of all models; each (model, topic) is a topic
    of its own in one :func:`u_mass` pass.
    """
    kind = tops.select("model", F.struct("model", "topic").alias("topic"), "term", "rank")
    key = F.to_json("topic")
    per = u_mass(doc_terms, kind.select(key.alias("topic"), "term", "rank"), n_docs, n_top=n_top, **options)
    names = kind.select(key.alias("topic"), "model").distinct()
    return per.join(names, "topic").groupBy("model").agg(F.avg("coherence").alias("coherence"))


def topic_report(top: DataFrame, doc_terms: DataFrame, n_docs: int | DataFrame, n: int = 40, coherence_terms: int = 20) -> DataFrame:
    """``(topic, terms, weights, coherence)`` from ranked top terms ``(topic, term, rank, weight)``."""
    coh = u_mass(doc_terms, top.filter(F.col("rank") <= coherence_terms), n_docs, n_top=coherence_terms)
    words = (top.filter(F.col("rank") <= n).groupBy("topic")
             .agg(F.array_sort(F.collect_list(F.struct("rank", "term", "weight"))).alias("terms")))
    return words.join(coh, "topic").select("topic", F.col("terms.term").alias("terms"),
                                           F.col("terms.weight").alias("weights"),
                                           F.round("coherence", 2).alias("coherence"))


def fold_in(counts: DataFrame, topic_term: DataFrame, topics: list, iterations: int = 20) -> DataFrame:
    """M9 from an exported model: ``(doc_id, topic, p)`` = p(t|d) by EM with p(w|t) held fixed.

    From equal shares, every iteration gives each topic its share of the document's known words,
    ``p(t|d) = sum_w tf(w) p(w|t) p(t|d) / sum_s p(w|s) p(s|d) / sum_w tf(w)``.  ``topics`` lists the model's
    topics (k entries).  A document without any known term has no rows.  The terms' k probabilities travel by
    key, never as a whole model.

    A (document, term) row moves as plain numbers without its word.  Rows are dealt by document and sorted, which
    fixes the order of the sums, so that a task reads one document after another and moves many at once.
    """
    by_term = topic_term.groupBy("term").pivot("topic", topics).agg(F.first("p"))
    k = len(topics)
    shares = [f"_p{i}" for i in range(k)]
    named = by_term.select("term", *[F.coalesce(F.col(f"`{t}`"), F.lit(0.0)).alias(c) for t, c in zip(topics, shares)])
    any_share = F.exists(F.array(*shares), lambda p: p > 0)
    words = counts.join(named.filter(any_share), "term").select(
        "doc_id", F.col("tf").cast("long").alias("tf"), *shares)
    docs = words.repartition("doc_id").sortWithinPartitions("doc_id", "tf", *shares)
    id_field = counts.schema["doc_id"]

    def steps(ids: pa.Array, first: np.ndarray, table: pa.Table) -> pa.RecordBatch:
        tf = table.column("tf").to_numpy().astype(np.float64)
        p = np.stack([table.column(c).to_numpy() for c in shares], axis=1)
        owner = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(tf))))
        total = np.add.reduceat(tf, first)
        theta = np.full((len(first), k), 1.0 / k)
        for _ in range(iterations):
            mix = p * theta[owner]
            theta = np.add.reduceat(tf[:, None] * mix / mix.sum(axis=1, keepdims=True), first, axis=0) / total[:, None]
        return pa.RecordBatch.from_arrays(
            [ids, pa.ListArray.from_arrays(pa.array(np.arange(len(first) + 1) * k, pa.int32()), pa.array(theta.ravel()))],
            ["doc_id", "s"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the rows of the last document seen, which may go on in the next batch
        for batch in batches:
            code = pc.fill_null(batch.column("doc_id").dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(code[1:] != code[:-1]) + 1
            if held and len(code) and held[0].column("doc_id")[0].as_py() != batch.column("doc_id")[0].as_py():
                cuts = np.concatenate(([0], cuts))
            if len(cuts):
                whole = pa.Table.from_batches([*held, batch.slice(0, cuts[-1])])
                first = np.concatenate(([0], sum(b.num_rows for b in held) + cuts[:-1]))
                yield steps(whole.column("doc_id").combine_chunks().take(pa.array(first)), first, whole)
                held = []
            rest = batch.slice(cuts[-1] if len(cuts) else 0)
            held += [rest] if rest.num_rows else []
        if held:
            whole = pa.Table.from_batches(held)
            yield steps(whole.column("doc_id").combine_chunks().slice(0, 1), np.array([0]), whole)

    found = docs.mapInArrow(run, StructType([id_field, StructField("s", ArrayType(DoubleType()))]))
    names = F.array(*[F.lit(t) for t in topics])
    return found.select("doc_id", F.posexplode("s").alias("i", "p")).select(
        "doc_id", F.element_at(names, F.col("i") + 1).alias("topic"), "p")


def mean_coherence(per_topic: DataFrame) -> DataFrame:
    """Model coherence: mean over topics."""
    return per_topic.agg(F.avg("coherence").alias("coherence"))
