import math

from pyspark.sql import functions as F

from topiclens.operators import vocabulary as VO


def corpus(spark):
    docs = [(1, ["pizza", "cold", "pizza", "the"]), (2, ["staff", "rude", "the"]), (3, ["cold", "staff", "the"]),
            (4, ["the"]), (5, [])]
    return spark.createDataFrame(docs, "doc_id long, tokens array<string>")


def test_term_counts_and_vocabulary(spark):
    toks = corpus(spark)
    counts = {(r.doc_id, r.term): r.tf for r in VO.term_counts(toks).collect()}
    assert counts[(1, "pizza")] == 2 and counts[(4, "the")] == 1
    vocab = {r.term: (r.df, r.cf) for r in VO.build_vocabulary(VO.term_counts(toks)).collect()}
    assert vocab["the"] == (4, 4) and vocab["pizza"] == (1, 2)


def test_filter_extremes_bounds_and_ids(spark):
    toks = corpus(spark)
    vocab = VO.build_vocabulary(VO.term_counts(toks))
    kept = VO.filter_extremes(vocab, 5, no_below=2, no_above=0.5, keep_n=10).orderBy("term_id").collect()
    # df bounds: 2 <= df <= int(0.5 * 5) = 2
    assert [(r.term, r.term_id) for r in kept] == [("cold", 0), ("staff", 1)]
    top1 = VO.filter_extremes(vocab, 5, keep_n=1).collect()
    assert [(r.term, r.term_id) for r in top1] == [("the", 0)]
    unbounded = VO.filter_extremes(vocab, 5, keep_n=None).orderBy("term_id").collect()
    assert [r.term_id for r in unbounded] == list(range(len(unbounded)))


def test_tfidf_nfc(spark):
    toks = corpus(spark)
    counts = VO.term_counts(toks)
    n = toks.count()
    vocab = VO.filter_extremes(VO.build_vocabulary(counts), n, keep_n=100)
    w = VO.tfidf(VO.bag_of_words(counts, vocab), vocab, n, drop_zero=False)
    terms = {r.term_id: r.term for r in vocab.collect()}
    got = {(r.doc_id, terms[r.term_id]): r.weight for r in w.collect()}
    # doc 1: pizza tf 2 df 1, cold tf 1 df 2, the tf 1 df 4
    raw = {"pizza": 2 * math.log2(5 / 1), "cold": math.log2(5 / 2), "the": math.log2(5 / 4)}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    for t, v in raw.items():
        assert abs(got[(1, t)] - v / norm) < 1e-12
    # row norms are 1
    norms = w.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("n")).collect()
    assert all(abs(r.n - 1) < 1e-12 for r in norms)


def test_term_in_every_document_has_zero_weight(spark):
    toks = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"]), (3, ["a", "c"])], "doc_id long, tokens array<string>")
    counts = VO.term_counts(toks)
    vocab = VO.filter_extremes(VO.build_vocabulary(counts), 3, keep_n=100)
    a_id = [r.term_id for r in vocab.collect() if r.term == "a"][0]
    kept = VO.tfidf(VO.bag_of_words(counts, vocab), vocab, 3)
    assert kept.filter(F.col("term_id") == a_id).count() == 0
    full = VO.tfidf(VO.bag_of_words(counts, vocab), vocab, 3, drop_zero=False)
    assert {r.weight for r in full.filter(F.col("term_id") == a_id).collect()} == {0.0}
    # doc 2 has only the zero-weight term: its weights stay 0, not NaN
    assert [r.weight for r in full.filter("doc_id = 2").collect()] == [0.0]


def test_smart_codes(spark):
    bow = spark.createDataFrame([(1, 0, 3), (1, 1, 1), (2, 0, 1)], "doc_id long, term_id int, tf long")
    df = spark.createDataFrame([(0, 2), (1, 1)], "term_id int, df long")
    w = {(r.doc_id, r.term_id): r.weight for r in VO.weight_matrix(bow, df, 2, "lfn", drop_zero=False).collect()}
    assert abs(w[(1, 1)] - 1.0) < 1e-12 and abs(w[(1, 0)]) < 1e-12
    w = {(r.doc_id, r.term_id): r.weight for r in VO.weight_matrix(bow, df, 2, "bnn").collect()}
    assert w == {(1, 0): 1.0, (1, 1): 1.0, (2, 0): 1.0}


def test_explode_and_collect_tokens_roundtrip(spark):
    toks = corpus(spark)
    back = VO.collect_tokens(VO.explode_tokens(toks))
    got = {r.doc_id: r.tokens for r in back.collect()}
    assert got[1] == ["pizza", "cold", "pizza", "the"]


def test_term_counts_need_no_sort_of_strings(spark):
    from collections import Counter

    docs = [(1, "x", ["b", "a", "b", "é", ""]), (None, "y", ["a"]), (1, "x", ["b"]), (2, None, []), (3, "z", None), (4, "z", ["zz"] * 300)]
    toks = spark.createDataFrame(docs, "doc_id long, lang string, tokens array<string>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        out = VO.term_counts(toks, keep=["lang"])
        assert "sort_array" not in out._jdf.queryExecution().optimizedPlan().toString()
        got = Counter(tuple(r) for r in out.collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert out.columns == ["doc_id", "lang", "term", "tf"] and out.schema["tf"].dataType.simpleString() == "bigint"
    assert got == Counter((d, lang, t, n) for d, lang, words in docs for t, n in Counter(words or []).items())
