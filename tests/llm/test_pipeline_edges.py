"""Each pipeline stage, and all of them in a row, on null, repeated, empty, very long and clashing rows."""
import random
import time

import pytest

import corpus_pipeline
from topiclens.llm.source_mixing import mixed_documents

rng = random.Random(3)
WORDS = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(2000)]


def sentence(n=12):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def long_text(lines):
    return "\n".join(sentence(20) for _ in range(lines))


def table(spark, lines=3000):
    rows = [(i, "\n".join(sentence() for _ in range(6)), "en", f"s{i % 3}") for i in range(40)]
    rows += [(None, rows[0][1], "en", "s0"), (3, rows[3][1], "en", "s0"), (3, rows[3][1], "en", "s0"), (41, None, "en", "s1"), (42, "", None, "s1"),
             (43, " \n\t", "en", None), (44, rows[7][1], None, None), (45, long_text(lines), "en", "s2"), (46, "x" * 100_000, "en", "s2")]
    clash = [(t, d, lang, len(t or ""), source, 1, "k", 7, "p", 0, None, "w") for d, t, lang, source in rows]
    return spark.createDataFrame(clash, "text string, doc_id long, lang string, n_chars long, source string, size int, row string, k int, "
                                        "pos string, words int, runs string, n_removed string")


def all_stages(spark, docs):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, ""), f"edge_{name}")
        out.append(docs)
    return out


def test_edge_rows_go_through_every_stage(spark):
    docs = table(spark)
    began = time.time()
    stages = all_stages(spark, docs)
    assert time.time() - began < 120
    for kept in stages[:-1]:
        assert kept.columns == docs.columns and kept.dtypes == docs.dtypes and kept.count() > 0
    ids = [{r["doc_id"] for r in s.select("doc_id").distinct().collect()} for s in stages]
    assert {41, 42, 43, 46}.isdisjoint(ids[0]) and 45 in ids[0]
    assert all(later <= earlier for earlier, later in zip(ids[:3], ids[1:4]))
    pieces = stages[-1].collect()
    assert pieces and all(0 < r["length"] <= 4096 for r in pieces)


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_empty_table_at_every_stage(spark, k):
    empty = table(spark, 1).limit(0)
    assert corpus_pipeline.STAGES[k][1](spark, empty, "").collect() == []


def test_mixture_grows_with_a_texts_length(spark):
    def seconds(lines):
        rows = [(i, sentence(30), "a" if i % 2 else "b") for i in range(60)] + [(99, long_text(lines), "a")]
        docs = corpus_pipeline.materialize(spark.createDataFrame(rows, "doc_id long, text string, source string"), "long")
        began = time.time()
        out = mixed_documents(docs)
        out.write.format("noop").mode("overwrite").save()
        return time.time() - began

    seconds(200)
    few, many = seconds(4000), seconds(16_000)
    assert many < 4 * 2.2 / 2 * max(few, 2.0)
