import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from topiclens.llm import impact_search
from topiclens.llm.impact_search import ImpactLists, Weights, best_positions, ranked_search
from topiclens.llm.oracle import SQL

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(items, docs, k=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, bag in bags:
            m = 25 + (75 * sum(bag.values()) * n_docs) // length
            s = sum(c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m)) for t, c in Counter(terms(text)).items() if t in bag)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frames(spark, items, docs):
    return (spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int"),
            spark.createDataFrame([(i, t, "x", 9) for i, t in docs], "doc_id long, text string, rank string, score int"))


DOCS = [(1, "a b c d"), (2, "A b"), (2, "A b"), (3, None), (4, ""), (5, "... --"), (None, "a b"), (6, "rare Wört 中文 b"),
        (7, "b " * 5000 + "needle"), (8, "needle a-b c_d"), (9, "a b"), (10, "É é b")]
ITEMS = [(1, "a b needle"), (2, None), (3, ""), (4, "!!"), (5, "absent"), (1, "c c c d"), (None, "wÖrt WöRT 中文"), (6, "a b needle"), (6, "a b needle"), (7, "é")]


def test_equals_brute_force_on_edge_rows(spark):
    items, docs = frames(spark, ITEMS, DOCS)
    for k in (1, 3, 10):
        assert rows(ranked_search(items, docs, k)) == brute(ITEMS, DOCS, k)


@pytest.mark.parametrize("slice_bytes, item_bytes", [(200, 40), (3000, 4 << 20)])
def test_equals_brute_force_over_slices_and_item_blocks(spark, monkeypatch, slice_bytes, item_bytes):
    monkeypatch.setattr(impact_search, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(impact_search, "ITEM_BYTES", item_bytes)
    rng = np.random.default_rng(5)
    word = lambda: f"w{int(rng.zipf(1.4)) % 400}"
    docs = [(i, " ".join(word() for _ in range(int(rng.integers(1, 60))))) for i in range(600)]
    docs += [(1000 + i, docs[3][1]) for i in range(30)]  # ties
    items = [(i, " ".join(word() for _ in range(12))) for i in range(8)]
    assert rows(ranked_search(*frames(spark, items, docs), 7)) == brute(items, docs, 7)


def test_reading_stops_before_all_documents_are_met():
    rng = np.random.default_rng(1)
    n_docs, n_terms = 20_000, 3
    owner = np.repeat(np.arange(n_docs), n_terms)
    hashes = np.tile(np.arange(n_terms, dtype=np.uint64), n_docs)
    lengths = rng.integers(3, 3000, n_docs)
    items = impact_search.Items([0], np.arange(n_terms, dtype=np.uint64), [])
    weights = Weights(n_docs, int(lengths.sum()), np.array([500, 700, 900]))
    lists = ImpactLists.of(hashes, owner, lengths, items, weights)
    found, scores, met = best_positions(lists, np.arange(3), np.ones(3, int), 10, np.zeros(0, int))
    everything = np.zeros(n_docs, int)
    np.add.at(everything, lists.docs, lists.impact)
    want = np.lexsort((np.arange(n_docs), -everything))[:10]
    assert sorted(found) == sorted(want) and sorted(scores) == sorted(everything[want])
    assert met < n_docs / 10


def test_sql_agrees(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as from '/root/testdata/sf0.001/{t}.parquet'")
    want = sorted(con.sql(SQL["op11_ranked_search"]).fetchall())
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet")
    assert sorted(tuple(r) for r in ranked_search(read("benchmark"), read("documents")).collect()) == want


def test_empty_tables(spark):
    assert rows(ranked_search(*frames(spark, [], DOCS))) == []
    assert rows(ranked_search(*frames(spark, ITEMS, []))) == []
