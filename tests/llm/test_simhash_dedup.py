import os
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from topiclens.llm.components import connected_components
from topiclens.llm.simhash_dedup import keep_first, links, simhash_dedup
from topiclens.session import ensure_checkpoint_dir


def union_find(nodes, pairs):
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in nodes}


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    sh = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near(fps, bits=2):
    fps = sorted(fps)
    x = np.array(fps, dtype=np.uint64)
    out = []
    for i in range(len(x)):
        d = np.bitwise_count(x[i] ^ x[i + 1:])
        out += [(fps[i], fps[i + 1 + j]) for j in np.flatnonzero(d <= bits)]
    return out


def expected(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    comp = union_find(set(fps), near(set(fps)))
    least = {}
    for (d, _), f in zip(rows, fps):
        if d is not None:
            least[comp[f]] = min(least.get(comp[f], d), d)
    return sorted(((d, f"{f:016x}", least.get(comp[f])) for (d, _), f in zip(rows, fps)), key=repr)


def corpus():
    rng = random.Random(5)
    words = [f"Wört{i}" for i in range(60)] + ["A", "bb"]
    rows = [(d, " ".join(rng.choice(words) for _ in range(rng.randint(0, 80)))) for d in range(60)]
    for d in range(60, 120):
        w = rows[d % 20][1].split()
        if w and d % 2:
            w[rng.randrange(len(w))] = "zz"
        rows.append((d, "\n".join(w)))
    return rows + [(200, None), (201, ""), (202, "  \n"), (None, "a b c d e"), (None, "only null ids here now"),
                   (7, rows[7][1]), (7, rows[3][1]), (203, "a b"), (204, "A  b"), (205, "x " * 100_000)]


def test_equals_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, fp int, component int")
    got = [tuple(r) for r in simhash_dedup(df).select("doc_id", "fingerprint", "component_id").collect()]
    assert sorted(got, key=repr) == expected(rows)


@pytest.mark.parametrize("group_limit", [32, 3])
@pytest.mark.parametrize("bits", [1, 2])
def test_links_join_all_near_pairs(spark, group_limit, bits):
    rng = random.Random(bits)
    fps = {rng.getrandbits(64) for _ in range(300)} | {0, (1 << 64) - 1}
    for f in list(fps)[:60]:
        for _ in range(12):
            f ^= 1 << rng.randrange(64)
            fps.add(f)
    centre = rng.getrandbits(64)
    fps |= {centre ^ (1 << i) for i in range(64)} | {centre ^ (1 << i) ^ (1 << j) for i in range(6) for j in range(6)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    found = links(spark.createDataFrame([(f,) for f in signed], "fp long"), bits, group_limit=group_limit).collect()
    pairs = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in found]
    assert all(bin(a ^ b).count("1") <= bits for a, b in pairs)
    assert union_find(fps, pairs) == union_find(fps, near(fps, bits))


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(100)] + [(500, 400), (400, 450), (7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in
           connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(101)} | {400: 400, 450: 400, 500: 400}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_keep_first_keeps_one_row_per_component(spark):
    rows = corpus()
    df = spark.createDataFrame([(t, d, i) for i, (d, t) in enumerate(rows)], "text string, doc_id long, fp int")
    got = keep_first(df)
    assert got.columns == df.columns
    comp = {(d, t): (c, f) for (d, t), (f, c) in
            zip(rows, [(plain_fingerprint(t), None) for _, t in rows])}
    assert len(comp) <= len(rows)
    nodes = {plain_fingerprint(t) for _, t in rows}
    roots = union_find(nodes, near(nodes))
    kept = [(r["doc_id"], plain_fingerprint(r["text"])) for r in got.collect()]
    assert len(kept) == len(set(roots.values())) == len({roots[f] for _, f in kept})
    for d, f in kept:
        ids = [x for x, t in rows if roots[plain_fingerprint(t)] == roots[f] and x is not None]
        assert d == (min(ids) if ids else None)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash_dedup(df).collect() == [] and keep_first(df).collect() == []
    assert simhash_dedup(df.select("doc_id", F.col("text"))).columns[0] == "doc_id"


def test_steps_that_nothing_reads_again_are_removed(spark):
    folder = ensure_checkpoint_dir(spark).removeprefix("file:") + "/tables"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    out = keep_first(spark.createDataFrame([(d, t) for d, t in corpus()], "doc_id long, text string"))
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before}
    assert left == {"simhash_rows", "components"}
    assert out.count() > 0
