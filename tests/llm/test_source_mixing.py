import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from topiclens.llm import source_mixing
from topiclens.llm.source_mixing import mix_sources, mixed_documents, permuted, source_targets


def targets(sizes, weights=(5, 2, 1), cap=3):
    """Share by weight, stop at the cap, share the excess again until none is above."""
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = sum(sizes.values())
    stopped = {}
    while True:
        free = [s for s in names if s not in stopped]
        if not free:
            return stopped
        share = (total - sum(stopped.values())) / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * share > cap * sizes[s] + 1e-9]
        if not over:
            return stopped | {s: weight[s] * share for s in free}
        stopped |= {s: cap * sizes[s] for s in over}


def corpus(seed=1, docs=400):
    rng = random.Random(seed)
    rows = []
    for d in range(docs):
        source = rng.choice(["hot"] * 8 + ["b", "ä", "z", "tiny", None])
        n = rng.randint(0, 6) if source == "tiny" else rng.randint(0, 400)
        rows.append((d, " ".join(f"w{rng.randrange(99)}" for _ in range(n)), source))
    return rows + [(None, "no id here", "b"), (None, None, "b"), (7, rows[7][1], rows[7][2]), (7, rows[7][1], rows[7][2]),
                   (901, "x " * 50_000, "z"), (902, "", "empty"), (903, None, "empty")]


def frame(spark, rows):
    return spark.createDataFrame([(t, d, s, 1, 2) for d, t, s in rows], "text string, doc_id long, source string, pos int, n_chars long")


def test_targets_equal_iteration(spark):
    rng = random.Random(3)
    for _ in range(3):
        sizes = {f"s{i}": rng.choice([0, 3, 50, 1000, 20_000]) for i in range(rng.randint(1, 9))} | {None: 70}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in source_targets(df).collect()}
        want = targets(sizes)
        assert all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in sizes)


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 7, 64, 1000):
        df = permuted(spark.range(n).withColumnRenamed("id", "x"), "x", F.lit(n).cast("long"), [F.lit(5)], "y")
        got = [r["y"] for r in df.orderBy("x").collect()]
        assert sorted(got) == list(range(n))
    assert got != list(range(n))


def test_mix_meets_targets_and_caps(spark):
    rows = corpus()
    got = mix_sources(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want_size = Counter()
    for d, t, s in rows:
        want_size[s] += len((t or "").encode().split())
    want = targets(dict(want_size))
    by_id = {d: (len((t or "").encode().split()), s) for d, t, s in rows if d is not None}
    taken = defaultdict(int)
    for r in got:
        assert r["taken"] <= 3 * r["size"]
        if r["doc_id"] is not None:
            size, source = by_id[r["doc_id"]]
            assert r["size"] == size and r["source_size"] == want_size[source]
            assert abs(r["target"] - want[source]) < 1e-6 * max(1, want[source])
            taken[source] += r["taken"]
        else:
            taken["b"] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.02 * t + 200, (s, taken[s], t)


def test_reruns_and_partitionings_agree(spark):
    df = frame(spark, corpus(2, 150))
    assert sorted(map(tuple, mix_sources(df).collect()), key=repr) == \
        sorted(map(tuple, mix_sources(df.repartition(7)).collect()), key=repr)


def test_mixed_documents_hold_the_taken_words(spark):
    rows = [(d, t, s) for d, t, s in corpus(4, 200) if d is not None and d != 7]
    df = frame(spark, rows)
    taken = {r["doc_id"]: r["taken"] for r in mix_sources(df).collect()}
    mixed = mixed_documents(df)
    assert mixed.columns == df.columns
    texts = {d: (t or "").split() for d, t, _ in rows}
    words = Counter()
    for r in mixed.collect():
        own = r["text"].split()
        words[r["doc_id"]] += len(own)
        assert not Counter(own) - Counter(texts[r["doc_id"]]) and r["n_chars"] == len(r["text"])
    assert {d: n for d, n in taken.items() if n} == dict(words)


def test_empty_and_wordless_tables(spark):
    assert mix_sources(frame(spark, [])).collect() == [] and mixed_documents(frame(spark, [])).collect() == []
    got = mix_sources(frame(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert [(r["size"], r["taken"], r["target"]) for r in got] == [(0, 0, 0.0)] * 2


def test_many_sources_are_ranked_in_more_than_one_task(spark):
    n = 30_000
    df = spark.range(n).selectExpr("concat('s', id) AS source", "(id * 7919) % 1000 AS source_size")
    rows = source_targets(df).select("source", "source_size", "sid", "base", "target").collect()
    sizes = {r["source"]: r["source_size"] for r in rows}
    names = sorted(sizes)
    by_name = {r["source"]: r for r in rows}
    assert [by_name[s]["sid"] for s in names] == list(range(n))
    total = 0
    for s in names:
        assert by_name[s]["base"] == total
        total += sizes[s]
    assert abs(sum(r["target"] for r in rows) - total) < 1e-3
    assert all(r["target"] <= 3 * r["source_size"] + 1e-9 for r in rows)
    free = {round(r["target"] / (5, 2, 1)[r["sid"] % 3], 6) for r in rows if r["target"] < 3 * r["source_size"] - 1e-6}
    assert len(free) <= 1  # all that are not stopped stand at one level


def test_the_mix_writes_no_texts(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "a b c d " * (i % 5 + 1), "s" if i % 3 else None, i) for i in range(60)] + [(7, "a b", "s", 1)] * 2,
                                 "doc_id long, text string, source string, extra long")
    written, write = [], source_mixing.materialize

    def spied(df, name="table"):
        written.append((name, set(df.columns)))
        return write(df, name)

    monkeypatch.setattr(source_mixing, "materialize", spied)
    mixed = source_mixing.mixed_documents(docs).collect()
    assert mixed and {"mix_sizes", "mix_placed"} <= {n for n, _ in written}
    assert not any({"row", "text"} & columns for _, columns in written)
