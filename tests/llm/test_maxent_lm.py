import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from topiclens.llm import maxent_lm
from topiclens.llm.maxent_lm import (STRENGTHS, Shape, _run_sums, class_log_probabilities, classes_of, features_of, fit_and_score,
                                     inside_probability, learn_strength, previous_of, strength_of, tokens_of)

SMALL = Shape(rows=1 << 8, classes=8, batch=64, chunks=4)
END = object()


def tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*lowered.encode().split(), END]


def held_out(d):
    return d is not None and zlib.crc32(str(d).encode()) % 5 == 1


def brute(rows):
    counts = Counter(t for d, text in rows if not held_out(d) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, text in rows:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        out.append((d, held_out(d), len(own), sum(counts[t] > 0 for t in own), n, base))
    return out


def same(got, want):
    got = sorted((tuple(r[c] for c in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"))
                  for r in got), key=lambda r: (repr(r[:5]), r[5]))
    want = sorted(want, key=lambda r: (repr(r[:5]), r[5]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, block int")


def test_base_equals_brute_force(spark):
    rows = [(d, " ".join(f"W{(d * k) % 17}é" for k in range(d % 23))) for d in range(60)]
    rows += [(None, "null id Text"), (None, None), (100, ""), (101, None), (3, rows[3][1]), (3, rows[3][1]), (102, "x " * 30_000)]
    scored, model = fit_and_score(frame(spark, rows), SMALL, block_bytes=500)
    got = scored.collect()
    same(got, brute(rows))
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)
    assert model.tokens == model.class_tokens.sum() and model.types == model.class_types.sum()


def test_probabilities_add_up_to_one(spark):
    rows = [(d, f"a b c d{d % 7} a b") for d in range(50)]
    _, model = fit_and_score(frame(spark, rows), SMALL)
    features = np.array([[1, 2, 3], [5, 5, 200]])
    for f in features:
        logs = class_log_probabilities(model.weights, model.bias, np.repeat(f[None], SMALL.classes, axis=0),
                                       np.arange(SMALL.classes))
        assert abs(np.exp(logs).sum() - 1) < 1e-5
    rng = np.random.default_rng(3)
    strength = rng.uniform(0.5, 50, STRENGTHS)
    for cls in range(1, SMALL.classes):  # all words of a class, the unknown one included
        words = int(model.class_types[cls])
        counts = np.append(rng.multinomial(int(model.class_tokens[cls]), np.ones(max(words, 1)) / max(words, 1)), 0)
        q = (counts + 0.5) / (counts.sum() + 0.5 * len(counts))
        pairs = rng.integers(0, 4, len(counts))
        total = np.full(len(counts), pairs.sum())
        assert abs(inside_probability(pairs, total, q, strength).sum() - 1) < 1e-9


def test_scores_equal_the_model_worked_out_by_dictionaries(spark):
    rows = [(d, " ".join(f"w{(d * k * k) % 13}x{k % 3}" for k in range(d % 19))) for d in range(80)]
    rows += [(None, "w1x0 w2x1"), (None, None), (3, rows[3][1]), (200, "never seen words w1x0"), (201, "W1X0 W2X1 w1x0")]
    scored, model = fit_and_score(frame(spark, rows), SMALL, block_bytes=300)
    word, pair, history, facts = Counter(), Counter(), Counter(), []
    for d, text in rows:
        tok = tokens_of(pa.table({"text": pa.array([text], pa.string())}))
        cls, h = classes_of(tok, SMALL), previous_of(tok)
        log_class = class_log_probabilities(model.weights, model.bias, features_of(tok, SMALL.rows), cls) / np.log(10)
        facts.append((d, list(zip(tok.hash.tolist(), h.tolist(), cls.tolist(), log_class))))
        if not held_out(d):
            for w, g, c, _ in facts[-1][1]:
                word[w] += 1
                pair[g, w] += 1
                history[g, c] += 1
    want = []
    for d, tokens_ in facts:
        total = 0.0
        for w, g, c, log_class in tokens_:
            total += log_class
            if c:
                q = (word[w] + 0.5) / (model.class_tokens[c] + 0.5 * (model.class_types[c] + 1))
                m = float(strength_of(np.array([history[g, c]]), model.strength)[0])
                total += math.log10((pair[g, w] + m * q) / (history[g, c] + m))
        want.append((repr(d), total))
    got = sorted((repr(r["doc_id"]), r["score"]) for r in scored.collect())
    assert [g[0] for g in got] == [w[0] for w in sorted(want)]
    assert np.allclose([g[1] for g in got], [w[1] for w in sorted(want)], rtol=1e-6)


def test_run_sums():
    rng = np.random.default_rng(1)
    counts = np.array([1, 2, 15, 16, 17, 18, 300, 1])
    starts = np.cumsum(counts) - counts
    x = rng.normal(size=(counts.sum(), 5))
    assert np.allclose(_run_sums(x, starts, counts), np.add.reduceat(x, starts, axis=0))


def test_strengths_follow_the_evidence():
    def cells(k):
        n = 1000.0
        return pd.DataFrame({"level": [4, 4], "n": [n * k, n * (1 - k)], "pairs": [5 * n * k, 0.0],
                             "histories": [10 * n * k, 10 * n * (1 - k)], "shares": [0.01 * n * k, 0.01 * n * (1 - k)]})

    telling, empty = learn_strength(cells(0.9))[4], learn_strength(cells(0.01))[4]
    assert telling < 5 < 1000 < empty  # pairs that come back are trusted, pairs that do not are not

    def gain(m):
        return 0.9 * np.log((5 + m * 0.01) / (10 + m)) + 0.1 * np.log(m * 0.01 / (10 + m))

    assert gain(telling) > gain(telling * 1.2) and gain(telling) > gain(telling / 1.2)
    assert len(learn_strength(pd.DataFrame())) == STRENGTHS


def test_copies_of_training_texts_score_apart(spark):
    rng = np.random.default_rng(5)
    texts = {d: " ".join(f"t{x}" for x in rng.integers(0, 2000, 60)) for d in range(400)}
    trained = [d for d in texts if not held_out(d)]
    texts.update((2000 + d, texts[d]) for d in trained[-30:])  # copies inside the training part show that pairs tell
    spare = [d for d in range(1000, 1400) if held_out(d)][:20]
    rows = [*texts.items(), *((s, texts[t]) for s, t in zip(spare, trained))]
    out = fit_and_score(frame(spark, rows), SMALL)[0].toPandas()
    out["mean"] = out["score"] / out["n_tokens"]
    copies = out[out["doc_id"].isin(spare)]["mean"]
    others = out[out["held_out"] & (out["doc_id"] < 400)]["mean"]
    assert copies.min() > others.max()


def test_the_model_beats_the_base_on_held_out_documents(spark):
    from topiclens.llm.queries import op1_maxent_lm

    out = op1_maxent_lm(spark, "/root/testdata/sf0.01").toPandas()
    held = out[out["held_out"]]
    assert len(out) == 1000 and 100 < len(held) < 300
    assert held["score"].sum() / held["base_score"].sum() < 0.92
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    same(out.to_dict("records"), brute([tuple(r) for r in docs]))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(4, "only held out?")]])
def test_tiny_tables(spark, rows):
    got = fit_and_score(frame(spark, rows), SMALL)[0].collect()
    assert len(got) == len(rows) and all(math.isfinite(r["score"]) for r in got)
    same(got, brute(rows))


def test_strengths_are_learned_from_every_block(spark, monkeypatch):
    import topiclens.llm.maxent_lm as lm

    rows = [(i, f"a{i % 7} b{i % 5} a{i % 7} b{i % 5} c{i % 3}") for i in range(400)]
    learned = []
    monkeypatch.setattr(lm, "learn_strength", lambda cells: learned.append(cells["n"].sum()) or learn_strength(cells))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert lm.text_bytes(docs) > 16 * 200
    for block_bytes in (1 << 20, 200):  # one block, and more than 16
        fit_and_score(docs, SMALL, block_bytes)
    assert learned[0] == learned[1] > 0


def test_steps_and_counts_are_sent_in_few_bytes():
    rng = np.random.default_rng(3)
    steps = np.diff(np.sort(rng.integers(0, 1 << 44, 50_000, dtype=np.uint64)))  # the largest needs four bytes
    assert steps.max() >= 1 << 24
    counts = np.minimum(rng.geometric(0.7, 50_000), 1 << 17)
    counts[7] = 70_000
    for x, bits in ((steps, 31), (counts, 4)):
        sent = maxent_lm._packed(x)
        assert (maxent_lm._unpacked(sent, len(x)) == x).all() and 8 * len(sent) < bits * len(x)
    for x in ([], [0], [255, 256], [(1 << 64) - 1, 5], [1 << 40] * 3):
        x = np.array(x, dtype=np.uint64)
        assert maxent_lm._unpacked(maxent_lm._packed(x), len(x)).tolist() == x.tolist()
