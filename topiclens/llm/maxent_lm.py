"""A hashed maximum-entropy language model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class, history).  A word's class is a hash of its
last two bytes; the end of a text is a class of its own.

*Class.*  A softmax over ``classes`` whose logits sum rows of a hashed weight table, one row per
feature of the history: the previous word, the two previous words together, and the word before the
previous one (a skip feature).  In each round every task starts from the round's weights, walks its
documents in minibatches with AdaGrad gradient steps, and sends its rows, weighted by how often each
was used; the rows are averaged by key and become the next round's weights.  Each training token is
used once over all rounds.  This table has a fixed size (``rows`` x ``classes``).

*Word in its class.*  A log-linear model with one feature per pair of previous word h and word w:
P(w | c, h) = q(w) exp(f(h, w)) / Z(h, c), where q is the smoothed share of w in its class and
f(h, w) = log(1 + n(h, w) / (m q(w))), so that Z(h, c) = 1 + n(h, c) / m and the words of a class add up to
one.  n counts training tokens.  The strength m depends on n(h, c) (one value per power of two) and is
learned by gradient ascent on the leave-one-out likelihood of all training tokens, which are added
up by powers of two.  Pairs are hashed to a table of 2^bits places; bits follow the bytes of the
corpus, so this table grows with the input at one rate of collisions.

Counts cover all training documents.  Each block sends its distinct words, pairs and (history, class)
keys as sorted arrays, cut by hash range; a task per range adds them up and answers each block in the
order of its keys.  No vocabulary is broadcast or collected; a frequent word or pair is one key per block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .arrow_text import mix64, slices, span_hashes, texts_of, words_of
from .blocks import BLOCK_BYTES, dealt, text_bytes

FOLDS, HELD_OUT = 5, 1
_U = np.uint64
_END = _U(0xE4D0_0000_0000_0001)
_BEGIN = _U(0xB390_0000_0000_0001)
WORD, PAIR, HISTORY = 0, 1, 2  # kinds of counted keys
BLOCKS_PER_RANGE = 8
STRENGTHS = 64  # one per power of two of n(h, c)


@dataclass(frozen=True)
class Shape:
    """Sizes and rates of the class softmax."""

    rows: int = 1 << 14
    classes: int = 64
    rounds: int = 2
    batch: int = 4096
    rate: float = 0.35
    chunks: int = 64


@dataclass
class Model:
    shape: Shape
    weights: np.ndarray  # rows x classes, float32
    bias: np.ndarray  # log share of each class
    tokens: int  # N
    types: int  # V
    class_tokens: np.ndarray
    class_types: np.ndarray
    bits: int  # places of the table of pairs, as a power of two
    strength: np.ndarray


def is_held_out(doc_id) -> bool:
    """crc32 of the id as text, modulo 5, is 1; a null id belongs to the training part."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


@dataclass
class Tokens:
    hash: np.ndarray  # words of each text (A-Z folded), then its end
    tail: np.ndarray  # a small hash of the last two bytes
    doc: np.ndarray
    first: np.ndarray  # token range per text
    place: np.ndarray  # position inside the text


def tokens_of(batch) -> Tokens:
    t = texts_of(batch.column("text"))
    words = words_of(t)
    h = span_hashes(t, words, lower=True)
    n = len(t)
    own = words.owner
    at = np.arange(len(h)) + own
    hashes = np.full(len(h) + n, _END, dtype=np.uint64)
    hashes[at] = h
    tails = np.zeros(len(h) + n, dtype=np.uint64)
    last = t.buf[words.end - 1].astype(np.uint64)
    before = np.where(words.end - words.start > 1, t.buf[np.maximum(words.end - 2, 0)], 0).astype(np.uint64)
    fold = [x + _U(32) * ((x >= 65) & (x <= 90)).astype(np.uint64) for x in (last, before)]
    tails[at] = mix64(fold[0] * _U(256) + fold[1]) >> _U(40)
    first = words.first + np.arange(n + 1)
    doc = np.repeat(np.arange(n), np.diff(first))
    return Tokens(hashes, tails, doc, first, np.arange(len(hashes)) - first[doc])


def classes_of(tok: Tokens, shape: Shape) -> np.ndarray:
    """0 for the end of a text, else 1 to ``classes`` - 1 by the word's last two bytes."""
    out = (_U(1) + tok.tail % _U(shape.classes - 1)).astype(np.int64)
    out[tok.hash == _END] = 0
    return out


def previous_of(tok: Tokens) -> np.ndarray:
    one = np.concatenate((np.array([_BEGIN]), tok.hash[:-1])) if len(tok.hash) else tok.hash
    return np.where(tok.place < 1, _BEGIN, one)


def keys_of(tok: Tokens, cls: np.ndarray, bits: int) -> dict[int, np.ndarray]:
    """Each token's word, pair and (history, class) key; an end token has a word key only (the others are 0)."""
    h = previous_of(tok)
    cut = _U(64 - bits)
    pair = mix64(mix64(h) * _U(3) + tok.hash) >> cut
    history = mix64(mix64(h ^ _U(0x7777)) * _U(5) + cls.astype(np.uint64)) >> cut
    pair[cls == 0] = history[cls == 0] = 0
    return {WORD: tok.hash, PAIR: pair, HISTORY: history}


def features_of(tok: Tokens, rows: int) -> np.ndarray:
    """Three rows of the weight table per token: bigram, trigram and skip feature of its history."""
    one = previous_of(tok)
    two = np.concatenate((np.array([_BEGIN, _BEGIN]), tok.hash[:-2]))[:len(tok.hash)]
    two = np.where(tok.place < 2, _BEGIN, two)
    keys = (mix64(one ^ _U(0x1111)), mix64(one * _U(3) + two * _U(0x9E3779B97F4A7C15)), mix64(two ^ _U(0x5555)))
    return np.stack([(k >> _U(20)) % _U(rows) for k in keys], axis=1).astype(np.int64)


def _logits(weights, bias, features) -> np.ndarray:
    z = weights.take(features[:, 0], axis=0)
    z += weights.take(features[:, 1], axis=0)
    z += weights.take(features[:, 2], axis=0)
    z += bias
    z -= z.max(axis=1, keepdims=True)
    return z


def class_log_probabilities(weights, bias, features, classes) -> np.ndarray:
    """log P(class | history) of each token, in float32 batches."""
    out = np.empty(len(classes), dtype=np.float64)
    for a in range(0, len(classes), 4096):
        f = features[a:a + 4096]
        z = _logits(weights, bias, f)
        own = z[np.arange(len(f)), classes[a:a + 4096]]
        out[a:a + 4096] = own - np.log(np.exp(z, out=z).sum(axis=1))
    return out


def _run_sums(x: np.ndarray, starts: np.ndarray, counts: np.ndarray, step: int = 16) -> np.ndarray:
    """Sums of runs of rows: the first ``step`` rows of all runs together, the rest of a long run at once."""
    total = x.take(starts, axis=0)
    for r in range(1, step):
        more = np.flatnonzero(counts > r)
        if not len(more):
            return total
        total[more] += x.take(starts[more] + r, axis=0)
    for i in np.flatnonzero(counts > step):
        total[i] += x[starts[i] + step:starts[i] + counts[i]].sum(axis=0)
    return total


def gradient_steps(weights, squares, used, bias, features, classes, shape: Shape) -> None:
    """AdaGrad steps over the tokens in order, in place."""
    for a in range(0, len(classes), shape.batch):
        f, c = features[a:a + shape.batch], classes[a:a + shape.batch]
        z = _logits(weights, bias, f)
        np.exp(z, out=z)
        z /= -z.sum(axis=1, keepdims=True)
        z[np.arange(len(c)), c] += 1  # the gradient of the log likelihood for each logit
        flat = f.T.ravel().astype(np.uint16 if shape.rows <= 1 << 16 else np.int64)  # short keys sort by radix
        order = np.argsort(flat, kind="stable")
        row = flat[order]
        starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        row = row[starts].astype(np.int64)
        hits = np.diff(np.append(starts, len(flat)))
        total = _run_sums(z.take(order % len(c), axis=0), starts, hits)
        squares[row] += np.einsum("ij,ij->i", total, total) / shape.classes
        weights[row] += (shape.rate / np.sqrt(squares[row]))[:, None].astype(np.float32) * total
        used[row] += hits


def _train(model: Model, turn: int):
    shape = model.shape

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.weights.copy()
        squares = np.full(shape.rows, 1.0, dtype=np.float64)
        used = np.zeros(shape.rows, dtype=np.float64)
        for whole in batches:
            ids = whole.column("doc_id").to_pylist()
            mine = [i for i, d in enumerate(ids) if not is_held_out(d)
                    and zlib.crc32(str(d).encode()) // FOLDS % shape.rounds == turn]
            for batch in slices(whole.take(pa.array(mine, pa.int64())), "text", 1 << 20):
                tok = tokens_of(batch)
                gradient_steps(weights, squares, used, model.bias, features_of(tok, shape.rows),
                               classes_of(tok, shape), shape)
        if not used.any():
            return
        w, u = np.split(weights, shape.chunks), np.split(used, shape.chunks)
        yield pa.RecordBatch.from_pydict({
            "chunk": np.arange(shape.chunks, dtype=np.int32),
            "weights": pa.array([x.astype("<f2").tobytes() for x in w], pa.binary()),
            "used": pa.array([x.astype("<f8").tobytes() for x in u], pa.binary())})

    return train


def _average(shape: Shape):
    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[np.ndarray]] = {}  # at most the table's own size
        for batch in batches:
            for chunk, w, u in zip(*(batch.column(c).to_pylist() for c in ("chunk", "weights", "used"))):
                w = np.frombuffer(w, "<f2").astype(np.float64).reshape(-1, shape.classes)
                u = np.frombuffer(u, "<f8")
                if chunk not in sums:
                    sums[chunk] = [np.zeros_like(w), np.zeros_like(u)]
                sums[chunk][0] += w * u[:, None]
                sums[chunk][1] += u
        for chunk, (w, u) in sums.items():
            mean = w / np.maximum(u, 1e-300)[:, None]
            yield pa.RecordBatch.from_pydict({
                "chunk": np.array([chunk], dtype=np.int32),
                "weights": pa.array([mean.astype("<f4").tobytes()], pa.binary()),
                "used": pa.array([u.astype("<f8").tobytes()], pa.binary())})

    return average


def train_weights(docs: DataFrame, model: Model) -> None:
    """Run all rounds; ``model.weights`` ends as the trained table."""
    shape, schema = model.shape, "chunk int, weights binary, used binary"
    for turn in range(shape.rounds):
        sent = docs.select("doc_id", "text").mapInArrow(_train(model, turn), schema)
        chunks = sent.repartition(shape.chunks, "chunk").mapInArrow(_average(shape), schema).collect()
        new = np.split(model.weights.copy(), shape.chunks)
        for r in chunks:
            mean = np.frombuffer(r["weights"], "<f4").reshape(-1, shape.classes)
            seen = np.frombuffer(r["used"], "<f8") > 0
            new[r["chunk"]][seen] = mean[seen]
        model.weights = np.concatenate(new).astype(np.float32)


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers as planes of their bytes, compressed: the high bytes of steps and counts are alike."""
    most = int(x.max()) if len(x) else 0
    width = max(1, -(-most.bit_length() // 8))
    planes = x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return bytes([width]) + pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(b: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    width = b[0]
    planes = pa.decompress(b[1:], decompressed_size=n * width, codec="zstd", asbytes=True)
    out = np.zeros((n, next(w for w in (1, 2, 4, 8) if w >= width)), dtype=np.uint8)
    out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return out.view(f"<u{out.shape[1]}").ravel()


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


@dataclass
class Block:
    """The tokens of a block, slice by slice, and its distinct keys of each kind, sorted."""

    slices: list  # (ids, held out, tokens, classes, keys by kind)
    keys: dict[int, np.ndarray]


def _block_of(table: pa.Table, shape: Shape, bits: int) -> Block:
    parts = []
    for batch in slices(table, "text"):
        tok = tokens_of(batch)
        ids = batch.column("doc_id").to_pylist()
        cls = classes_of(tok, shape)
        parts.append((ids, np.array([is_held_out(d) for d in ids], dtype=bool), tok, cls, keys_of(tok, cls, bits)))
    keys = {k: _distinct(np.concatenate([_distinct(p[4][k]) for p in parts])) for k in (WORD, PAIR, HISTORY)}
    return Block(parts, keys)


def _range_of(keys: np.ndarray, kind: int, bits: int, ranges: int) -> np.ndarray:
    top = keys >> _U((64 if kind == WORD else bits) - 32)
    return ((top * _U(ranges)) >> _U(32)).astype(np.int64)


SENT = "kind int, part int, block int, n int, first long, steps binary, counts binary, classes binary"


def _send(shape: Shape, bits: int, ranges: int):
    """A block's distinct keys with their training counts: a row per kind and hash range."""

    def send(key: tuple, table: pa.Table) -> pa.Table:
        block = _block_of(table, shape, bits)
        out = {c.split()[0]: [] for c in SENT.split(", ")}
        for kind, keys in block.keys.items():
            seen = np.sort(np.concatenate([p[4][kind][~p[1][p[2].doc]] for p in block.slices]))
            counts = np.searchsorted(seen, keys, "right") - np.searchsorted(seen, keys, "left")
            classes = np.zeros(len(keys), dtype=np.uint8 if shape.classes <= 256 else np.uint16)
            if kind == WORD:
                for p in block.slices:
                    classes[np.searchsorted(keys, p[4][WORD])] = p[3]
            part = _range_of(keys, kind, bits, ranges)
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(keys)])) if len(keys) else [0]
            for a, b in zip(cuts[:-1], cuts[1:]):
                out["kind"].append(kind)
                out["part"].append(int(part[a]))
                out["block"].append(key[0].as_py())
                out["n"].append(int(b - a))
                out["first"].append(int(keys[a:a + 1].view(np.int64)[0]))
                out["steps"].append(_packed(np.diff(keys[a:b])))
                out["counts"].append(_packed(counts[a:b]))
                out["classes"].append(classes[a:b].tobytes() if kind == WORD else b"")
        types = {"kind": pa.int32(), "part": pa.int32(), "block": pa.int32(), "n": pa.int32(), "first": pa.int64()}
        return pa.table({c: pa.array(v, types.get(c, pa.binary())) for c, v in out.items()})

    return send


ANSWER = "kind int, part int, block int, n int, totals binary, class int, tokens long, types long"


def _answer(shape: Shape):
    """Adds up one hash range of one kind and answers each block in the order of its keys.

    A range of words also gives a row per class (block -1) with its tokens and different words.
    """

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        kind, part = key[0].as_py(), key[1].as_py()
        rows = table.select(["block", "n", "first", "steps", "counts", "classes"]).to_pylist()
        keys, counts = [], []
        for r in rows:
            own = np.empty(r["n"], dtype=np.uint64)
            own[0] = np.int64(r["first"]).view(np.uint64)
            if r["n"] > 1:
                own[1:] = _unpacked(r["steps"], r["n"] - 1)
            keys.append(np.cumsum(own, dtype=np.uint64))
            counts.append(_unpacked(r["counts"], r["n"]))
        distinct = _distinct(np.concatenate(keys))
        total = np.zeros(len(distinct), dtype=np.int64)
        places = []
        for i, c in enumerate(counts):
            at = np.searchsorted(distinct, keys[i])
            total[at] += c.astype(np.int64)
            places.append(at.astype(np.int32 if len(distinct) < 1 << 31 else np.int64))
            keys[i] = None
        classes = np.zeros(len(distinct), dtype=np.int64)
        out = {c.split()[0]: [] for c in ANSWER.split(", ")}

        def add(**row):
            for c in out:
                out[c].append(row.get(c))

        for r, at in zip(rows, places):
            if kind == WORD:
                classes[at] = np.frombuffer(r["classes"], "u1" if shape.classes <= 256 else "<u2")
            add(kind=kind, part=part, block=r["block"], n=r["n"], totals=_packed(total[at]))
        if kind == WORD:
            tokens = np.zeros(shape.classes, dtype=np.int64)
            np.add.at(tokens, classes, total)
            types = np.bincount(classes[total > 0], minlength=shape.classes)
            for c in np.flatnonzero(types):
                add(kind=kind, part=part, block=-1, n=0, **{"class": int(c)}, tokens=int(tokens[c]), types=int(types[c]))
        wide = {"totals": pa.binary(), "tokens": pa.int64(), "types": pa.int64()}
        return pa.table({c: pa.array(v, wide.get(c, pa.int32())) for c, v in out.items()})

    return answer


def _totals(answers: pa.Table) -> dict[int, np.ndarray]:
    """The totals of a block's keys of each kind, in the order of the keys."""
    rows = sorted(answers.select(["kind", "part", "n", "totals"]).to_pylist(), key=lambda r: (r["kind"], r["part"]))
    return {k: np.concatenate([np.zeros(0, np.int64)] + [_unpacked(r["totals"], r["n"]).astype(np.int64)
                                                         for r in rows if r["kind"] == k])
            for k in (WORD, PAIR, HISTORY)}


def strength_of(history: np.ndarray, strength: np.ndarray) -> np.ndarray:
    """The strength for each n(h, c), by its power of two."""
    return strength[np.frexp(history.astype(np.float64))[1]]


def inside_probability(pair, history, share, strength) -> np.ndarray:
    """P(w | c, h) from n(h, w), n(h, c) and the word's share q of its class; q itself where the history is new."""
    m = strength_of(history, strength)
    return (pair + m * share) / (np.maximum(history, pair) + m)


def _share(count, cls, model: Model):
    return (count + 0.5) / (model.class_tokens + 0.5 * (model.class_types + 1))[cls]


def _facts(block: Block, totals: dict[int, np.ndarray]):
    """Each slice with the totals of its tokens' keys."""
    for ids, held, tok, cls, keys in block.slices:
        yield ids, held, tok, cls, *(totals[k][np.searchsorted(block.keys[k], keys[k])]
                                     for k in (WORD, PAIR, HISTORY))


CELL_NAMES = ["level", "pair", "share", "n", "pairs", "histories", "shares"]
CELLS = "level int, pair int, share int, n long, pairs double, histories double, shares double"
FACTS = ("ids array<long>, held array<boolean>, n_tokens array<long>, n_known array<long>, base array<double>, "
         f"class_score array<double>, classes binary, counts binary, pairs binary, histories binary, cells array<struct<{CELLS}>>")
_LEAST = 100  # shares are above 2^-100


def _cells(pair, history, share) -> list[dict]:
    """Training tokens without themselves, added up by their powers of two (a bounded table)."""
    k, h = pair - 1, np.maximum(history, pair) - 1
    powers = [np.frexp(x.astype(float))[1].astype(np.int64) for x in (h, k, share)]
    code = (powers[0] * 64 + powers[1]) * 128 + powers[2] + _LEAST
    n = np.bincount(code)
    held = np.flatnonzero(n)
    sums = [np.bincount(code, weights=x)[held].tolist() for x in (k, h, share)]
    columns = [held // 128 // 64, held // 128 % 64, held % 128 - _LEAST, n[held]]
    return [dict(zip(CELL_NAMES, row)) for row in zip(*(c.tolist() for c in columns), *sums)]


def _known(model: Model):
    """What is known of a block before the strengths: a row per slice with its texts' finished sums, the totals
    of every token's keys, and the slice's training tokens as :func:`_cells`."""
    shape = model.shape
    kind = np.uint8 if shape.classes <= 256 else np.uint16

    def known(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        block = _block_of(docs, shape, model.bits)
        out = {c: [] for c in FACT_TYPES}
        for ids, held, tok, cls, count, pair, history in _facts(block, _totals(answers)):
            log_class = class_log_probabilities(model.weights, model.bias, features_of(tok, shape.rows), cls)
            base = np.log10((count + 0.5) / (model.tokens + 0.5 * (model.types + 1)))
            use = ~held[tok.doc] & (cls > 0) & (history > 1)

            def per_text(x, n=len(ids), doc=tok.doc):
                return np.bincount(doc, weights=x, minlength=n)

            row = {"ids": ids, "held": held.tolist(), "n_tokens": np.diff(tok.first).astype(np.int64),
                   "n_known": per_text(count > 0).astype(np.int64), "base": per_text(base),
                   "class_score": per_text(log_class / np.log(10)), "classes": cls.astype(kind).tobytes(),
                   "counts": _packed(count), "pairs": _packed(pair), "histories": _packed(history),
                   "cells": _cells(pair[use], history[use], _share(count[use] - 1, cls[use], model))}
            for c in out:
                out[c].append(row[c])
        return pa.table({c: pa.array(v, FACT_TYPES[c]) for c, v in out.items()})

    return known


FACT_TYPES = {
    "ids": pa.list_(pa.int64()), "held": pa.list_(pa.bool_()), "n_tokens": pa.list_(pa.int64()), "n_known": pa.list_(pa.int64()),
    "base": pa.list_(pa.float64()), "class_score": pa.list_(pa.float64()), "classes": pa.binary(), "counts": pa.binary(),
    "pairs": pa.binary(), "histories": pa.binary(),
    "cells": pa.list_(pa.struct([(c, pa.int32()) for c in CELL_NAMES[:3]] + [("n", pa.int64())] + [(c, pa.float64()) for c in CELL_NAMES[4:]])),
}


def learn_strength(cells: pd.DataFrame, steps: int = 300) -> np.ndarray:
    """Gradient ascent on the log likelihood of log m, per level; a level without evidence keeps the start."""
    log_m = np.full(STRENGTHS, np.log(1e3))
    if not len(cells):
        return np.exp(log_m)
    level, n = cells["level"].to_numpy(), cells["n"].to_numpy(float)
    k, h, q = (cells[c].to_numpy() / n for c in ("pairs", "histories", "shares"))
    weight = np.maximum(np.bincount(level, weights=n, minlength=STRENGTHS), 1)
    square = np.zeros(STRENGTHS)
    for step in range(steps):
        m = np.exp(log_m)[level]
        slope = np.bincount(level, weights=n * (m * q / (k + m * q) - m / (h + m)), minlength=STRENGTHS) / weight
        square = 0.9 * square + 0.1 * slope * slope
        log_m += 0.3 * (1 - step / steps) * slope / (np.sqrt(square) + 1e-12)
        log_m = np.clip(log_m, np.log(1e-2), np.log(1e12))
    return np.exp(log_m)


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(model: Model):
    """The scores of the texts of each row of facts, once the strengths are known."""
    kind = "u1" if model.shape.classes <= 256 else "<u2"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                r = {c: batch.column(c)[at] for c in batch.schema.names}
                sizes = r["n_tokens"].values.to_numpy()
                total = int(sizes.sum())
                cls = np.frombuffer(r["classes"].as_py(), kind).astype(np.int64)
                count, pair, history = (_unpacked(r[c].as_py(), total).astype(np.int64) for c in ("counts", "pairs", "histories"))
                inside = np.log10(inside_probability(pair, history, _share(count, cls, model), model.strength))
                inside[cls == 0] = 0.0
                inside = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=inside, minlength=len(sizes))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": r["ids"].values, "held_out": r["held"].values, "n_tokens": r["n_tokens"].values,
                    "n_known": r["n_known"].values, "train_tokens": pa.array(np.full(len(sizes), model.tokens, dtype=np.int64)),
                    "base_score": r["base"].values, "score": pa.array(r["class_score"].values.to_numpy() + inside)})

    return score


def fit_and_score(docs: DataFrame, shape: Shape = Shape(), block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, Model]:
    """Train on the documents that are not held out and score all of them.

    Returns one row per input row (``doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score``) and the model.  A null or empty text is its end token alone.  A null id
    belongs to the training part; repeated rows are counted and scored each.  Without any
    training token all counts are 0 and scores stay finite.  An empty table gives an empty one.
    Only ``doc_id`` and ``text`` are read.
    """
    given = docs.select("doc_id", "text")
    size = text_bytes(given)
    count = max(1, -(-size // block_bytes))
    bits = min(64, max(40, size.bit_length() + 15))
    blocks = dealt(given, count)
    sent = blocks.groupBy("block").applyInArrow(_send(shape, bits, -(-count // BLOCKS_PER_RANGE)), SENT)
    answers = materialize(sent.groupBy("kind", "part").applyInArrow(_answer(shape), ANSWER), "lm_counts")
    tokens, types = np.zeros(shape.classes), np.zeros(shape.classes)
    for r in (answers.filter("block = -1").groupBy("class")
              .agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types")).collect()):
        tokens[r["class"]], types[r["class"]] = r["tokens"], r["types"]
    share = (tokens + 0.5) / (tokens + 0.5).sum()
    model = Model(shape, np.zeros((shape.rows, shape.classes), np.float32), np.log(share).astype(np.float32),
                  int(tokens.sum()), int(types.sum()), tokens, types, bits, np.ones(STRENGTHS))
    train_weights(given, model)
    totals = answers.filter("block >= 0").select("block", "kind", "part", "n", "totals")
    # the texts meet their totals once: what the scores need is written, and every training token is evidence
    path = scratch_path(docs.sparkSession, "lm_facts")
    known = blocks.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(_known(model), FACTS)
    known.write.option("compression", "zstd").parquet(path)
    facts = docs.sparkSession.read.parquet(path)
    cells = (facts.select(F.inline("cells")).groupBy("level", "pair", "share")
             .agg(*(F.sum(c).alias(c) for c in CELL_NAMES[3:])).toPandas())
    model.strength = learn_strength(cells)
    scored = facts.drop("cells").mapInArrow(_score(replace(model, weights=np.zeros((0, shape.classes), np.float32))), SCORED)
    return scored, model
