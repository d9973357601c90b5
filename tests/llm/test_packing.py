import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from topiclens.llm.packing import Slots, WordTokenizer, pack_documents, pack_histogram
from topiclens.llm.queries import tokenizer_path

TEXTS = [None, "", "Hello, WORLD! it's 2024... don't", "ÀÉ ünï ﬁne Σίσυφος 東京 tower x²y", "a b\tc\x0bd",
         "<|endoftext|> x<|startoftext|>y", "é café", "w " * 9000, "z" * 5000, "I'LL we've they'd 'tis"]


def frame(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, length int")


def test_word_tokenizer_equals_tokenizer():
    path = tokenizer_path()
    plain, own = Tokenizer.from_file(path), WordTokenizer(path)
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"text": pa.array(TEXTS, pa.string())})
    for _ in range(2):  # the second time from the caches
        ids, counts = own.encode(batch)
        want = [plain.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def test_patterns_hold_the_histogram():
    rng = random.Random(1)
    histogram = {n: rng.randint(1, 50) for n in rng.sample(range(1, 4097), 500)} | {4096: 7, 1: 1000}
    patterns = pack_histogram(histogram, 4096)
    held = {}
    for p in patterns:
        assert sum(a * b for a, b in p.items) <= 4096
        for length, times in p.items:
            held[length] = held.get(length, 0) + times * p.count
    assert held == histogram and len(patterns) <= 2 * len(histogram) + 1
    slots = Slots.of(patterns)
    lengths = np.repeat(list(histogram), list(histogram.values()))
    ranks = np.concatenate([np.arange(c) for c in histogram.values()])
    sequence, offset, used = slots.place(lengths, ranks)
    ends = {}
    for s, o, n, u in sorted(zip(sequence.tolist(), offset.tolist(), lengths.tolist(), used.tolist())):
        assert ends.get(s, (0, u))[0] == o
        ends[s] = (o + n, u)
    assert all(a == b for a, b in ends.values()) and sorted(ends) == list(range(len(ends)))


def check(spark, df, texts_by_row):
    plain = Tokenizer.from_file(tokenizer_path())
    got = pack_documents(df, tokenizer_path(), max_len=64, with_ids=True).collect()
    want = sorted((len(plain.encode(t or "", add_special_tokens=False).ids) + 1) for t in texts_by_row)
    assert sorted(r["doc_tokens"] for r in got if r["start"] == 0) == want
    ends = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
        assert r["length"] == len(r["ids"]) <= 64
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())
    assert max(ends.values(), default=0) <= 64 and sorted(ends) == list(range(len(ends)))
    return got


def test_pieces_rebuild_the_documents(spark):
    plain = Tokenizer.from_file(tokenizer_path())
    got = check(spark, frame(spark, TEXTS), TEXTS)
    for i, t in enumerate(TEXTS):
        own = sorted((r["start"], r["ids"]) for r in got if r["doc_id"] == i)
        assert [x for _, ids in own for x in ids] == plain.encode(t or "", add_special_tokens=False).ids + [2]


def test_null_and_repeated_ids(spark):
    texts = ["one two three"] * 5 + [None, "x"]
    check(spark, frame(spark, texts, [1, 1, None, None, 2, None, 3]), texts)


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), tokenizer_path()).collect() == []


def test_padding_is_small_on_the_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = pack_documents(docs, tokenizer_path()).toPandas()
    used = out.groupby("sequence_id")["length"].sum()
    padded = out.groupby("sequence_id")["padded_to"].first()
    assert used.sum() / padded.sum() > 0.98
