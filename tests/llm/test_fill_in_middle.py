import hashlib
import re

import duckdb
import pytest

from topiclens.llm import fill_in_middle as fim
from topiclens.llm.fill_in_middle import Shares, fill_in_middle, restored
from topiclens.llm.oracle import SQL

TEXTS = ["", None, "a", "ab cd", "x<P>y", "<S", "S>", "P>", "<M>", "<", "ÄÖ 中文 emoji 🙂 é", "\n\n \t", "one two three, four!",
         "<P", ">", "<<PP>>", "<P><S><M>", "word " * 3, "Zz9zZ", "0<", "P>1", "<", "M>2"] + [f"text number {i}, <of> many\n" * (i % 7) for i in range(150)]
LONG = ["long wörd, " * 300_000, "x" * 1_500_000, "中" * 700_000]


def brute(doc_id, text, plain=10, spm=20, seed=1):
    text = text or ""
    w = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    s = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(s[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(w) + 1), h[1] % (len(w) + 1)))
    prefix, middle, suffix = "".join(w[:a]), "".join(w[a:b]), "".join(w[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 100 - plain:
        return len(w), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(w), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(w), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def frame(spark, texts):
    rows = [(i, t, "f", "o") for i, t in enumerate(texts)] + [(None, "null id here", "f", "o"), (12, texts[12], "f", "o")]
    return spark.createDataFrame(rows, "doc_id long, text string, form string, output string")


@pytest.mark.parametrize("chunk", [7, 1 << 20])
@pytest.mark.parametrize("shares", [Shares(), Shares(seed=3, plain=0, suffix_first=50)])
def test_equals_brute_force_and_is_undone(spark, monkeypatch, chunk, shares):
    monkeypatch.setattr(fim, "CHUNK", chunk)
    texts = TEXTS + (LONG if chunk > 7 else [])
    got = restored(fill_in_middle(frame(spark, texts).coalesce(2), shares)).collect()
    assert len(got) == len(texts) + 2
    forms = set()
    for r in got:
        text = "null id here" if r["doc_id"] is None else texts[r["doc_id"]]
        want = brute(r["doc_id"], text, shares.plain, shares.suffix_first, shares.seed)
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == want
        assert r["text"] == (text or "")
        forms.add(r["form"])
    assert forms == {"plain", "psm", "spm"}


def test_a_broken_output_is_refused(spark):
    outputs = fill_in_middle(frame(spark, TEXTS)).filter("form = 'psm'").limit(1).replace("psm", "spm", "form")
    broken = outputs.selectExpr("doc_id", "n", "form", "prefix_chars", "middle_chars", "replace(output, '<S>', '') as output")
    with pytest.raises(Exception, match="three marks"):
        restored(broken).collect()


def test_sql_agrees(spark):
    con = duckdb.connect()
    con.sql("create view documents as from '/root/testdata/sf0.01/documents.parquet'")
    want = con.sql(f"select doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 from ({SQL['op12_fill_in_middle']})").fetchall()
    from topiclens.llm.queries import op12_fill_in_middle

    got = [tuple(r) for r in op12_fill_in_middle(spark, "/root/testdata/sf0.01").collect()]
    assert sorted(got) == sorted(want) and len({r[2] for r in got}) == 3


def test_empty_table(spark):
    assert restored(fill_in_middle(frame(spark, TEXTS).limit(0))).collect() == []
