from collections import Counter

from topiclens.llm.quality_rules import Rules, clean_documents, quality_measures


def base(text):
    text = text or ""
    words = text.encode().split()
    n = len(words)
    windows = Counter(tuple(words[i:i + 5]) for i in range(n - 4))
    covered = set()
    for i in range(n - 4):
        if windows[tuple(words[i:i + 5])] > 1:
            covered.update(range(i, i + 5))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return (n, sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), dup, len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


PROSE = "The quick brown fox jumps over the lazy dog near the old river bank today."
OTHER = "Many people walked along the road and talked about the weather of last week."
CASES = {
    1: f"{PROSE}\n{OTHER}", 2: None, 3: "", 4: " \t\n\n",
    5: f"{PROSE}\nHome | News | Sport | Weather | Contact\n{OTHER}",
    6: "a* b* c* d# e$ f% g& h| i< j> k* l#", 7: "STOP!! READ!! THIS!! NOW!! OR!! ELSE!! YOU!! WILL!! REGRET!! IT!! ALL!!",
    8: (PROSE + " ") * 4, 9: f"{PROSE}\n{OTHER}\nhome\nLog  in\nNext", 10: "é " * 9 + "é" * 30_000,
    11: "x y z w v u t s r q p o n\n" + PROSE, 12: "Accept cookies to go on reading here, please do so now.\n" + PROSE + "\n" + OTHER,
}


def frame(spark):
    rows = [(t, d, "s", len(t or ""), True) for d, t in CASES.items()] + [(CASES[1], None, "s", 0, False)] * 2
    return spark.createDataFrame(rows, "text string, doc_id long, n_words string, n_chars int, kept boolean")


def test_base_counts_equal_brute_force(spark):
    for r in quality_measures(frame(spark)).collect():
        text = CASES.get(r["doc_id"], CASES[1])
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        assert got == base(text), r["doc_id"]
        assert not (r["base_failed"] and r["kept"])


def test_verdicts(spark):
    kept = {r["doc_id"]: r["kept"] for r in quality_measures(frame(spark)).collect()}
    assert {d for d, k in kept.items() if k} == {None, 1, 5, 9, 11, 12}


def test_failed_lines_go_and_columns_stay(spark):
    df = frame(spark)
    got = clean_documents(df)
    assert got.columns == df.columns and got.dtypes == df.dtypes
    rows = {r["doc_id"]: r for r in got.collect()}
    assert rows[5]["text"] == f"{PROSE}\n{OTHER}" and rows[5]["n_chars"] == len(rows[5]["text"])
    assert rows[9]["text"] == f"{PROSE}\n{OTHER}" and rows[12]["text"] == f"{PROSE}\n{OTHER}"
    assert rows[11]["text"] == PROSE and rows[1]["text"] == CASES[1]
    assert got.count() == 7  # two rows without an id


def test_strict_rules_reject_more(spark):
    strict = quality_measures(frame(spark), Rules(max_lost=0.0)).collect()
    assert {r["doc_id"] for r in strict if r["kept"]} == {None, 1}


def test_clean_labels_are_kept_and_junk_goes(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = quality_measures(spark.read.parquet(f"{sf}/documents.parquet")).join(labels, "doc_id").toPandas()
    assert not out[out["quality"] == 0]["kept"].any()
    clean = out[(out["quality"] == 1) & ~out["base_failed"]]
    assert clean["kept"].mean() > 0.99


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert quality_measures(df).collect() == [] and clean_documents(df).collect() == []


def test_sentence_marks_of_many_scripts(spark):
    from topiclens.llm import quality_rules as Q

    bodies = {"।": "यह एक छोटा सा वाक्य है जो समाप्त", "۔": "یہ ایک چھوٹا سا جملہ ہے جو ختم", "؟": "هل هذه جملة قصيرة تنتهي هنا بعلامة سؤال",
              "？": "this one ends with a wide mark here", "։": "սա մի կարճ նախադասություն է որ ավարտվում", "።": "ይህ አጭር ዓረፍተ ነገር ነው እና እዚህ",
              ".": "a plain one that ends with a dot", "»": "« une citation qui se termine ici bien fermée", "😀.": "an emoji stands before the last mark here"}
    bodies |= {"": "this line just stops in the middle of", "Ł": "a line that ends in a letter of last byte"}  # U+0141 ends in 0x81
    texts = {mark: "\n".join(" ".join(f"{i}{w}" for w in body.split()) + mark for i in range(12)) for mark, body in bodies.items()}
    texts["ไทย"] = "\n".join(" ".join(f"{i}{w}" for w in "ประโยค ภาษาไทย ไม่มี เครื่องหมาย จบ".split()) for i in range(12))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts.values())], "doc_id long, text string")
    kept = {list(texts)[r["doc_id"]]: r["kept"] for r in quality_measures(df).collect()}
    assert {k for k, v in kept.items() if not v} == {"", "Ł"}
    assert {ord(c) for c in ".!?:;\"')]}»”…。！।۔؟"} <= set(Q.CLOSING) and ord(",") not in Q.CLOSING
