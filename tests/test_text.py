from topiclens.functions import text as TX
from topiclens.operators import cleaning as CL


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_lower_strip(spark):
    assert one(spark, TX.lower_strip("s"), "\t Foo \n") == "foo"
    assert one(spark, TX.lower_strip("s"), "　Bar ") == "bar"


def test_remove_url(spark):
    assert one(spark, TX.remove_url("s"), "see http://a.b/c now") == "see   now"
    assert one(spark, TX.remove_url("s"), "x https://q.r?a=1\tz") == "x  \tz"


def test_remove_escapes(spark):
    assert one(spark, TX.remove_escapes("s"), "a\nb\\c") == "a b c"
    assert one(spark, TX.remove_escapes("s"), "a\x07\x08\x0b\x0c\r\tb") == "a      b"


def test_find_repeated(spark):
    assert one(spark, TX.find_repeated("s", 3), "soooo goood waaaay ok") == ["soooo", "goood", "waaaay"]
    assert one(spark, TX.find_repeated("s", 3), "nothing here") == []


def test_drop_repeated(spark):
    assert one(spark, TX.drop_repeated("s", 3, keep_double=True), "soooo goood 1111") == "soo good 11"
    assert one(spark, TX.drop_repeated("s", 3), "soooo goood 1111") == "so god 1"
    assert one(spark, TX.drop_repeated("s", 2), "bookkeeper") == "bokeper"


def test_drop_repeated_no_long_runs(spark):
    import re

    texts = ["aaaa bbb cc d", "zzzzzz 999999 yy", "AAAA aaaa"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for row in df.select(TX.drop_repeated("s", 3, keep_double=True).alias("r")).collect():
        assert not re.search(r"([a-z0-9])\1\1", row["r"])


def test_contains_ci_null(spark):
    df = spark.createDataFrame([(None,), ("Fast RESTAURANT",), ("",)], "c string")
    got = [r[0] for r in df.select(TX.contains_ci("c", "restaurant")).collect()]
    assert got == [False, True, False]


def test_tokenize_and_predicates(spark):
    assert one(spark, TX.tokenize("s"), "ab c de1fg") == ["ab", "de", "fg"]
    df = spark.createDataFrame([("12",), ("1,000",), ("ten",), ("...",), ("word",)], "t string")
    rows = df.select(TX.is_digit("t"), TX.like_number("t"), TX.is_punct("t")).collect()
    assert [tuple(r) for r in rows] == [(True, True, False), (False, True, False), (False, True, False),
                                        (False, False, True), (False, False, False)]


def test_timestamp_prefix(spark):
    assert one(spark, TX.looks_like_timestamp("s"), "2020-01-02 03:04:05 extra") is True
    assert one(spark, TX.looks_like_timestamp("s"), "x2020-01-02 03:04:05") is False


def test_correct_repeated_collapsed_first(spark):
    docs = spark.createDataFrame([(1, "a goood day"), (2, "sooo fine"), (3, "plain")], "doc_id long, text string")
    vocab = spark.createDataFrame([("god",), ("good",), ("fine",)], "term string")
    got = {r["doc_id"]: r["text"] for r in CL.correct_repeated(docs, vocab).collect()}
    assert got == {1: "a god day", 2: "sooo fine", 3: "plain"}


def test_correct_repeated_with_lemma(spark):
    docs = spark.createDataFrame([(1, "cattts here")], "doc_id long, text string")
    vocab = spark.createDataFrame([("cat",)], "term string")
    lex = spark.createDataFrame([("cats", "cat", "NOUN")], "token string, lemma string, pos string")
    got = CL.correct_repeated(docs, vocab, lex).first()["text"]
    assert got == "cat here"


def test_correct_repeated_regex_mode(spark):
    docs = spark.createDataFrame([(1, "goood xgoood")], "doc_id long, text string")
    vocab = spark.createDataFrame([("good",)], "term string")
    whole = CL.correct_repeated(docs, vocab).first()["text"]
    loose = CL.correct_repeated(docs, vocab, whole_word=False).first()["text"]
    assert whole == "good xgoood"
    assert loose == "good xgood"


def test_clean_tokens(spark):
    toks = spark.createDataFrame([(1, 0, "the"), (1, 1, "pizza"), (1, 2, "ten"), (1, 3, "was"), (1, 4, "cold"),
                                  (1, 5, "42")], "doc_id long, pos int, term string")
    stop = CL.word_table(spark, CL.default_stop_words("english"))
    got = [r["term"] for r in CL.clean_tokens(toks, stop).orderBy("pos").collect()]
    assert got == ["pizza", "cold"]
    lex = spark.createDataFrame([("pizza", "pizza", "NOUN"), ("cold", "cold", "ADJ")], "token string, lemma string, pos string")
    custom = CL.word_table(spark, ["cold"])
    got = [r["term"] for r in CL.clean_tokens(toks, stop, lex, ["NOUN", "ADJ"], custom).collect()]
    assert got == ["pizza"]


def test_stop_word_constant_matches_spark(spark):
    assert CL.default_stop_words("english") == TX.ENGLISH_STOP_WORDS


def test_text_functions_plan_has_no_shuffle_or_python(spark):
    df = spark.createDataFrame([("A b",)], "text string")
    plan = df.select(TX.clean_text("text"), TX.find_repeated("text"), TX.drop_repeated("text"))._jdf \
        .queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "ArrowEval" not in plan


def test_numbers_ordinals_and_currency(spark):
    words = ["2nd", "21ST", "3rd", "4th", "$5", "€1,000.50", "-7", "~3", "1/2", "first", "nd", "2x", "a4th", "5.", "$", "12:30", "½"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r["w"] for r in df.filter(TX.like_number("w")).collect()]
    assert got == ["2nd", "21ST", "3rd", "4th", "$5", "€1,000.50", "-7", "~3", "1/2", "first", "5."]


def test_parse_timestamp(spark):
    values = ["2021-03-04 05:06:07", "2021-03-04 05:06:07.123 UTC", "2021-13-04 05:06:07", "at 2021-03-04 05:06:07", None, ""]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [None if r[0] is None else str(r[0]) for r in df.select(TX.parse_timestamp("v")).collect()]
    assert got == ["2021-03-04 05:06:07"] * 2 + [None] * 4


def test_words_are_judged_once_and_not_per_token(spark):
    rows = [(1, i, w) for i, w in enumerate(["the", "cats", "...", "cats", "12", "run", "two"] * 3)] + [(None, 0, "cats"), (2, 0, None)]
    toks = spark.createDataFrame(rows, "doc_id long, pos int, term string")
    lex = spark.createDataFrame([("cats", "cat", "NOUN"), ("run", "run", "VERB")], "token string, lemma string, pos string")
    kept = CL.clean_tokens(toks, CL.word_table(spark, ["the"]), lex, ["NOUN"])
    assert "RLIKE" not in kept._jdf.queryExecution().optimizedPlan().toString().upper()
    want = [(1, p, "cat") for p in (1, 3, 8, 10, 15, 17)] + [(None, 0, "cat")]
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(want, key=str)


def test_a_lexicon_is_made_of_distinct_words(spark):
    from topiclens.sources import standins as SI

    toks = spark.createDataFrame([(1, ["used", "used", "cat", "A1"]), (2, ["cat", "dogs"]), (3, None), (4, [])],
                                 "doc_id long, tokens array<string>")
    lex = SI.suffix_lexicon(toks)
    lemmas = lex.groupBy("token").agg({"lemma": "min"})
    assert "GENERATE" not in lemmas._jdf.queryExecution().optimizedPlan().toString().upper()
    assert sorted(map(tuple, lex.collect())) == [("cat", "cat", "NOUN"), ("dogs", "dog", "VERB"), ("used", "used", "ADJ")]
