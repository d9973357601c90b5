from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from topiclens.plans import stages as ST


def test_text_pipeline_save_load(spark, tmp_path):
    docs = spark.createDataFrame([(1, " Soooo GOOD http://x.y/z\tfood "), (2, "Rude staff\nand cold food"),
                                  (3, "good food good staff")], "doc_id long, text string")
    pipe = Pipeline(stages=[ST.LowerStrip(), ST.UrlRemover(), ST.EscapeRemover(), ST.RegexTokens()])
    model = pipe.fit(docs)
    out = model.transform(docs).orderBy("doc_id").collect()
    assert out[0].tokens == ["soooo", "good", "food"]
    path = str(tmp_path / "pipe")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path).transform(docs).orderBy("doc_id").collect()
    assert [r.tokens for r in again] == [r.tokens for r in out]


def test_corpus_vectorizer_roundtrip(spark, tmp_path):
    toks = spark.createDataFrame([(1, ["a", "b", "b"]), (2, ["a", "c"]), (3, ["c", "d"])],
                                 "doc_id long, tokens array<string>")
    est = ST.CorpusVectorizer(noBelow=1, noAbove=1.0, keepN=3, applyTfidf=True)
    m = est.fit(toks)
    assert m.terms()[:2] == ["a", "c"] and len(m.terms()) == 3
    w1 = sorted(tuple(r) for r in m.transform(toks).collect())
    path = str(tmp_path / "cv")
    m.write().overwrite().save(path)
    m2 = ST.CorpusVectorizerModel.load(path)
    assert sorted(tuple(r) for r in m2.transform(toks).collect()) == w1
    # new data is weighted with the fitted frequencies
    new = spark.createDataFrame([(9, ["a", "zzz"])], "doc_id long, tokens array<string>")
    assert [r.term_id for r in m2.transform(new).collect()] == [0]


def test_token_cleaner(spark):
    toks = spark.createDataFrame([(1, ["the", "pizza", "ten", "was", "cold"]), (2, ["the"])],
                                 "doc_id long, tokens array<string>")
    out = {r.doc_id: r.text for r in ST.TokenCleaner().transform(toks).collect()}
    assert out == {1: "pizza cold", 2: ""}


def test_image_stages_and_visual_words(spark, tmp_path):
    import numpy as np

    rng = np.random.default_rng(0)
    rows = [(i, 8, 8, 3, [int(v) for v in rng.integers(0, 256, 192)]) for i in range(6)]
    imgs = spark.createDataFrame(rows, "image_id long, height int, width int, n_channels int, pixels array<int>")
    gray = ST.Blurer(ksize=3).transform(ST.Equalizer().transform(ST.GrayConverter().transform(imgs)))
    desc = ST.DescriptorExtractor(nfeatures=3).transform(gray)
    assert desc.groupBy("image_id").count().agg(F.max("count")).first()[0] <= 3
    vw = ST.VisualWords(nWords=3, nInit=1).fit(desc)
    hist = vw.transform(desc)
    assert hist.agg(F.sum("cnt")).first()[0] == desc.count()
    path = str(tmp_path / "vw")
    vw.write().overwrite().save(path)
    assert sorted(map(tuple, ST.VisualWordsModel.load(path).transform(desc).collect())) == \
        sorted(map(tuple, hist.collect()))
    tw = ST.TfidfWeighter().fit(hist)
    w = tw.transform(hist)
    norms = w.groupBy("image_id").agg(F.sum(F.col("weight") ** 2).alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-9 or r.s == 0 for r in norms)


def test_large_models_are_tables(spark, tmp_path):
    vocabulary = spark.range(100_000).select(F.concat(F.lit("t"), F.col("id")).alias("term"), F.col("id").cast("int").alias("term_id"),
                                             (F.col("id") % 9 + 1).alias("df"))
    m = ST.CorpusVectorizerModel(nDocs=10, nTerms=100_000, applyTfidf=True).with_table(vocabulary)
    path = str(tmp_path / "v")
    PipelineModel(stages=[m]).write().overwrite().save(path)
    again = PipelineModel.load(path).stages[0]
    docs = spark.createDataFrame([(1, ["t5", "t99999", "t5", "none"])], "doc_id long, tokens array<string>")
    rows = lambda x: sorted(map(tuple, x.transform(docs).collect()))
    assert rows(again) == rows(m) and len(rows(m)) == 2
    assert again.table.count() == 100_000 and again.getOrDefault(again.nTerms) == 100_000

    words = spark.range(10_000).select(F.col("id").cast("int").alias("word_id"), F.array(F.col("id") * 1.0, F.col("id") % 7 * 1.0).alias("centroid"))
    v = ST.VisualWordsModel().with_table(words)
    v.write().overwrite().save(str(tmp_path / "w"))
    loaded = ST.VisualWordsModel.load(str(tmp_path / "w"))
    desc = spark.createDataFrame([(1, [4321.2, 2.0]), (1, [0.1, 0.1]), (2, None)], "image_id long, descriptor array<double>")
    got = sorted(map(str, loaded.transform(desc).collect()))
    assert got == sorted(map(str, v.transform(desc).collect())) and len(got) == 3
    import glob

    kept = "".join(open(f).read() for f in glob.glob(str(tmp_path / "w" / "metadata" / "part*")))
    assert len(kept) < 1000  # no list of centres among the parameters


def test_review_selector(spark, tmp_path):
    biz = spark.createDataFrame([("b1", "Pizza, Restaurants"), ("b2", "Bars"), ("b3", None)], "business_id string, categories string")
    biz.write.parquet(str(tmp_path / "biz"))
    rev = spark.createDataFrame([(f"r{i}", f"b{i % 3 + 1}", i % 5 + 1) for i in range(60)], "review_id string, business_id string, stars int")
    pick = ST.ReviewSelector(businessPath=str(tmp_path / "biz"), stars=[1, 2], size=5)
    got = pick.transform(rev).collect()
    assert len(got) == 5 and all(r["business_id"] == "b1" and r["stars"] <= 2 for r in got)
    assert ST.ReviewSelector(businessPath=str(tmp_path / "biz"), stars=[1, 2], size=40, chunked=True).transform(rev).count() <= 8


def test_repeated_char_corrector(spark, tmp_path):
    spark.createDataFrame([("good",), ("food",)], "term string").write.parquet(str(tmp_path / "v"))
    docs = spark.createDataFrame([(1, "soooo goood fooood"), (2, "plain")], "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in ST.RepeatedCharCorrector(vocabularyPath=str(tmp_path / "v")).transform(docs).collect()}
    assert out == {1: "soooo good food", 2: "plain"}


def test_photo_stages(spark, tmp_path):
    photos = spark.createDataFrame([(str(i), "inside" if i % 2 else "menu") for i in range(10)], "photo_id string, label string")
    meta = ST.PhotoMetaLoader(photosDir="/p/").transform(photos).collect()
    assert meta[0]["photo_path"] == "/p/0.jpg"
    for i in range(2, 12):
        (tmp_path / f"{i}.jpg").write_bytes(b"x" * i)
    some = ST.StratifiedSampler(nPerLabel=2, photosDir=str(tmp_path)).transform(photos)
    rows = some.collect()
    assert len(rows) == 4 and all(int(r["photo_id"]) >= 2 for r in rows)
    left = ST.RetentionManifest(photosDir=str(tmp_path)).transform(some).collect()
    assert {r["photo_id"] for r in left} == {str(i) for i in range(2, 12)} - {r["photo_id"] for r in rows}


def test_default_parts_of_speech(spark, tmp_path):
    lex = [("quickly", "quickly", "ADV"), ("pizzas", "pizza", "NOUN"), ("cold", "cold", "ADJ"), ("ate", "eat", "VERB")]
    spark.createDataFrame(lex, "token string, lemma string, pos string").write.parquet(str(tmp_path / "lex"))
    toks = spark.createDataFrame([(1, ["quickly", "ate", "cold", "pizzas"])], "doc_id long, tokens array<string>")
    assert ST.TokenCleaner(lexiconPath=str(tmp_path / "lex")).transform(toks).first()["text"] == "cold pizza"
    assert ST.TokenCleaner().transform(toks).first()["text"] == "quickly ate cold pizzas"
    assert ST.TokenCleaner(lexiconPath=str(tmp_path / "lex"), posToKeep=["ADV"], customStopWords=["x"]).transform(toks).first()["text"] == "quickly"
