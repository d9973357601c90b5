import subprocess
import sys

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_pack_every_token(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = _written(spark, stage(spark, docs, SF))
        assert docs.columns == names, name
        if name in ("quality_rules", "simhash_dedup"):
            assert 0 < docs.count() <= before
            before = docs.count()
        assert docs.filter("n_chars != length(text)").count() == 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).toPandas()
    assert (out.groupby("sequence_id")["length"].sum() <= 4096).all()
    assert len(out[out["start"] == 0]) == docs.count()


def _written(spark, df):
    from topiclens.session import materialize

    return materialize(df, "test_stage")


def test_quality_stage_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = corpus_pipeline.quality(spark, docs, SF).join(labels, "doc_id")
    clean = labels.filter("quality = 1").count()
    assert kept.filter("quality = 1").count() >= 0.95 * clean and kept.filter("quality = 0").count() == 0


def test_run_returns_pieces(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and corpus_pipeline.ORACLE_SQL is None


def test_nothing_else_imports_the_package():
    code = ("import sys, importlib.abc\n"
            "class No(importlib.abc.MetaPathFinder):\n"
            "    def find_spec(self, name, path, target=None):\n"
            "        if name.startswith('topiclens.llm') or name == 'corpus_pipeline':\n"
            "            raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, No())\n"
            "import __spark_entry__ as e\n"
            "assert 'tfidf' in e.queries() and not [k for k in e.queries() if k.startswith('op')]\n")
    subprocess.run([sys.executable, "-c", code], check=True, cwd="/root/repo")
