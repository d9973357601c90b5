import json

from pyspark.ml.functions import vector_to_array

from topiclens.streaming import text as STR


def test_stream_clean_and_vectorize(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    with open(src / "a.json", "w") as fh:
        for i, t in enumerate(["Good FOOD http://x.y now", "rude\tstaff", "good staff"]):
            fh.write(json.dumps({"doc_id": i, "text": t}) + "\n")
    stream = STR.read_text_stream(spark, str(src))
    assert stream.isStreaming
    vec = STR.vectorize_stream(STR.clean_stream(stream), ["good", "staff", "food"], [2, 2, 1], 3)
    q = STR.write_parquet(vec.select("doc_id", "clean", "tokens", vector_to_array("features").alias("f")),
                          str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    rows = {r.doc_id: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert rows[0].clean == "good food   now"
    assert rows[1].tokens == ["rude", "staff"]
    assert abs(sum(v * v for v in rows[0].f) - 1) < 1e-9
