import numpy as np
import pytest
from pyspark.sql import functions as F

from topiclens.operators import joins as JN


def skewed(spark, n=120_000):
    """A third of the rows hold one key, a tenth another, some none."""
    i = F.col("id")
    key = F.when(i % 3 == 0, "hot").when(i % 10 == 1, "warm").when(i % 101 == 0, None).otherwise(F.concat(F.lit("k"), i % 20_000))
    return spark.range(n).select("id", key.alias("term"))


def right(spark):
    words = spark.range(15_000).select(F.concat(F.lit("k"), "id").alias("term"), F.col("id").alias("lemma"))
    return words.unionByName(spark.createDataFrame([("hot", -1), ("unused", -2)], "term string, lemma long"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_equals_a_plain_join(spark, how):
    left = skewed(spark, 30_000)
    got = JN.lookup_join(left, right(spark), "term", how).select("id", "term", "lemma")
    want = left.join(right(spark), "term", how).select("id", "term", "lemma")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    assert JN.lookup_join(left.limit(0), right(spark), "term", how).count() == 0
    with pytest.raises(ValueError):
        JN.lookup_join(left, right(spark), "term", "full")


def test_no_shuffled_partition_is_twice_the_median(spark):
    left = skewed(spark)
    hot = JN.hot_keys(left, "term")
    assert {r["term"] for r in hot.collect()} == {"hot", "warm"}
    hot_left, hot_right, cold_left, cold_right = JN.split(left, right(spark), "term", hot)
    assert hot_left.count() > 40_000 and hot_right.count() == 1
    some = cold_left.filter("term is not null")
    sizes = [r["n"] for r in some.repartition(16, "term").groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) < 2 * np.median(sizes)
    plan = hot_left.join(F.broadcast(hot_right), "term")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
