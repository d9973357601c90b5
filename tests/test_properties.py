"""Property tests (hypothesis): each example set is checked in one Spark job."""
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from topiclens.functions import text as TX
from topiclens.operators import clusters as CU
from topiclens.operators import sampling as SA

texts = st.lists(st.text(alphabet="aab0 1xX\t.", min_size=0, max_size=25), min_size=1, max_size=30)


@settings(max_examples=5, deadline=None)
@given(texts)
def test_drop_repeated_leaves_no_long_runs(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    rows = df.select(TX.drop_repeated("s", 3).alias("one"), TX.drop_repeated("s", 3, True).alias("two")).collect()
    for r in rows:
        assert not re.search(r"([a-z0-9])\1\1", r.one)
        assert not re.search(r"([a-z0-9])\1\1", r.two)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4)), min_size=2, max_size=60))
def test_ari_symmetric_and_bounded(spark, pairs):
    df = spark.createDataFrame(pairs, "label_code int, cluster int")
    swapped = spark.createDataFrame([(b, a) for a, b in pairs], "label_code int, cluster int")
    a = CU.adjusted_rand_index(CU.contingency(df)).first()[0]
    b = CU.adjusted_rand_index(CU.contingency(swapped)).first()[0]
    assert abs(a - b) < 1e-12 and a <= 1.0 + 1e-12


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4)), min_size=2, max_size=60))
def test_matching_never_adds_labels(spark, pairs):
    df = spark.createDataFrame(pairs, "label_code int, cluster int")
    m = CU.match_clusters(CU.contingency(df)).collect()
    labels = {a for a, _ in pairs}
    assert {r.label_code for r in m} <= labels
    assert len({r.cluster for r in m}) == len({b for _, b in pairs})


@settings(max_examples=4, deadline=None)
@given(st.integers(1, 40), st.integers(1, 6))
def test_sample_n_exact_and_partition_free(spark, n, parts):
    df = spark.range(0, 80).withColumnRenamed("id", "k")
    a = sorted(r.k for r in SA.sample_n(df, "k", n).collect())
    b = sorted(r.k for r in SA.sample_n(df.repartition(parts), "k", n).collect())
    assert a == b and len(a) == n
