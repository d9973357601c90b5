import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["lang", "rank", "term", "score"]
    assert len(rows) > 0


def test_oracle_keys_are_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 50


def test_every_query_runs_on_smallest_sf(spark):
    skip = {"coherence_sweep", "lda_topics", "doc_topics", "topic_report"}  # covered by test_models
    for name, fn in E.queries().items():
        if name in skip:
            continue
        df = fn(spark, "/root/testdata/sf0.001")
        df.write.format("noop").mode("overwrite").save()


def test_review_semi_join_is_broadcast(spark):
    df = E.queries()["semi_join_reviews"](spark, "/root/testdata/sf0.001")
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert "PushedFilters: [IsNotNull(l_partkey), In(l_linenumber" in plan or "In(l_linenumber" in plan
