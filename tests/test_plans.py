"""Plan shape tests: the scale properties the design relies on."""

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
Q = entry.queries()


def plan(spark, name):
    return Q[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_single_query_search_is_take_ordered(spark):
    p = plan(spark, "n3_nearest_single")
    assert "TakeOrderedAndProject" in p and "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_many_query_search_limits_before_the_shuffle(spark):
    p = plan(spark, "n3_nearest_many")
    assert "MapInArrow" in p and "Partial" in p and "WindowGroupLimit" in p
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p
    # the partial group limit sits below the exchange on qid
    lines = p.split("\n")
    ex = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning(qid" in l)
    assert any("WindowGroupLimit" in l and "Partial" in l for l in lines[ex:])


def test_get_batch_broadcasts_requests_and_prunes_vectors(spark):
    p = plan(spark, "g3_get_batch")
    assert "BroadcastHashJoin" in p
    scans = [l for l in p.split("\n") if "FileScan" in l and "embeddings" in l]
    assert scans and all("embedding," not in l.split("]")[0] for l in scans)


def test_classification_cuts_state_with_a_broadcast_semi_join(spark):
    from memweave.operators import collections as C
    from memweave.plans.collection_queries import META
    from memweave.plans.fixtures import incoming, records
    from memweave.session import materialize

    # a batch in files, as the stream and the store see it: its size is known
    batch = materialize(incoming(spark, SF), "batch")
    p = C.classify(records(spark, SF), batch, metadata_cols=META)._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi, BuildRight" in p


def test_filter_reaches_the_scan(spark):
    p = plan(spark, "u8_remove_documents")
    assert "EqualTo(toxic,1)" in p


def test_per_document_limit_is_partial(spark):
    p = plan(spark, "g6_by_document")
    assert "WindowGroupLimit" in p and "Partial" in p


def test_chunking_is_map_only(spark):
    p = plan(spark, "c3_overlap_chunks")
    # only the optional spread() repartition, no aggregation or join
    assert "HashAggregate" not in p and "Join" not in p and "SortAggregate" not in p


def test_keyword_search_shuffles_pages_only(spark):
    p = plan(spark, "w1_keyword_page")
    assert "HashAggregate" not in p and "WindowGroupLimit" in p and "SortMergeJoin" not in p
    # the spread of a small table, and the candidates of each query
    assert p.count("Exchange hashpartitioning") <= 2 and p.count("Exchange hashpartitioning(qid") == 1
