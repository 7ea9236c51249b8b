import math

import pytest
from pyspark.sql import functions as F

from memweave.operators import search

SCHEMA = "collection string, namespace string, key string, embedding array<float>, lang string"


def recs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_topk_guard_returns_empty(spark):
    r = recs(spark, [("c", "", "a", [1.0, 0.0], "en")])
    for k in (0, -1):
        assert search.nearest(r, [1.0, 0.0], top_k=k).count() == 0


def test_floor_memory_keeps_equal_remote_drops_equal(spark):
    # cos([1,0],[1,1]) = 0.707107 after rounding
    r = recs(spark, [("c", "", "a", [1.0, 1.0], "en"), ("c", "", "b", [1.0, 0.0], "en")])
    mem = search.nearest(r, [1.0, 0.0], top_k=5, min_relevance=0.707107, policy="memory")
    rem = search.nearest(r, [1.0, 0.0], top_k=5, min_relevance=0.707107, policy="remote")
    assert sorted(x.key for x in mem.collect()) == ["a", "b"]
    assert sorted(x.key for x in rem.collect()) == ["b"]


def test_zero_and_uneven_vectors_get_no_score(spark):
    r = recs(spark, [("c", "", "z", [0.0, 0.0], "en"), ("c", "", "u", [1.0, 0.0, 0.0], "en"),
                     ("c", "", "ok", [0.5, 0.5], "en")])
    out = search.nearest(r, [1.0, 0.0], top_k=5, min_relevance=None)
    assert [x.key for x in out.collect()] == ["ok"]
    q = spark.createDataFrame([("q", [1.0, 0.0], "c")], "qid string, query_vector array<float>, collection string")
    many = search.nearest_many(r, q, top_k=5, min_relevance=None, match_cols=["collection"])
    assert [x.key for x in many.collect()] == ["ok"]


def test_negative_scores_drop_with_default_floor(spark):
    r = recs(spark, [("c", "", "neg", [-1.0, 0.0], "en"), ("c", "", "pos", [1.0, 0.1], "en")])
    assert [x.key for x in search.nearest(r, [1.0, 0.0], top_k=5).collect()] == ["pos"]


def _random_records(spark, n=300, d=8, seed=7):
    import random
    rnd = random.Random(seed)
    rows = [("c%d" % (i % 3), "ns%d" % (i % 2), "k%03d" % i, [rnd.uniform(-1, 1) for _ in range(d)], "en")
            for i in range(n)]
    return recs(spark, rows)


def test_many_matches_single_and_blocks(spark):
    r = _random_records(spark)
    q = r.filter(F.col("key") < "k010").select(F.col("key").alias("qid"), F.col("embedding").alias("query_vector"),
                                                "collection")
    many = search.nearest_many(r, q, top_k=4, min_relevance=0.1, match_cols=["collection"])
    tiny = search.nearest_many(r, q, top_k=4, min_relevance=0.1, match_cols=["collection"], max_broadcast_bytes=200)
    a = sorted((x.qid, x.key, x.score) for x in many.collect())
    b = sorted((x.qid, x.key, x.score) for x in tiny.collect())
    assert a == b
    for row in q.collect():
        single = search.nearest(r.filter(F.col("collection") == row.collection), row.query_vector, top_k=4,
                                min_relevance=0.1)
        exp = [(row.qid, x.key, x.score) for x in single.collect()]
        got = [t for t in a if t[0] == row.qid]
        assert sorted(exp) == got


def test_topk_subset_of_topk_plus_one(spark):
    r = _random_records(spark)
    q = r.filter(F.col("key") < "k005").select(F.col("key").alias("qid"), F.col("embedding").alias("query_vector"))
    k3 = {(x.qid, x.key) for x in search.nearest_many(r, q, top_k=3, min_relevance=None).collect()}
    k4 = {(x.qid, x.key) for x in search.nearest_many(r, q, top_k=4, min_relevance=None).collect()}
    assert k3 <= k4 and len(k3) == 15


def test_unlimited_search_returns_everything_above_floor(spark):
    r = _random_records(spark, n=50)
    q = r.filter(F.col("key") == "k000").select(F.col("key").alias("qid"), F.col("embedding").alias("query_vector"))
    allrows = search.nearest_many(r, q, top_k=None, min_relevance=0.0)
    exp = search.nearest(r, r.filter(F.col("key") == "k000").first().embedding, top_k=1000, min_relevance=0.0)
    assert allrows.count() == exp.count()


def test_euclidean_ranks_ascending(spark):
    r = recs(spark, [("c", "", "far", [3.0, 0.0], "en"), ("c", "", "near", [1.1, 0.0], "en")])
    out = search.nearest(r, [1.0, 0.0], top_k=1, min_relevance=None, metric="euclidean")
    assert [x.key for x in out.collect()] == ["near"]
    assert math.isclose(out.first().score, 0.1, abs_tol=1e-6)


def test_keyword_paging_limits(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    q = spark.createDataFrame([(1, "a")], "qid long, query string")
    for count, offset in ((0, 0), (11, 0), (5, -1)):
        with pytest.raises(ValueError):
            search.keyword_search(d, q, count=count, offset=offset)
    page = search.keyword_search(d, q, count=1, offset=0).collect()
    assert page[0].score == 1 and page[0].rank == 1


@pytest.mark.parametrize("ids", ["long", "string"])
def test_keyword_pages_equal_brute_force(spark, ids):
    """A word in a third of the documents, documents over several batches, ties, empty and null texts, repeated queries."""
    import random
    rnd = random.Random(5)
    words = ["common", "ä1", "Rare", "x", "y2", "mid", "İz"]
    texts = [" ".join(rnd.choice(words[1:]) for _ in range(rnd.randrange(0, 9))) + (" COMMON" * rnd.randrange(1, 4) if i % 3 == 0 else "")
             for i in range(120)] + [None, "", "...", "common " * 500]
    rows = [(i if ids == "long" else f"d{i}", t) for i, t in enumerate(texts)] + [(None, "common")]
    queries = [(j, " ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 4)))) for j in range(12)] + [(12, None), (13, "absent"), (0, "x")]
    d = spark.createDataFrame(rows, f"doc_id {ids}, text string").repartition(3)
    q = spark.createDataFrame(queries, "qid long, query string")
    split = {r.doc_id: r.t for r in d.filter("doc_id is not null").select("doc_id", search.terms(F.col("text")).alias("t")).collect()}
    asked = {}
    for r in q.select("qid", search.terms(F.col("query")).alias("t")).collect():
        asked.setdefault(r.qid, set()).update(r.t or [])
    expect = []
    for j, ts in asked.items():
        hits = sorted((-n, i) for i, t in split.items() if (n := sum(x in ts for x in t or [])))
        expect += [(j, i, -n, k + 1) for k, (n, i) in enumerate(hits) if 2 <= k < 7]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        for limit in (1 << 24, 0):  # the index, and the joins beyond it
            got = search.keyword_search(d, q, count=5, offset=2, max_index_bytes=limit)
            assert sorted((r.qid, r.doc_id, r.score, r["rank"]) for r in got.collect()) == sorted(expect)
        empty = search.keyword_search(d, q.limit(0), count=5)
        assert empty.count() == 0 and search.keyword_search(d.limit(0), q, count=5).count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_batch_topk_merge_is_exact_with_ties_and_small_batches(spark):
    import random
    rnd = random.Random(3)
    base = [[rnd.choice([-1.0, 0.0, 1.0]) for _ in range(3)] for _ in range(12)]
    rows = [("c", "", "k%03d" % i, base[i % 12], "en") for i in range(150)]  # many exact ties
    r = recs(spark, rows)
    q = spark.createDataFrame([("q%d" % i, base[i]) for i in range(6)], "qid string, query_vector array<float>")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = sorted((x.qid, x.key, x.score) for x in search.nearest_many(r, q, top_k=9, min_relevance=None).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    exp = []
    for qid, qv in [("q%d" % i, base[i]) for i in range(6)]:
        scored = []
        for _, _, key, v, _ in rows:
            nq, nv = math.sqrt(sum(x * x for x in qv)), math.sqrt(sum(x * x for x in v))
            if nq == 0 or nv == 0:
                continue
            scored.append((round(sum(a * b for a, b in zip(qv, v)) / (nq * nv), 6), key))
        scored.sort(key=lambda t: (-t[0], t[1]))
        exp += [(qid, key, s) for s, key in scored[:9]]
    assert got == sorted(exp)


def test_raw_query_with_and_without_vector(spark):
    r = recs(spark, [("c", "n1", "a", [1.0, 0.0], "en"), ("c", "n1", "b", [0.0, 1.0], "fr"),
                     ("c", "n2", "c", [1.0, 0.1], "en")])
    with_vec = search.query(r, top_k=1, vector=[1.0, 0.0], namespace="n1")
    assert [x.key for x in with_vec.collect()] == ["a"]
    no_vec = search.query(r, top_k=5, where={"lang": "en"})
    assert [x.key for x in no_vec.collect()] == ["a", "c"] and "embedding" not in no_vec.columns


def test_many_query_ids_only(spark):
    r = _random_records(spark, n=40)
    q = r.filter(F.col("key") == "k000").select(F.col("key").alias("qid"), F.col("embedding").alias("query_vector"))
    out = search.nearest_many(r, q, top_k=3, min_relevance=None, include_metadata=False)
    assert set(out.columns) == {"qid", "collection", "namespace", "key", "score"} and out.count() == 3


def test_mixed_lengths_and_numeric_ties(spark):
    rec = spark.createDataFrame([(2, [1.0, 0.0]), (10, [1.0, 0.0]), (30, [1.0, 0.0]), (4, [1.0, 0.0, 0.0])], "key long, embedding array<double>")
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [1.0])], "qid long, query_vector array<double>")
    got = {(r.qid, r.key) for r in search.nearest_many(rec, q, top_k=1).collect()}
    assert got == {(1, 2), (2, 4)}
    assert [r.qid for r in search.without_counterpart(rec, q).collect()] == [3]


def _rows(df):
    return sorted((x.qid, x.collection or "", x.key, x.score) for x in df.collect())


def _mixed_records(spark, n=700, d=6, seed=11):
    """Three lengths, zero and null vectors, null match values, exact ties, and one collection with most rows."""
    import random
    rnd = random.Random(seed)
    base = [[rnd.gauss(0, 1) for _ in range(d)] for _ in range(40)]
    rows = []
    for i in range(n):
        v = list(base[i % 40]) if i % 3 == 0 else [x + rnd.gauss(0, 0.3) for x in base[rnd.randrange(40)]]
        v = {7: [0.0] * d, 8: None, 9: [], 10: v[:3]}.get(i % 90, v)
        rows.append(("hot" if i % 10 < 6 else None if i % 10 == 6 else f"c{i % 10}", f"ns{i % 2}", f"k{i:04d}", v, "en" if i % 2 else "fr"))
    return recs(spark, rows)


def _queries(r):
    return r.filter(F.crc32("key") % 3 == 0).select(F.col("key").alias("qid"), F.col("embedding").alias("query_vector"), "collection")


@pytest.mark.parametrize("options", [dict(top_k=4, min_relevance=0.1), dict(top_k=6, min_relevance=None, policy="remote"),
                                     dict(top_k=3, min_relevance=None, metric="euclidean"), dict(top_k=None, min_relevance=0.9)])
def test_block_join_equals_broadcast_search(spark, options):
    r = _mixed_records(spark)
    q = _queries(r)
    one = search.nearest_many(r, q, match_cols=["collection"], **options)
    many = search.nearest_many(r, q, match_cols=["collection"], max_broadcast_bytes=0, query_block=20, record_block=50, **options)
    assert one.columns == many.columns
    assert _rows(one) == _rows(many) and one.count() > 100


def test_block_join_pairs_many_blocks_and_reads_records_once(spark):
    from memweave.functions.blocks import pair_blocks
    r = _mixed_records(spark).filter("collection = 'hot' and size(embedding) = 6")
    q = _queries(r)

    def sizes(a, b):
        import pyarrow as pa
        return pa.table({"a": pa.array([a.num_rows], pa.int64()), "b": pa.array([b.num_rows], pa.int64())})

    pairs = pair_blocks(q, r, ["collection"], left_hash=[F.col("qid")], right_hash=[F.col("key")], left_rows=20, right_rows=50,
                        work=sizes, schema="a long, b long").filter("a > 0 and b > 0").collect()
    n_q, n_r = q.count(), r.count()
    assert len(pairs) == -(-n_q // 20) * -(-n_r // 50) > 12 and n_q > 60 and n_r > 150
    assert sum(x.a * x.b for x in pairs) == n_q * n_r and max(x.b for x in pairs) < 100
    plan = search.nearest_many(r, q, top_k=2, max_broadcast_bytes=0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapCoGroupsInArrow") == 1 and "CartesianProduct" not in plan


@pytest.mark.parametrize("options", [dict(top_k=4, min_relevance=0.1), dict(top_k=6, min_relevance=None, policy="remote")])
def test_pruned_search_equals_the_full_scan(spark, options):
    from memweave.operators import pruned
    r = _mixed_records(spark)
    q = _queries(r)
    index = pruned.build_index(r, match_cols=["collection"], rows_per_block=8)
    found, visits = pruned.nearest(index, q, query_block=16, record_block=40, **options)
    full = search.nearest_many(r, q, match_cols=["collection"], **options)
    assert found.columns == full.columns and _rows(found) == _rows(full)
    total = visits.agg(F.sum("blocks").alias("b"), F.sum("visited").alias("v"), F.max(F.col("visited") > F.col("blocks")).alias("bad")).first()
    assert not total.bad and total.v < 0.6 * total.b


def test_pruned_search_of_all_embeddings(spark):
    from memweave.operators import pruned
    from memweave.plans.fixtures import records
    r = records(spark, "/root/testdata/sf0.01")
    q = r.select(F.col("key").alias("qid"), F.col("embedding").alias("query_vector"))
    index = pruned.build_index(r, rows_per_block=16)
    found, visits = pruned.nearest(index, q, top_k=5, min_relevance=0.2)
    assert _rows(found) == _rows(search.nearest_many(r, q, top_k=5, min_relevance=0.2))
    total = visits.agg(F.sum("blocks").alias("b"), F.sum("visited").alias("v")).first()
    assert 0 < total.v <= total.b


def test_pruned_search_without_pivots_or_rows(spark, monkeypatch):
    from memweave.operators import pruned
    r = recs(spark, [("c", "", "z", [0.0, 0.0], "en"), ("c", "", "n", None, "en"), ("c", "", "l", [1.0, 0.0, 0.0], "en"), ("c", "", "a", [1.0, 1.0], "en")])
    q = spark.createDataFrame([("q", [1.0, 0.0], "c"), ("w", [1.0], "c"), ("zero", [0.0, 0.0], "c"), ("none", None, "c"), ("other", [1.0, 0.0], "d")],
                              "qid string, query_vector array<float>, collection string")
    for n in (1, 100):
        index = pruned.build_index(r, match_cols=["collection"], rows_per_block=n)
        assert [(x.qid, x.key) for x in pruned.nearest(index, q, top_k=3)[0].collect()] == [("q", "a")]
    monkeypatch.setattr(pruned, "MAX_BLOCKS", 0)
    assert [(x.qid, x.key) for x in pruned.nearest(index, q, top_k=3)[0].collect()] == [("q", "a")]
    empty = pruned.build_index(r.limit(0), match_cols=["collection"])
    assert pruned.nearest(empty, q, top_k=3)[0].count() == 0


def test_grounding_by_a_bounded_prefix_equals_the_full_cut(spark):
    import random
    rnd = random.Random(9)
    rows = [(q, f"k{i:03d}", rnd.choice([0.9, 0.5, 0.2]), f"t{q}-{i}", rnd.choice([0, 1, 1, 2, None, 7]))
            for q in range(4) for i in range(120)]
    rows += [(9, f"k{i}", 1.0 - i / 100, f"one{i}", 1) for i in range(30)] + [(9, "zero", 0.1, "free", 0), (10, "big", 1.0, "x", 50)]
    hits = spark.createDataFrame(rows, "qid long, key string, score double, text string, n_tokens long").repartition(5)
    for budget in (0, 1, 10, 30):
        want = {}
        for q in {r[0] for r in rows}:
            run, facts = 0, []
            for r in sorted((r for r in rows if r[0] == q), key=lambda r: (-r[2], r[1])):
                run += r[4] or 0
                if run > budget:
                    break
                facts.append(r)
            if facts:
                want[q] = ("\n".join(r[3] for r in facts), len(facts), sum(r[4] or 0 for r in facts))
        got = search.grounding(hits, token_budget=budget)
        assert {r.qid: (r.facts, r.n_facts, r.n_tokens) for r in got.collect()} == want
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("metric", ["cosine", "dotproduct", "euclidean"])
def test_scores_are_ranked_in_matrices_of_bounded_size(metric, monkeypatch):
    import numpy as np
    rng = np.random.default_rng(5)
    Q, X = rng.integers(-2, 3, (90, 4)).astype(float), rng.integers(-2, 3, (700, 4)).astype(float)  # many ties
    keys = rng.permutation(700)
    plain = search._score_matrix
    higher, want = metric != "euclidean", []
    S = np.round(plain(Q, X, metric), 6)
    for q in range(90):
        best = sorted((-s if higher else s, keys[n], n) for n, s in enumerate(S[q]) if not np.isnan(s) and (s >= 0.5 if higher else s <= 3.0))[:7]
        want += [(q, n, -s if higher else s) for s, _, n in best]
    sizes = []
    monkeypatch.setattr(search, "_score_matrix", lambda a, b, m: sizes.append((len(a), len(b))) or plain(a, b, m))
    found = [*search._best_pairs(Q, X, keys, metric, 7, 0.5 if higher else 3.0, "memory", query_rows=20, record_rows=64)]
    assert [(int(q), int(n), float(s)) for part in found for q, n, s in zip(*part)] == [(q, n, float(s)) for q, n, s in want]
    assert max(a for a, _ in sizes) <= 20 and max(b for _, b in sizes) <= 64 and len(found) == 5


def test_strips_bound_the_copies_of_the_block_join(spark, monkeypatch):
    from memweave.functions import blocks
    dealt = []
    plain = blocks.pair_blocks
    monkeypatch.setattr(search, "pair_blocks", lambda *a, **o: dealt.append((o["left_rows"], o["right_rows"])) or plain(*a, **o))
    r = _random_records(spark, n=200)
    q = r.select(F.col("key").alias("qid"), F.col("embedding").alias("query_vector"))
    got = search.nearest_many(r, q, top_k=3, min_relevance=None, max_broadcast_bytes=0, query_block=2, record_block=3)
    assert _rows(got) == _rows(search.nearest_many(r, q, top_k=3, min_relevance=None))
    assert dealt == [(25, 25)]  # eight strips of a side, not a hundred blocks
    assert search.strip_rows(10**9, 64, 512) == 32_768


def test_pruned_search_deals_queries_once_however_many_blocks_they_read(spark, monkeypatch):
    from memweave.operators import pruned
    dealt = []
    plain = pruned.pair_blocks
    monkeypatch.setattr(pruned, "pair_blocks", lambda left, right, by, **o: dealt.append((left.count(), list(by))) or plain(left, right, by, **o))
    r = _mixed_records(spark)
    q = _queries(r)
    index = pruned.build_index(r, match_cols=["collection"], rows_per_block=4)
    found, visits = pruned.nearest(index, q, top_k=3, min_relevance=0.0)
    assert _rows(found) == _rows(search.nearest_many(r, q, top_k=3, min_relevance=0.0, match_cols=["collection"]))
    total = visits.agg(F.sum("visited").alias("v"), F.count("*").alias("n")).first()
    (_, first), (second, by) = dealt
    assert first[-1] == "_block" and by[-1] == "_dim" and second <= total.n and total.v > 2 * total.n


def test_a_block_reaches_when_its_bound_does():
    import numpy as np
    from memweave.operators import pruned
    rng = np.random.default_rng(2)
    near, cos, floor = rng.uniform(-1, 1, (50, 80)), np.append(rng.uniform(-1, 1, 79), 1.0), np.append(rng.uniform(-1, 1, 49), -2.0)
    bound = np.cos(np.maximum(0, np.arccos(near) - np.arccos(cos)))
    got = pruned._reaches(near, cos, floor)
    assert got[bound >= floor[:, None]].all() and not got[bound < floor[:, None] - 1e-5].any()
