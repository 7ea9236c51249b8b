import pytest
from pyspark.sql import functions as F

from memweave.functions.ordering import dense_index
from memweave.operators import collections as C

STATE = "collection string, namespace string, key string, embedding array<float>, lang string, source string"
BATCH = STATE + ", seq long"


def state(spark):
    return spark.createDataFrame([("c", "n", "a", [1.0], "en", "s1"), ("c", "n", "b", [2.0], "fr", "s2"),
                                  ("c", "m", "c", [3.0], None, "s3")], STATE)


def test_batch_get_input_order_duplicates_missing(spark):
    keys = spark.createDataFrame([(0, "a"), (1, "x"), (2, "a")], "ord int, key string")
    out = C.get_batch(state(spark), keys).orderBy("ord").collect()
    assert [(r.ord, r.key) for r in out] == [(0, "a"), (2, "a")]


def test_upsert_duplicates_last_wins_and_new_keys(spark):
    batch = spark.createDataFrame([("c", "n", "a", [9.0], "de", "s1", 1), ("c", "n", "a", [8.0], "it", "s1", 2),
                                   ("c", "n", "z", [7.0], "en", "s9", 3)], BATCH)
    out = {r.key: r for r in C.upsert(state(spark), batch).collect()}
    assert set(out) == {"a", "b", "c", "z"} and out["a"].lang == "it" and out["a"].embedding == [8.0]


def test_upsert_twice_equals_once(spark):
    batch = spark.createDataFrame([("c", "n", "a", [9.0], "de", "s1", 1), ("c", "n", "q", [1.0], "en", "s", 2)], BATCH)
    once = C.upsert(state(spark), batch)
    twice = C.upsert(once, batch)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_missing_collection_strict_fails_lenient_rejects(spark):
    batch = spark.createDataFrame([("nope", "n", "a", [9.0], "de", "s1", 1)], BATCH)
    reg = spark.createDataFrame([("c", "Ready")], "name string, state string")
    with pytest.raises(Exception):
        C.upsert(state(spark), batch, registry=reg, strict=True).collect()
    good, missing = C.check_collections(batch, reg, strict=False)
    assert good.count() == 0 and missing.count() == 1


def test_classified_upsert_skip_keeps_old_vector(spark):
    batch = spark.createDataFrame([("c", "n", "a", [5.0], "en", "s1", 1),     # same metadata -> skip
                                   ("c", "n", "b", [6.0], "de", "s2", 2),     # changed -> update
                                   ("c", "n", "new", [7.0], "en", "s", 3)], BATCH)
    new_state, report = C.classified_upsert(state(spark), batch, metadata_cols=["lang", "source"])
    ops = {r.key: r.op for r in report.collect()}
    assert ops == {"a": "skip", "b": "update", "new": "upsert"}
    rows = {r.key: r for r in new_state.collect()}
    assert rows["a"].embedding == [1.0] and rows["b"].embedding == [6.0] and "new" in rows
    order = [r.key for r in report.orderBy("op_order", "seq").collect()]
    assert order == ["a", "new", "b"]


def test_null_metadata_is_update(spark):
    st = spark.createDataFrame([("c", "n", "a", {"x": "1"}), ("c", "n", "b", None)],
                               "collection string, namespace string, key string, meta map<string,string>")
    b = spark.createDataFrame([("c", "n", "a", None, 1), ("c", "n", "b", {"x": "1"}, 2)],
                              "collection string, namespace string, key string, meta map<string,string>, seq long")
    ops = {r.key: r.op for r in C.classify(st, b, metadata_col="meta").collect()}
    assert ops == {"a": "update", "b": "update"}


def test_remove_and_delete_rules(spark):
    st = state(spark)
    keys = spark.createDataFrame([("a",), ("missing",)], "key string")
    assert sorted(r.key for r in C.remove_keys(st, keys).collect()) == ["b", "c"]
    # a row lacking the filter field stays
    assert sorted(r.key for r in C.remove_where(st, {"lang": "en"}).collect()) == ["b", "c"]
    assert C.clear_namespace(st, "", collection=None).count() == 0
    assert sorted(r.key for r in C.clear_namespace(st, "n", collection=None).collect()) == ["c"]
    with pytest.raises(C.CollectionError):
        C.delete(st, collection=None)
    out = C.delete(st, collection=None, ids=keys, namespace="n", where={"lang": "en"})
    assert sorted(r.key for r in out.collect()) == ["b", "c"]


def test_purge_union_keep_is_old(spark):
    st = state(spark)
    keys = spark.createDataFrame([("b",)], "key string")
    kept = C.remove_keys(st, keys)
    removed = st.join(keys, "key", "left_semi")
    assert sorted(map(tuple, kept.unionByName(removed).collect())) == sorted(map(tuple, st.collect()))


def test_registry_create_and_drop(spark):
    reg = spark.createDataFrame([("c", "Ready"), ("p", "Initializing")], "name string, state string")
    names = spark.createDataFrame([("c",), ("d",), ("  ",)], "name string")
    new, rejects = C.create_collections(reg, names)
    assert sorted(r.name for r in new.collect()) == ["c", "d", "p"]
    assert [r.reason for r in rejects.collect()] == ["blank name"]
    _, remote_rejects = C.create_collections(reg, names, policy="remote")
    assert sorted(r.name for r in remote_rejects.collect()) == ["  ", "d"]
    drop = spark.createDataFrame([("x",)], "name string")
    with pytest.raises(C.CollectionError):
        C.drop_collections(reg, drop, strict=True)
    assert C.drop_collections(reg, drop, strict=False).count() == 2
    ex = {r.name: r.exists for r in C.collections_exist(reg, spark.createDataFrame([("c",), ("p",), ("x",)], "name string"),
                                                        policy="remote").collect()}
    assert ex == {"c": True, "p": False, "x": False}


def test_dense_index_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 5000).alias("o"))
    idx = dense_index(df, ["g"], ["o"], "i", num_partitions=7)
    got = sorted((r.g, r.o, r.i) for r in idx.collect())
    exp = []
    for g in range(3):
        os_ = sorted(r.o for r in df.filter(F.col("g") == g).collect())
        exp += [(g, o, i) for i, o in enumerate(os_)]
    assert got == sorted(exp)


def test_batch_counts_blocks_of_100(spark):
    b = spark.range(0, 250).select(F.lit("c").alias("collection"), F.lit("n").alias("namespace"),
                                   F.col("id").alias("seq"))
    rows = {(r.namespace, r.batch_no): r.n_vectors for r in C.batch_counts(b).collect() if r.collection}
    assert rows[("n", 0)] == 100 and rows[("n", 2)] == 50 and rows[("n", None)] == 250


def test_removals_stay_in_their_collection(spark):
    rows = [(c, n, k, f"d{k}", "en") for c in ("A", "B") for n in ("", "n") for k in ("a", "b")]
    st = spark.createDataFrame(rows, "collection string, namespace string, key string, document_id string, lang string")
    keys = spark.createDataFrame([("a",)], "key string")
    docs = spark.createDataFrame([("da",)], "document_id string")
    left = lambda df: sorted((r.collection, r.namespace, r.key) for r in df.collect())
    all_b = [("B", n, k) for n in ("", "n") for k in ("a", "b")]
    assert left(C.remove_keys(st, keys, collection="A")) == [("A", "", "b"), ("A", "n", "b"), *all_b]
    assert left(C.remove_documents(st, docs, collection="A")) == [("A", "", "b"), ("A", "n", "b"), *all_b]
    assert left(C.remove_where(st, {"lang": "en"}, collection="A")) == all_b
    assert left(C.clear_namespace(st, "n", collection="A")) == [("A", "", "a"), ("A", "", "b"), *all_b]
    assert left(C.clear_namespace(st, "", collection="A")) == all_b
    assert left(C.delete(st, collection="A", ids=keys, namespace="n")) == [("A", "", "a"), ("A", "", "b"), ("A", "n", "b"), *all_b]
    assert left(C.delete(st, collection="A", delete_all=True)) == all_b


def test_null_metadata_updates_through_the_upsert(spark):
    schema = "collection string, namespace string, key string, meta map<string,string>, v long, seq long"
    st = spark.createDataFrame([("c", "n", "a", None, 1, 0)], schema)
    batch = spark.createDataFrame([("c", "n", "a", None, 2, 1)], schema)
    new, report = C.classified_upsert(st, batch, metadata_col="meta")
    assert [r.op for r in report.collect()] == ["update"] and [r.v for r in new.collect()] == [2]


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_dense_index_on_many_rows(spark, adaptive):
    from pyspark.sql import functions as F

    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        df = spark.range(300_000).select((F.col("id") % 10_007).alias("g"), F.hash("id").alias("o"), "id", F.md5(F.col("id").cast("string")).alias("payload"))
        one = dense_index(df.withColumn("z", F.lit(None).cast("int")), ["z"], ["o", "id"], "i", num_partitions=13)
        got = one.agg(F.count("*"), F.countDistinct("i"), F.min("i"), F.max("i"), F.countDistinct("payload")).first()
        assert tuple(got) == (300_000, 300_000, 0, 299_999, 300_000)
        per = dense_index(df, ["g"], ["o", "id"], "i", num_partitions=13).groupBy("g").agg(F.count("*").alias("n"), F.countDistinct("i").alias("d"), F.max("i").alias("m"))
        assert per.filter("n <> d or m <> n - 1").count() == 0 and per.agg(F.sum("n")).first()[0] == 300_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
