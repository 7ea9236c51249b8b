import math

import pytest
from pyspark.sql import functions as F

from memweave.functions.filters import tag_filters
from memweave.operators import collections as C
from memweave.operators import embedding as E
from memweave.operators import ingest as I
from memweave.operators import records as R
from memweave.plans import ingest as P

DOCS = "doc_id long, text string, lang string, source string"


def test_html_to_text(spark):
    html = ('<html><head><style>p{x}</style><script>var a="<p>";</script></head><body><nav><a>menu</a></nav>'
            '<p>Fish &amp; chips &lt;3</p>\n<div>more\ttext</div></body></html>')
    df = spark.createDataFrame([(1, "http://x/y", html)], "page_id long, url string, html string")
    row = I.import_web_pages(df).first()
    assert row.text == "Fish & chips <3 more text" and row.url == "http://x/y"


def test_import_gate_partitions(spark):
    docs = spark.createDataFrame([(1, "a b c\nd e", "en", None), (2, "", "fr", "s")], DOCS)
    files = I.import_text(docs)
    tags = {r.document_id: r.tags for r in files.collect()}
    assert tags["1"] == {"lang": ["en"]} and tags["2"] == {"lang": ["fr"], "source": ["s"]}
    html = files.withColumn("mime_type", F.lit("text/html"))
    ok, rejected = I.partition_gate(files.unionByName(html))
    assert ok.count() == 2 and rejected.count() == 2
    parts = I.partition_artifacts(ok, max_tokens_per_line=10, max_tokens_per_paragraph=10)
    rows = parts.collect()
    assert len(rows) == 1 and rows[0].name == "content.txt.partition.0.txt" and rows[0].parent_id == rows[0].file_id


def test_hashed_embedding_is_unit_length_and_deterministic(spark):
    df = spark.createDataFrame([(1, "alpha beta beta"), (2, "")], "id int, text string")
    rows = {r.id: r.embedding for r in E.embed(df).collect()}
    assert math.isclose(sum(x * x for x in rows[1]), 1.0, rel_tol=1e-5)
    assert rows[2] == [0.0] * 64
    again = {r.id: r.embedding for r in E.embed(df).collect()}
    assert again == rows


def test_empty_vector_is_an_error_when_strict(spark):
    df = spark.createDataFrame([(1, "x")], "id int, text string")
    empty = lambda c: F.array().cast("array<float>")
    with pytest.raises(Exception):
        E.embed(df, embedder=empty, strict=True).collect()


def test_pending_and_processed_gates(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h", "en", "s")], DOCS)
    parts = P.partitions(P.import_files(docs), P.IngestOptions(max_tokens_per_line=2, max_tokens_per_paragraph=4,
                                                                overlap_tokens=0))
    jobs = E.with_generators(E.embeddable(parts), [("a.b.c.Gen", "g1", 8), ("a.b.c.Gen", "g2", 8)])
    assert jobs.count() == 4 and {r.provider for r in jobs.collect()} == {"b.c.Gen"}
    existing = jobs.filter(F.col("part_no") == 0).select(F.col("artifact_id").alias("source_partition_id"),
                                                         "provider", "generator")
    assert E.pending(jobs, existing).count() == 2
    log = E.mark_processed(parts.filter(F.col("part_no") == 1), "embed")
    assert [r.part_no for r in E.not_processed(parts, log, "embed").collect()] == [0]
    assert E.reuse_report(jobs).first().saved_calls == 0


def test_merge_tags_groups_duplicate_keys(spark):
    df = spark.createDataFrame([("d1", {"lang": ["en"], "__document_id": ["extra"]})],
                               "document_id string, tags map<string,array<string>>")
    out = df.select(R.merge_tags([("__document_id", F.col("document_id"))], F.col("tags")).alias("t")).first().t
    assert sorted(out["__document_id"]) == ["d1", "extra"] and out["lang"] == ["en"]
    flat = df.select(R.flat_tags(F.col("tags")).alias("f")).first().f
    assert flat == "__document_id:extra|lang:en"


def test_full_ingest_purges_and_fans_out(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(40)), "en", "s")], DOCS)
    files = P.import_files(docs)
    small = P.IngestOptions(max_tokens_per_line=5, max_tokens_per_paragraph=10, overlap_tokens=0,
                            generators=(("x.y.z.Gen", "g", 8),))
    big = P.IngestOptions(max_tokens_per_line=5, max_tokens_per_paragraph=20, overlap_tokens=0,
                          generators=(("x.y.z.Gen", "g", 8),))
    first = P.ingest(None, files, small)
    assert first.count() == 4
    second = P.ingest(first, files, big)
    assert second.count() == 2
    assert R.stale_records(first, second).count() == 2
    payload = second.first().payload
    assert payload.vector_provider == "y.z.Gen" and payload.last_update == "2024-01-01T00:00:00"
    assert R.fan_out(second, ["a", "b"]).count() == 4
    ok, big_meta = R.validate_metadata(second.withColumnRenamed("key", "record_id"), limit=10)
    assert ok.count() == 0 and big_meta.count() == 2


def test_tag_filters_or_across_and_inside(spark):
    df = spark.createDataFrame([({"lang": ["en"], "src": ["a"]},), ({"lang": ["fr"]},), ({"src": ["a"]},)],
                               "tags map<string,array<string>>")
    got = df.filter(tag_filters("tags", [{"lang": "fr"}, {"lang": "en", "src": ["a", "b"]}])).count()
    assert got == 2


def test_reads_with_limits_and_by_document(spark):
    st = spark.createDataFrame([("c", "n", f"k{i}", str(i % 2), "en") for i in range(10)],
                               "collection string, namespace string, key string, document_id string, lang string")
    assert C.query_by_filter(st, {"lang": "en"}, top_k=0).count() == 0
    assert [r.key for r in C.query_by_filter(st, {"lang": "en"}, top_k=2).collect()] == ["k0", "k1"]
    ids = spark.createDataFrame([("0",), ("1",), ("9",)], "document_id string")
    per = C.by_document(st, ids, per_document=3).groupBy("document_id").count().collect()
    assert {r.document_id: r["count"] for r in per} == {"0": 3, "1": 3}
    stats = {(r.collection, r.namespace): r.n_vectors for r in
             C.index_stats(st.withColumn("embedding", F.array(F.lit(1.0)))).collect()}
    assert stats[("c", "n")] == 10 and stats[(None, None)] == 10


def test_pending_recomputes_changed_text(spark):
    docs = spark.createDataFrame([(1, "a b c d", "en", "s")], DOCS)
    opts = P.IngestOptions(max_tokens_per_line=4, max_tokens_per_paragraph=8, overlap_tokens=0)
    jobs = E.with_generators(E.embeddable(P.partitions(P.import_files(docs), opts)), [("a.b.c.Gen", "g", 8)])
    same = jobs.select(F.col("artifact_id").alias("source_partition_id"), "provider", "generator", "sha256")
    changed = same.withColumn("sha256", F.lit("0" * 64))
    assert E.pending(jobs, same).count() == 0 and E.pending(jobs, changed).count() == 1


def test_reingest_reuses_unchanged_vectors(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma\\ndelta", "en", "s"), (2, "one two", "fr", "s")], DOCS)
    opts = P.IngestOptions(max_tokens_per_line=5, max_tokens_per_paragraph=10, overlap_tokens=0,
                           generators=(("x.y.z.Gen", "g", 8),))
    first = P.ingest(None, P.import_files(docs), opts)
    # Mark the stored vectors, then re-ingest with one document changed.
    marked = first.withColumn("embedding", F.array(*[F.lit(9.0)] * 8).cast("array<float>"))
    changed = docs.withColumn("text", F.when(F.col("doc_id") == 2, F.lit("three four")).otherwise(F.col("text")))
    again = {r.document_id: r.embedding for r in P.ingest(marked, P.import_files(changed), opts).collect()}
    assert again["1"] == [9.0] * 8 and again["2"] != [9.0] * 8


def test_reingest_touches_its_collection_and_documents_only(spark):
    """Two collections; one document edited, one emptied, one untouched, and the generator replaced."""
    words = lambda tag: " ".join(f"{tag}{i}" for i in range(20))
    docs = spark.createDataFrame([(1, words("a"), "en", "s"), (2, words("b"), "en", "s"), (3, words("c"), "en", "s")], DOCS)
    base = dict(max_tokens_per_line=5, max_tokens_per_paragraph=10, overlap_tokens=0)
    old = {c: P.IngestOptions(collection=c, generators=(("x.y.z.Gen", "g", 8),), **base) for c in "AB"}
    state = P.ingest(P.ingest(None, P.import_files(docs), old["A"]), P.import_files(docs), old["B"])
    changed = docs.filter("doc_id <> 3").withColumn("text", F.when(F.col("doc_id") == 1, F.lit(" ".join(f"z{i}" for i in range(8)))).otherwise(F.lit("")))
    new = P.IngestOptions(collection="A", generators=(("x.y.z.Gen", "g2", 8),), **base)
    out = P.ingest(state, P.import_files(changed), new)
    rows = out.select("collection", "namespace", "document_id", "key", "embedding").collect()
    keys = [(r.collection, r.namespace, r.key) for r in rows]
    assert len(keys) == len(set(keys))
    count = lambda **want: sum(all(getattr(r, k) == v for k, v in want.items()) for r in rows)
    assert count(collection="B") == 6 and count(collection="A", document_id="3", namespace="g") == 2
    assert count(collection="A", document_id="1", namespace="g") == 0 and count(collection="A", document_id="1", namespace="g2") == 1
    assert count(collection="A", document_id="2") == 0
    again = P.ingest(out, P.import_files(changed), new)
    pick = lambda df: sorted((r.collection, r.namespace, r.key, tuple(r.embedding)) for r in df.collect())
    assert pick(again) == pick(out)


def test_null_mime_is_rejected(spark):
    files = P.import_files(spark.createDataFrame([(1, "x y", "en", "s")], DOCS)).withColumn("mime_type", F.lit(None).cast("string"))
    ok, bad = P.I.partition_gate(files)
    assert ok.count() == 0 and bad.count() == 1


def test_ingest_changed_leaves_unchanged_documents_alone(spark):
    from dataclasses import replace

    gens = (("org.example.T", "a", 8),)
    opts = P.IngestOptions(max_tokens_per_line=4, max_tokens_per_paragraph=6, overlap_tokens=0, generators=gens)
    later = replace(opts, stamp="2025-01-01T00:00:00")

    def files(*rows):
        return P.import_files(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))

    def stamps(state):
        out = {}
        for r in state.select("collection", "document_id", "namespace", "payload.last_update", "payload.text").collect():
            out.setdefault((r.collection, r.document_id), set()).add((r.namespace, r.last_update[:4]))
        return out

    long_text = "one two three four five six seven eight nine ten"
    first = files((1, long_text, "en", "s"), (2, "b b", "en", "s"), (3, "c", "en", "s"), (4, None, "en", "s"))
    state, known = P.ingest_changed(None, None, first, opts)
    other, other_known = P.ingest_changed(None, None, first, replace(opts, collection="other"))
    state, known = state.unionByName(other), known.unionByName(other_known)
    assert known.count() == 8

    # nothing changed: an embedder that fails is never called, the state stays as it is
    failing = replace(later, embedders={"a": lambda text: F.raise_error(F.lit("embedded again")).cast("array<float>")})
    same, same_known = P.ingest_changed(state, known, first, failing)
    assert stamps(same) == stamps(state) and sorted(same_known.collect()) == sorted(known.collect())

    # 1 shrinks, 2 is emptied, 3 gets another tag value, 4 stays empty, 5 is new
    second = files((1, "one two", "en", "s"), (2, "", "en", "s"), (3, "c", "fr", "s"), (4, None, "en", "s"), (5, "e", "en", "s"))
    new, new_known = P.ingest_changed(state, known, second, later)
    got = stamps(new)
    assert got[("memory", "1")] == got[("memory", "3")] == got[("memory", "5")] == {("a", "2025")}
    assert ("memory", "2") not in got and got[("other", "2")] == {("a", "2024")}
    assert new.filter("collection = 'memory' and document_id = '1'").count() == 1
    assert {k: v for k, v in got.items() if k[0] == "other"} == {k: v for k, v in stamps(state).items() if k[0] == "other"}
    assert new_known.count() == 9 and new_known.dropDuplicates(["collection", "document_id"]).count() == 9

    # a replaced generator: every document of its collection, and of no other
    swapped = replace(later, collection="other", generators=(("org.example.T", "b", 8),))
    final, _ = P.ingest_changed(new, new_known, first, swapped)
    got = stamps(final)
    assert all(v == {("b", "2025")} for k, v in got.items() if k[0] == "other")
    assert {k: v for k, v in got.items() if k[0] == "memory"} == {k: v for k, v in stamps(new).items() if k[0] == "memory"}


def _sorted_records(df):
    return sorted(str((r.collection, r.namespace, r.key, r.document_id, r.payload.text, r.payload.last_update, list(r.embedding))) for r in df.collect())


def test_embed_jobs_shuffles_each_text_once(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"copy {i % 3 // 2} of a text", "en", "s") for i in range(12)], DOCS)
    gens = (("x.y.z.Gen", "g", 8), ("x.y.z.Gen", "h", 4))
    opts = P.IngestOptions(max_tokens_per_line=5, max_tokens_per_paragraph=10, overlap_tokens=0, generators=gens)
    jobs = E.with_generators(E.embeddable(P.partitions(P.import_files(docs), opts, materialize=True)), gens)
    pick = lambda df: sorted((r.document_id, r.generator, tuple(r.embedding)) for r in df.collect())
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = E.embed_jobs(jobs, gens, stamp=opts.stamp)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1
        got = pick(rows)
        # one text has more jobs than are gathered in a row
        monkeypatch.setattr(E, "GROUP_JOBS", 10)
        assert pick(E.embed_jobs(jobs, gens, stamp=opts.stamp)) == got
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(got) == 24 and len({v for _d, g, v in got if g == "g"}) == 2


def test_ingest_of_many_documents_shuffles_no_state_rows(spark, monkeypatch):
    """Where ids are too many to broadcast, the state is as where they are few; rows with a null or shared id included."""
    rows = [(1, "a b c", "en", "s"), (1, "a b c", "en", "s"), (2, "b c d", "en", "s"), (3, "c", "en", "s"), (None, "n", "en", "s")]
    docs = spark.createDataFrame(rows, DOCS)
    changed = spark.createDataFrame([(1, "a b c", "en", "s"), (1, "a b c", "en", "s"), (2, "", "en", "s"), (None, "n", "en", "s")], DOCS)
    base = dict(max_tokens_per_line=5, max_tokens_per_paragraph=10, overlap_tokens=0, generators=(("x.y.z.Gen", "g", 8),))

    def run():
        state = P.ingest(None, P.import_files(docs), P.IngestOptions(**base))
        other = P.ingest(None, P.import_files(docs), P.IngestOptions(collection="other", **base))
        return P.ingest(state.unionByName(other), P.import_files(changed), P.IngestOptions(stamp="2025-01-01T00:00:00", **base))

    few = _sorted_records(run())
    assert sum("2024" in r for r in few) == 5 + 2  # the other collection, document 3 and the null id
    bounds = []
    monkeypatch.setattr(C, "is_small", lambda df: False)
    monkeypatch.setattr(R, "is_small", lambda df: bounds.append(df) or len(bounds) % 2 == 0)
    many = run()
    assert len(bounds) == 2 and _sorted_records(many) == few
    assert "Exchange hashpartitioning" not in many._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(R, "is_small", lambda df: False)
    assert _sorted_records(run()) == few
