import numpy as np

from memweave.llm.quality import ABSTAIN, BAD, GOOD, classify, fit_labellers, pack_votes, unpack_votes
from memweave.sources.tables import load
from tests.llm.helpers import WORD, awkward, nothing

SF = "/root/testdata/sf0.01"


def test_held_out_labels(spark):
    """Annotators are seen for even ids only; odd ids are held out."""
    docs, labels = load(spark, SF, "documents"), load(spark, SF, "labels")
    rows = classify(docs, labels.filter("doc_id % 2 = 0"), keep=["doc_id"]).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    good = [r for r in rows if r.quality == 1]
    junk = [r for r in rows if r.quality == 0]
    clean = [r for r in good if r.toxic == 0]
    toxic = [r for r in rows if r.toxic == 1]
    assert sum(r.junk_score < 0.5 for r in good) >= 0.97 * len(good)
    assert sum(r.junk_score >= 0.5 for r in junk) >= 0.9 * len(junk)
    assert sum(r.kept for r in clean) >= 0.96 * len(clean)
    assert sum(not r.kept for r in toxic) >= 0.6 * len(toxic)


def test_without_annotators(spark):
    docs, labels = load(spark, SF, "documents"), load(spark, SF, "labels")
    rows = classify(docs, keep=["doc_id"]).join(labels, "doc_id").collect()
    assert sum((r.junk_score < 0.5) == (r.quality == 1) for r in rows) >= 0.95 * len(rows)
    clean = [r for r in rows if r.quality == 1 and r.toxic == 0]
    assert sum(r.kept for r in clean) >= 0.95 * len(clean)


def test_em_recovers_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(6000) < 0.3
    accuracy = [0.95, 0.9, 0.8, 0.7, 0.6]
    votes = np.stack([np.where(rng.random(6000) < 0.15, ABSTAIN, np.where(rng.random(6000) < a, truth, ~truth)) for a in accuracy])
    codes, counts = np.unique(pack_votes(votes), return_counts=True)
    patterns = unpack_votes(codes, len(accuracy))
    posterior, table = fit_labellers(patterns, counts.astype(float), need=3)
    for k, a in enumerate(accuracy):
        assert abs(table[1, k, 1] - a) < 0.06 and abs(table[0, k, 0] - a) < 0.06
    got = dict(zip(codes.tolist(), posterior > 0.5))
    majority = (votes == BAD).sum(0) > (votes == GOOD).sum(0)
    right = np.mean([got[c] for c in pack_votes(votes).tolist()] == truth)
    assert right >= np.mean(majority == truth) and right > 0.93


def test_awkward_rows_and_empty_tables(spark):
    labels = spark.createDataFrame([(20, 1, 0), (20, 0, 0), (None, 1, None), (5, None, 1)], "doc_id long, quality int, toxic int")
    for own in (None, labels):
        rows = classify(awkward(spark), own).collect()
        assert len(rows) == awkward(spark).count()
        assert all(r.junk_score == 1 and r.kept in (False, None) for r in rows if not WORD.search(r.text or ""))
        assert len({(r.junk_score, r.toxic_score) for r in rows if r.doc_id in (20, 21, 22)}) == 1
    assert classify(nothing(spark), labels).count() == 0
    assert classify(awkward(spark), labels.limit(0)).count() == awkward(spark).count()
    blank = spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string")
    assert [(r.junk_score, r.kept) for r in classify(blank).collect()] == [(1.0, False)] * 2
