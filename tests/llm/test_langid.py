import zlib

import numpy as np

from memweave.llm import langid
from memweave.llm.queries import QUERIES
from memweave.sources.tables import load
from tests.llm.helpers import awkward, nothing

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = QUERIES["op10_byte_cnn_language"](spark, SF).join(load(spark, SF, "documents").select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == 1000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    out = [r for r in rows if r.held_out and any(c.isalpha() for c in r.text)]
    assert sum(r.lang == r.lang_pred for r in out) >= 0.97 * len(out)


def test_labels_and_ids_are_no_inputs(spark):
    """Other languages and sources on the held-out rows, in another order, change no prediction."""
    docs = load(spark, SF, "documents").select("doc_id", langid.held_out().alias("h"), "lang", "source", "text")
    other = docs.selectExpr("doc_id", "h", "if(h, 'xx', lang) as lang", "'y' as source", "text").orderBy("text")
    a, b = ({r.doc_id: (r.lang_pred, round(r.score, 9)) for r in langid.identify(d, keep=["doc_id"], train_filter=~d["h"]).collect()} for d in (docs, other))
    assert a == b


def test_pair_tables_equal_the_convolution():
    rng = np.random.default_rng(0)
    p = {"emb": rng.normal(size=(256, langid.EMBED)), "conv": rng.normal(size=(langid.REACH * langid.EMBED, langid.OUT)) * langid._mask(),
         "bias": rng.normal(size=langid.OUT), "top": rng.normal(size=(langid.OUT, 3)), "last": rng.normal(size=3)}
    x = rng.integers(0, 256, (5, langid.WINDOW)).astype(np.uint8)
    hidden = np.maximum((langid._patches(x, p["emb"]) @ p["conv"]).max(1) + p["bias"], 0)
    z = np.exp(hidden @ p["top"] + p["last"])
    assert np.allclose(langid.probabilities(p, langid.pair_tables(p), x), z / z.sum(1, keepdims=True), atol=1e-4)


def test_windows_cover_whole_texts():
    offs = np.array([0, 0, 5, 5, 5 + 256, 5 + 256 + 1000])
    row, start, end = langid.cut(np.zeros(offs[-1], np.uint8), offs)
    covered = [sorted(x for r, s, e in zip(row, start, end) if r == k for x in range(s, e)) for k in range(5)]
    assert covered == [list(range(a, b)) for a, b in zip(offs[:-1], offs[1:])] and (end - start).max() <= langid.WINDOW


def test_awkward_rows_and_empty_tables(spark):
    rows = langid.identify(awkward(spark)).collect()
    assert len(rows) == awkward(spark).count()
    for r in rows:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "fr", "de", "und") and 0 <= r.score <= 1
    assert langid.identify(nothing(spark)).count() == 0
    unlabelled = awkward(spark).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {(r.lang_pred, r.score) for r in langid.identify(unlabelled).collect()} == {("und", 0.0)}
