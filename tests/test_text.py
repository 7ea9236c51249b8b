import re

import pytest

from memweave.operators import chunking as CH
from memweave.operators import tokens as K


def test_token_counts_empty_and_null(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "Hello world's  end\n")], "id int, text string")
    out = {r.id: (r.ws, r.pt) for r in df.select("id", K.count_tokens("text", "whitespace").alias("ws"),
                                                  K.count_tokens("text", "pretoken").alias("pt")).collect()}
    assert out[1] == (0, 0) and out[2] == (0, 0)
    assert out[3][0] == 3


def test_pretokens_match_python_regex(spark):
    import regex
    pat = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    texts = ["It's 2024, naïve  café!\n\n  x", "tabs\tand em-space 12ab", "  lead and trail  "]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r.t for r in df.select(K.pretokens("text").alias("t")).collect()]
    assert got == [regex.findall(pat, t) for t in texts]


TEXT = "\n".join(" ".join(f"w{i}_{j}" for j in range(n)) for i, n in enumerate([3, 45, 0, 12, 7, 90, 1]))


def _chunks(spark, **kw):
    df = spark.createDataFrame([(1, TEXT)], "doc_id long, text string")
    return CH.chunk_documents(df, **kw).orderBy("part_no").collect()


def test_chunks_without_overlap_concatenate_back(spark):
    rows = _chunks(spark, max_tokens_per_line=10, max_tokens_per_paragraph=30, overlap_tokens=0)
    words = re.findall(r"\S+", TEXT)
    assert re.findall(r"\S+", " ".join(r.text for r in rows)) == words
    assert all(r.n_tokens <= 30 for r in rows)


def test_overlap_stays_within_budget(spark):
    rows = _chunks(spark, max_tokens_per_line=10, max_tokens_per_paragraph=30, overlap_tokens=10)
    assert all(r.n_tokens <= 30 for r in rows)
    for prev, cur in zip(rows, rows[1:]):
        first_line = cur.text.split("\n")[0]
        assert first_line in prev.text.split("\n") or cur.n_lines == len(cur.text.split("\n"))


def test_single_long_word_stays_whole_in_pretoken_mode(spark):
    df = spark.createDataFrame([(1, "a " + "x" * 50 + "!" * 30 + " b")], "doc_id long, text string")
    lines = CH.split_lines(df, max_tokens_per_line=1, mode="pretoken").collect()
    assert [r.line for r in lines][1] == "x" * 50 + "!" * 30


def test_markdown_headings_and_fences(spark):
    md = "# Title\nintro words here\n## Part\n```\ncode a b c d e f\nmore code\n```\ntail"
    df = spark.createDataFrame([(1, md)], "doc_id long, text string")
    rows = CH.chunk_documents(df, max_tokens_per_line=3, max_tokens_per_paragraph=100, overlap_tokens=0,
                              markdown=True).orderBy("part_no").collect()
    assert rows[0].text.startswith("# Title") and rows[1].text.startswith("## Part")
    assert "```\ncode a b c d e f\nmore code\n```" in rows[1].text


def test_limits_validated(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    with pytest.raises(ValueError):
        CH.chunk_documents(df, max_tokens_per_line=0, max_tokens_per_paragraph=10)
    with pytest.raises(ValueError):
        CH.chunk_documents(df, max_tokens_per_line=5, max_tokens_per_paragraph=10, overlap_tokens=10)


def test_empty_documents_have_no_chunks(spark):
    df = spark.createDataFrame([(1, ""), (2, "  \n \t ")], "doc_id long, text string")
    assert CH.chunk_documents(df, max_tokens_per_line=5, max_tokens_per_paragraph=10).count() == 0


def test_udf_packer_equals_fold(spark):
    from memweave.sources.tables import load
    docs = load(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    md = spark.createDataFrame([(1, "# A\nx y z\n## B\n```\ncode here\n```\nw v")], "doc_id long, text string")
    for d, kw in ((docs, {}), (md, {"markdown": True})):
        for overlap in (0, 7):
            args = dict(max_tokens_per_line=9, max_tokens_per_paragraph=30, overlap_tokens=overlap, **kw)
            a = sorted(map(tuple, CH.chunk_documents(d, **args).collect()))
            b = sorted(map(tuple, CH.chunk_documents(d, packer="udf", **args).collect()))
            assert a == b and len(a) > 0


def test_chunking_properties_random_texts(spark):
    """Random texts: both packers agree, words survive in order, budgets hold."""
    hyp = pytest.importorskip("hypothesis")
    st = pytest.importorskip("hypothesis.strategies")
    word = st.text(alphabet="abcxyz", min_size=1, max_size=6)
    line = st.lists(word, min_size=0, max_size=30).map(" ".join)
    texts = st.lists(line, min_size=1, max_size=12).map("\n".join)

    @hyp.settings(max_examples=8, deadline=None, derandomize=True)
    @hyp.given(st.lists(texts, min_size=1, max_size=4))
    def check(docs):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id long, text string")
        args = dict(max_tokens_per_line=5, max_tokens_per_paragraph=12, overlap_tokens=0)
        fold = sorted(map(tuple, CH.chunk_documents(df, **args).collect()))
        udf = sorted(map(tuple, CH.chunk_documents(df, packer="udf", **args).collect()))
        assert fold == udf
        for i, t in enumerate(docs):
            parts = [r for r in fold if r[0] == i]
            assert re.findall(r"\S+", " ".join(r[2] for r in parts)) == re.findall(r"\S+", t)
            assert all(r[3] <= 12 for r in parts)

    check()
