import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from memweave.llm.bpecount import Counter, Vocabulary, count_tokens, merged_length, read_vocabulary
from memweave.sources.tables import load
from tests.llm.helpers import SF, awkward, nothing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return Counter(Vocabulary(read_vocabulary(PATH)))


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=60) | st.text(alphabet=" \n\t'sabtheing<|endoftext|>9é🙂", max_size=60))
def test_any_text_counts_like_the_library(library, counter, text):
    assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_special_strings_count_once(library, counter):
    text = "a<|endoftext|><|endoftext|> b<|endoftext|"
    assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_heap_follows_rank_then_position():
    v = Vocabulary('{"model": {"merges": [["b", "c"], ["a", "b"], ["a", "bc"], ["a", "a"]]}}')
    assert merged_length(b"abc", v) == 1     # bc first, then a+bc
    assert merged_length(b"aaa", v) == 2     # leftmost pair of equal rank
    assert merged_length(b"abab", v) == 2
    assert merged_length(b"", v) == 0


def test_table_and_awkward_rows(spark, library):
    for df in (load(spark, SF, "documents"), awkward(spark)):
        rows = count_tokens(df, PATH).collect()
        assert len(rows) == df.count()
        want = [len(e.ids) for e in library.encode_batch([r.text or "" for r in rows], add_special_tokens=False)]
        assert [r.n_tokens for r in rows] == want
        assert all(r.n_bytes == len((r.text or "").encode()) and r.over_limit == (r.n_tokens > 512) for r in rows)


def test_empty_table(spark):
    assert count_tokens(nothing(spark), PATH).count() == 0
