import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from memweave.llm.bestfit import best_fit_decreasing, encoder, lower_bound, pack, pieces
from memweave.llm.bpecount import read_vocabulary
from memweave.llm.queries import QUERIES
from memweave.sources.tables import load
from tests.llm.helpers import SF, awkward, nothing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def own_ids(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


def check_layout(rows, capacity):
    """Sequences are gapless from 0 and within the capacity; returns their number."""
    seq = defaultdict(list)
    for r in rows:
        seq[r.sequence_id].append((r.offset, r.length))
    for spans in seq.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seq)


def check_pieces(rows, docs, capacity=1024):
    """Every document's ids come back whole from its pieces."""
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for doc_id, text in docs:
        ids = own_ids(text)
        got = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in got] == list(range(-(-len(ids) // capacity)))
        assert sum(r.length for r in got) == len(ids) and all(r.length == capacity for r in got[1:])
        for r in got:
            part = np.array(ids[r.start:r.start + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)


def test_query_on_the_small_table(spark):
    rows = QUERIES["op13_bound_certified_packing"](spark, SF).collect()
    docs = [tuple(r) for r in load(spark, SF, "documents").select("doc_id", "text").collect()]
    check_pieces(rows, docs)
    used = check_layout(rows, 1024)
    counts = np.bincount([r.length for r in rows if r.length < 1024], minlength=1025)
    bound = lower_bound(counts) + sum(r.length == 1024 for r in rows)
    assert bound <= used <= bound + 1


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_equal_the_library(text):
    assert encoder(read_vocabulary(PATH))(text).tolist() == own_ids(text)[:-1]


@pytest.mark.parametrize("text", ["<|endoftext|>", "a<|endoftext|> b", "<|endoftext|><|endoftext|>x", " \n\n  \t x", "a" * 5000, "é🙂\x00́", "don't we'll I'M", "１２３ 12 ½"])
def test_odd_strings(text):
    assert encoder(read_vocabulary(PATH))(text).tolist() == own_ids(text)[:-1]


def test_other_vocabulary_goes_through_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    text = "Some Words, <|endoftext|> and more"
    assert encoder(read_vocabulary(path))(text).tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def optimum(sizes, capacity):
    """Fewest sequences, by trying ever more of them."""
    sizes = sorted(sizes, reverse=True)

    def fits(k, rooms):
        if k == len(sizes):
            return True
        for j in {r: j for j, r in enumerate(rooms) if r >= sizes[k]}.values():
            if fits(k + 1, rooms[:j] + [rooms[j] - sizes[k]] + rooms[j + 1:]):
                return True
        return False

    return next(n for n in itertools.count() if fits(0, [capacity] * n))


def test_bound_never_passes_the_optimum():
    rng = random.Random(1)
    tight = 0
    for _ in range(300):
        capacity = rng.choice([7, 10, 12, 30])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 9))]
        bound, best = lower_bound(np.bincount(sizes, minlength=capacity + 1)), optimum(sizes, capacity)
        place, offset, bins = best_fit_decreasing(np.array(sizes, np.int64), capacity)
        assert bound <= best <= bins
        tight += bound == best
    assert tight > 250


def test_many_groups_exchange_and_improve(spark):
    rng = random.Random(4)
    rows = spark.createDataFrame([(k, rng.randint(150, 700)) for k in range(4000)], "k long, length long")
    single = pack(rows, group_items=100, rounds=0)
    packed = pack(rows, group_items=100)
    got = packed.rows.collect()
    assert sorted(r.k for r in got) == list(range(4000))
    assert check_layout(got, 1024) == packed.sequences
    assert packed.bound <= packed.sequences < single.sequences
    assert check_layout(single.rows.collect(), 1024) == single.sequences


def test_odd_lengths_and_extra_columns(spark):
    rows = spark.createDataFrame([(None, None, "a"), (1, 0, "b"), (1, 10, "c"), (1, 10, "c"), (2, 6, "d"), (3, 4, "e")], "offset long, size long, _bf string")
    packed = pack(rows, capacity=10, length_col="size")
    got = packed.rows.withColumnRenamed("size", "length").na.fill(0, ["length"]).collect()
    assert check_layout(got, 10) == packed.sequences == packed.bound == 3 and len(got) == 6
    with pytest.raises(Exception, match="longer than the capacity"):
        pack(rows, capacity=9, length_col="size")


def test_awkward_rows(spark):
    df = awkward(spark)
    cut = pieces(df, PATH, capacity=64)
    assert set(cut.columns) == (set(df.columns) - {"text"}) | {"piece", "start", "length", "ids"}
    packed = pack(cut, capacity=64)
    rows = packed.rows.collect()
    check_layout(rows, 64)
    assert sum(r.length for r in rows) == sum(len(own_ids(r.text)) for r in df.select("text").collect())


def test_empty_table(spark):
    packed = pack(pieces(nothing(spark), PATH))
    assert packed.rows.count() == packed.sequences == packed.bound == 0
