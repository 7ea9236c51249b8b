import collections

import pytest

from memweave.operators import bpe

regex = pytest.importorskip("regex")
tiktoken = pytest.importorskip("tiktoken")

PAT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CORPUS = ("The quick brown fox jumps over the lazy dog. It's the dog's day; they'll see. "
          "Naïve café owners don't care about 12345 numbers or ünïcödé — really! ") * 20


def _learn(n_merges=120):
    """A small merge table learned in the test by pair counting."""
    bc = bpe.bytes_to_unicode()
    words = [[bc[b] for b in t.encode()] for t in regex.findall(PAT, CORPUS)]
    merges = []
    for r in range(n_merges):
        cnt = collections.Counter(p for w in words for p in zip(w, w[1:]))
        if not cnt:
            break
        (a, b), _ = cnt.most_common(1)[0]
        merges.append((r, a, b))
        words = [bpe.merge_pretoken(w, {(a, b): 0}) for w in words]
    return merges


def test_byte_table_rule():
    t = bpe.bytes_to_unicode()
    assert len(t) == 256 and len(set(t.values())) == 256
    assert t[ord("A")] == "A" and t[32] == chr(256 + 32) and t[0] == chr(256)


def test_matches_tiktoken_with_same_ranks():
    merges = _learn()
    vocab = bpe.Vocabulary(merges)
    inv = {c: b for b, c in bpe.bytes_to_unicode().items()}
    ranks = {bytes([b]): b for b in range(256)}
    for r, a, b in merges:
        ranks.setdefault(bytes(inv[c] for c in a + b), 256 + r)
    enc = tiktoken.Encoding(name="test", pat_str=PAT, mergeable_ranks=ranks, special_tokens={})
    sample = "Quick dogs don't jump over 123 lazy foxes; café naïve!\n  Done."
    ours = [i for t in regex.findall(PAT, sample) for i in vocab.encode_pretoken(t)]
    assert ours == enc.encode(sample)


def test_load_merges_and_encode_in_spark(spark, tmp_dir):
    merges = _learn(60)
    path = f"{tmp_dir}/merges.txt"
    with open(path, "w", encoding="utf-8") as f:
        f.write("#version: 0.2\n")
        for i, (_, a, b) in enumerate(merges):
            f.write(f"{a} {b}\n")
            if i == 10:
                f.write("\n")
    table = bpe.load_merges(spark, path)
    got = sorted((r.rank, r.left, r.right) for r in table.collect())
    assert got == merges
    bc = bpe.broadcast_vocabulary(table)
    docs = spark.createDataFrame([(1, "The lazy dog's day."), (2, ""), (3, None)], "id int, text string")
    out = {r.id: (r.ids, r.n) for r in docs.select("id", bpe.encode("text", bc).alias("ids"),
                                                   bpe.count_bpe_tokens("text", bc).alias("n")).collect()}
    vocab = bpe.Vocabulary(merges)
    exp = [i for t in regex.findall(PAT, "The lazy dog's day.") for i in vocab.encode_pretoken(t)]
    assert out[1] == (exp, len(exp)) and out[2] == ([], 0) and out[3] == ([], 0)


def _straight(symbols, ranks):
    """The rule as stated: find the lowest-ranked pair, merge it everywhere from the left, repeat."""
    word = list(symbols)
    while True:
        known = [(ranks[p], p) for p in zip(word, word[1:]) if p in ranks]
        if not known:
            return word
        pair, out, i = min(known)[1], [], 0
        while i < len(word):
            two = tuple(word[i:i + 2]) == pair
            out.append("".join(pair) if two else word[i])
            i += 1 + two
        word = out


def test_heap_merging_follows_the_rule():
    import random
    rng = random.Random(1)
    for _ in range(400):
        syms = ["a", "b", "c"]
        ranks = {}
        for r in range(rng.randrange(1, 12)):
            pair = (rng.choice(syms), rng.choice(syms))
            ranks.setdefault(pair, r)
            syms.append("".join(pair))
        word = [rng.choice("abc") for _ in range(rng.randrange(0, 40))]
        assert bpe.merge_pretoken(word, ranks) == _straight(word, ranks)


def test_long_pretoken_is_not_quadratic():
    vocab = bpe.Vocabulary([(0, "a", "b"), (1, "ab", "ab")])
    assert vocab.encode_pretoken("ab" * 100_000) == [257] * 50_000


def test_two_merge_tables_alike_at_both_ends_in_one_select(spark):
    tables = [[(0, "a", "b"), (1, "c", "d"), (2, "e", "f")], [(0, "a", "b"), (1, "d", "c"), (2, "e", "f")]]
    bcs = [bpe.broadcast_vocabulary(spark.createDataFrame(t, "rank int, left string, right string")) for t in tables]
    row = spark.createDataFrame([("abcdcef",)], "text string").select(*[bpe.encode("text", bc).alias(f"x{k}") for k, bc in enumerate(bcs)]).first()
    assert row.x0 == [256, 257, ord("c"), 258] and row.x1 == [256, ord("c"), 257, 258]


def test_merges_with_unknown_symbols_are_ignored():
    assert bpe.Vocabulary([(0, "a", "b"), (1, "xy", "z"), (2, "ab", "c")]).encode_pretoken("xyzabc") == [120, 121, 122, 258]


def _vocabulary_ranks(merges):
    inv = {c: b for b, c in bpe.bytes_to_unicode().items()}
    ranks = {bytes([b]): b for b in range(256)}
    for r, a, b in merges:
        ranks[bytes(inv[c] for c in a + b)] = 256 + r
    return ranks


def test_vocabulary_size_file_and_encode_query(spark, tmp_dir):
    import hashlib

    from memweave.plans.catalog import load_all
    from memweave.plans.file_queries import vocabulary_merges
    from memweave.sources.tables import load

    merges = [(r.rank, r.left, r.right) for r in vocabulary_merges(spark).orderBy("rank").collect()]
    assert len(merges) == 50_000 and [m[0] for m in merges] == list(range(50_000))
    path = f"{tmp_dir}/merges.txt"
    with open(path, "w", encoding="utf-8") as f:
        f.write("#version: 0.2\n" + "".join(f"{a} {b}\n" for _, a, b in merges))
    assert sorted(tuple(r) for r in bpe.load_merges(spark, path).collect()) == merges
    enc = tiktoken.Encoding(name="vocabulary", pat_str=PAT, mergeable_ranks=_vocabulary_ranks(merges), special_tokens={})
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.n_ids, r.ids_sha256) for r in load_all()["k4_encode"][0](spark, sf).collect()}
    docs = load(spark, sf, "documents").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc_id, text in docs:
        ids = enc.encode_ordinary(text or "")
        assert got[doc_id] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())


def test_batches_are_encoded_in_slices_and_each_different_pretoken_once(spark, monkeypatch):
    import pyarrow as pa

    sizes = []
    rows = [["a"] * (k % 3) if k % 7 else None for k in range(3000)]
    got = bpe._by_slices(lambda some: sizes.append(len(some)) or some.value_lengths().fill_null(0), pa.array(rows, pa.list_(pa.string())), pa.int32())
    assert got.to_pylist() == [len(x or ()) for x in rows] and max(sizes) == bpe.SLICE and sum(sizes) == 3000
    assert len(bpe._by_slices(lambda some: some, pa.array([], pa.int32()), pa.int32())) == 0
    assert bpe._coded(pa.array(["b", "a", "b"]))[0] == ["b", "a"]
    nested = pa.array([[1], None, [], [2, 3]], pa.list_(pa.int32())).slice(1)
    assert bpe._offsets(nested).tolist() == [0, 0, 0, 2]
    table = bpe.broadcast_vocabulary(spark.createDataFrame([(0, "t", "h"), (1, "th", "e")], "rank int, left string, right string"))
    docs = spark.createDataFrame([(0, "the then"), (1, None), (2, ""), (3, "the \u00e9")], "id int, text string").coalesce(1)
    got = {r.id: (r.ids, r.n) for r in docs.select("id", bpe.encode("text", table).alias("ids"), bpe.count_bpe_tokens("text", table).alias("n")).collect()}
    assert got == {0: ([257, 32, 257, 110], 4), 1: ([], 0), 2: ([], 0), 3: ([257, 32, 195, 169], 4)}
