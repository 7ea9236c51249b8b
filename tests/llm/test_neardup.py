import math
import random

import numpy as np

from memweave.llm.components import connected_components
from memweave.llm.neardup import group_near_duplicates, super_minhash
from memweave.sources.tables import load
from tests.llm.helpers import LOWER, SF, WORD, awkward, nothing, sentence


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows, percent):
    sets = {i: shingle_set(t) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(i for i in sets if sets[i])
    for a in ids:
        for b in ids:
            if a < b:
                inter = len(sets[a] & sets[b])
                if 100 * inter >= percent * (len(sets[a]) + len(sets[b]) - inter):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def check(spark, df, percent):
    rows = df.select("doc_id", "text").collect()
    want, sizes = brute([(r.doc_id, r.text) for r in rows], percent)
    got = group_near_duplicates(df, percent=percent).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.id is None:
            assert r.component is None
        else:
            assert (r.component, r.n_shingles) == (want[r.id], sizes[r.id])


def test_table_matches_brute_force(spark):
    check(spark, load(spark, SF, "documents"), 85)


def test_awkward_rows(spark):
    check(spark, awkward(spark), 85)


def test_empty_table(spark):
    assert group_near_duplicates(nothing(spark)).count() == 0


def test_chains_and_edits_around_the_threshold(spark):
    rng, rows = random.Random(5), []
    for g in range(12):
        words = sentence(rng, 60).split()
        for k in range(8):  # each copy changes words of the one before, so links form chains
            rows.append((g * 10 + k, " ".join(words)))
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    rng.shuffle(rows)
    check(spark, spark.createDataFrame(rows, "doc_id long, text string"), 80)


def test_large_groups_around_one_text(spark):
    """Copies of one text with few edits: many members sit in one bucket without being similar to its pivot."""
    rng = random.Random(9)
    base = sentence(rng, 90).split()
    rows = []
    for k in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    check(spark, spark.createDataFrame(rows, "doc_id long, text string"), 85)


def test_super_minhash_estimates_jaccard():
    rng = np.random.default_rng(1)
    for shared in (0.3, 0.6, 0.9):
        n, slots = 400, 256
        k = int(round(2 * n * shared / (1 + shared)))
        pool = rng.integers(0, 2**63, 2 * n, dtype=np.uint64)
        a, b = pool[:n], np.concatenate([pool[:k], pool[n:2 * n - k]])
        row, key = np.repeat([0, 1], n), np.concatenate([a, b])
        sig = super_minhash(row, key, 2, slots)
        assert abs((sig[0] == sig[1]).mean() - k / (2 * n - k)) < 4 * math.sqrt(0.25 / slots)


def test_super_minhash_slots_are_permutations():
    """A set of one element offers every slot once: each step lies in one slot."""
    sig = super_minhash(np.array([0]), np.array([12345], np.uint64), 1, 140)
    assert sorted((sig[0] >> np.uint64(48)).tolist()) == list(range(140))


def test_components_of_long_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(1, 200)] + [(5000, 5000), (None, 3), (7, 7)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(links, "u long, v long").repartition(7)).collect())
    assert all(got[k] == 0 for k in range(301)) and all(got[1000 + k] == 1000 for k in range(200)) and 5000 not in got


def test_one_id_with_several_texts_is_one_document(spark):
    words = [[f"{side}{k}" for k in range(200)] for side in "abc"]
    text = [" ".join(w) for w in words]
    near = [" ".join(w[:-1] + ["other"]) for w in words]
    # 5 holds a, b and c; 9, 3 and 12 are like one each; 1 and 20 equal one; 30 stays alone
    rows = [(5, text[0]), (5, text[1]), (5, text[2]), (9, near[0]), (3, near[1]), (12, near[2]), (1, text[1]), (20, text[2]), (30, "quite other words in here"), (30, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = group_near_duplicates(docs, percent=85).collect()
    assert sorted((r.id, r.component) for r in got) == sorted((i, 30 if i == 30 else 1) for i, _ in rows)
    assert sorted(r.n_shingles for r in got if r.id == 30) == [0, 1]
