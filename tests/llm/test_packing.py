import itertools
import random
from collections import Counter

from pyspark.sql import functions as F

from memweave.llm.packing import EXACT, PER_DOUBLING, best_bounds, cell, pack
from memweave.sources.tables import load
from tests.llm.helpers import SF, WORD, awkward, nothing


def padding(cells, bounds):
    return sum(min(b for b in bounds if b >= longest) * n - tokens for longest, n, tokens in cells)


def test_bounds_are_optimal():
    rng = random.Random(1)
    for _ in range(30):
        lengths = sorted(rng.sample(range(60), rng.randint(1, 9)))
        cells = [(x, n := rng.randint(1, 20), x * n) for x in lengths]
        for k in (1, 2, 3, 4):
            best = min(padding(cells, (*c, lengths[-1])) for m in range(min(k, len(lengths))) for c in itertools.combinations(lengths[:-1], m))
            bounds = best_bounds(cells, k)
            assert len(bounds) <= k and bounds[-1] == lengths[-1] and padding(cells, bounds) == best


def test_cells_bound_the_histogram(spark):
    rng = random.Random(2)
    values = [0, 1, 1023, 1024, 1025, 2047, 2048] + [rng.randrange(1, 2**40) for _ in range(300)]
    rows = spark.createDataFrame([(v,) for v in values], "n long").select("n", cell(F.col("n")).alias("c")).collect()
    for r in rows:
        assert r.c <= r.n and (r.c == r.n if r.n < EXACT else r.n - r.c < r.n * 2 / PER_DOUBLING)


def brute(rows, buckets, budget):
    """All places from the rule: sort, cut at the bounds, cut again into batches."""
    rows = sorted(rows, key=lambda r: (r[1], r[0] is not None, r[0] or 0))
    exact = [(n, k, n * k) for n, k in sorted(Counter(n for _, n in rows).items())]
    bounds, out, count = best_bounds(exact, buckets), [], {}
    for i, n in rows:
        b = next(k for k, x in enumerate(bounds) if n <= x)
        at = count[b] = count.get(b, -1) + 1
        size = max(1, budget // max(bounds[b], 1))
        out.append((i, n, b, bounds[b], at // size, at % size))
    return sorted(out, key=str)


def test_places_match_brute_force(spark):
    for df in (load(spark, SF, "documents").filter("length(text) < 5000"), awkward(spark).filter("doc_id < 30 or doc_id is null")):
        rows = [(r.doc_id, len(WORD.findall(r.text or ""))) for r in df.collect()]
        got = [tuple(r) for r in pack(df, buckets=5, token_budget=900).collect()]
        assert sorted(got, key=str) == brute(rows, 5, 900)


def test_batches_keep_the_budget(spark):
    got = pack(awkward(spark), token_budget=4000).groupBy("bucket", "batch").agg(F.count("*").alias("n"), F.max("bucket_len").alias("len")).collect()
    assert all(r.n * r.len <= 4000 or r.n == 1 for r in got)


def test_empty_table(spark):
    assert pack(nothing(spark)).count() == 0
