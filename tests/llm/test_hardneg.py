import random

import duckdb
from pyspark.sql import functions as F

from memweave.llm.hardneg import mine
from memweave.llm.queries import QUERIES, SQL
from tests.llm.helpers import SF

SCHEMA = "vec_id long, embedding array<double>, label int, score string, id string, rank int"


def brute(rows, positives=5, negatives=3, low=50, high=95):
    import math

    table = {}
    for vec_id, v, label, *_ in rows:
        if vec_id is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        key = (label, [math.floor(256 * x) for x in v])
        table[vec_id] = min(table.get(vec_id, key), key)
    out = []
    for a, (label, v) in table.items():
        if a % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, own) for i, (own, w) in table.items() if i != a and len(w) == len(v))
        for ps, p, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [(s, i) for s, i, own in scored if own != label and low * -ps <= 100 * -s <= high * -ps]
            out += [(a, p, k + 1, i, -ps, -s) for k, (s, i) in enumerate(fit[:negatives])]
    return sorted(out)


def check(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y", 0) for r in rows], SCHEMA)
    got = mine(df, F.col("vec_id") % 50 == 0, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def vectors(seed, n, dims, labels, spread=1.0):
    rng = random.Random(seed)
    return [(k, [rng.gauss(0.2, spread) for _ in range(dims)], rng.randrange(labels)) for k in range(n)]


def test_random_vectors_in_many_blocks(spark):
    check(spark, vectors(1, 600, 6, 4), candidates=70, block=3)


def test_one_block(spark):
    check(spark, vectors(2, 300, 16, 3))


def test_ties_repeats_and_a_third_with_one_vector(spark):
    rng = random.Random(3)
    rows = [(k, [rng.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(3)], rng.randrange(3)) for k in range(400)]
    rows += [(1000 + k, [0.5, 0.5, 0.5], k % 2) for k in range(200)]
    check(spark, rows + rows[:100], candidates=64, block=4)


def test_awkward_rows(spark):
    rng = random.Random(4)
    good = vectors(5, 120, 4, 2)
    nan, inf = float("nan"), float("inf")
    odd = [(None, [1.0] * 4, 1), (200, None, 1), (250, [1.0, None, 1.0, 1.0], 0), (300, [nan, 1.0, 1.0, 1.0], 0), (350, [inf, 0.0, 0.0, 0.0], 1),
           (400, [-inf] * 4, 1), (450, [1.0] * 4, None), (500, [], 0), (550, [], 1), (600, [1.0, 2.0], 0), (601, [1.0, 1.5], 0), (602, [1.0, 1.0], 1),
           (650, [0.0] * 4, 0), (700, [1.0] * 4, 1), (700, [0.5] * 4, 0), (700, [1.0] * 4, 1)]
    rows = good + odd
    rng.shuffle(rows)
    check(spark, rows, candidates=30, block=2)


def test_negative_scores_give_empty_windows(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [-1.0, 0.0], 0), (2, [-0.7, 0.0], 1), (50, [0.0, 0.0], 0), (3, [0.0, 1.0], 1)]
    check(spark, rows)


def test_large_numbers_stay_exact(spark):
    rng = random.Random(6)
    check(spark, [(k, [rng.uniform(-2e6, 2e6) for _ in range(5)], k % 3) for k in range(200)], candidates=50)


def test_no_anchor_and_empty_table(spark):
    check(spark, [(7, [1.0], 0), (8, [1.0], 1)])
    check(spark, [])


def test_text_labels(spark):
    rows = vectors(8, 150, 3, 2)
    df = spark.createDataFrame([(i, v, f"l{x}") for i, v, x in rows], "vec_id long, embedding array<float>, label string")
    assert mine(df, F.col("vec_id") % 50 == 0).count() > 0


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    got = QUERIES["op11_threshold_hard_negatives"](spark, SF)
    want = con.sql(SQL["op11_threshold_hard_negatives"])
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
