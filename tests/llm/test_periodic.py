import hashlib
import random
import zlib

from pyspark.sql import functions as F

from memweave.llm.periodic import find_runs
from memweave.llm.queries import QUERIES
from memweave.sources.tables import load
from tests.llm.helpers import SF, WORD, awkward, nothing


def brute_runs(w, min_words=12):
    """(start, length, period) of all runs by walking every period over the whole text."""
    seen = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > s and i + q - s >= max(min_words, 2 * q):
                seen.setdefault((s, i + q), q)
            i += i == s
    return sorted(((s, e - s, q) for (s, e), q in seen.items()), key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def check(rows, min_words=12):
    for r in rows:
        w = WORD.findall(r.text or "")
        runs = brute_runs(w, min_words)
        assert [(x.start, x.length, x.period) for x in r.runs] == runs
        assert r.n_words == len(w) and r.collapsed == collapsed(w, runs)


def texts(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        size, kinds = rng.choice([0, 1, 2, 11, 12, 13, 40, 150, 400]), rng.choice([1, 2, 3, 40])
        t = [f"{chr(97 + rng.randrange(26))}é{x}" for x in [rng.randrange(kinds) for _ in range(size)]] if kinds > 3 else [rng.choice("xyz"[:kinds]) for _ in range(size)]
        if size and rng.random() < 0.5:
            a, p = rng.randrange(size), rng.randint(1, max(1, size // 3))
            t = [t[i] if i < a else t[a + (i - a) % p] for i in range(size)]
        yield rng.choice([" ", "\n", "\t "]).join(t)


def test_random_texts_match_brute_force(spark):
    rows = [(k, t) for k, t in enumerate(texts(5, 400))]
    check(find_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_short_runs_with_another_floor(spark):
    rows = [(k, t) for k, t in enumerate(texts(6, 60))]
    check(find_runs(spark.createDataFrame(rows, "doc_id long, text string"), min_words=2).collect(), 2)


def test_whole_text_of_one_word_and_long_periods(spark):
    rng = random.Random(2)
    body = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    rows = [(1, "a " * 5000), (2, " ".join(body + body)), (3, " ".join(body + body[:2999])), (4, " ".join(body[:5] * 900 + body + body[:5] * 2))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [(x.start, x.length, x.period) for x in r.runs] for r in find_runs(df).collect()}
    assert got[1] == [(0, 5000, 1)] and got[2] == [(0, 6000, 3000)] and got[3] == []
    assert got[4][0] == (0, 4505, 5)


def test_awkward_rows(spark):
    df = awkward(spark)
    rows = find_runs(df).collect()
    assert len(rows) == df.count()
    check([r for r in rows if r.doc_id != 30])
    assert {"id", "kept", "score"} <= set(find_runs(df).columns)


def test_empty_table(spark):
    assert find_runs(nothing(spark)).count() == 0


def test_query_matches_brute_force(spark):
    got = {r.doc_id: r for r in QUERIES["op12_difference_cover_runs"](spark, SF).collect()}
    docs = load(spark, SF, "documents").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    changed = 0
    for doc_id, text in docs:
        w = WORD.findall(text or "")
        n, h = len(w), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            changed += 1
        runs, r = brute_runs(w), got[doc_id]
        top = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want = (n, len(runs), *top, 1000 * top[1] // top[2] if runs else None, sha("".join(f"{s},{x},{q}\n" for s, x, q in runs)), sha(collapsed(w, runs)))
        assert (r.n_words, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == want
    assert changed > 5


def test_query_leaves_texts_without_id_as_they_are(spark):
    from memweave.llm.queries import periodic_copy

    df = awkward(spark, clash=False)
    rows = df.select("doc_id", "text", periodic_copy(F.col("text"), F.col("doc_id")).alias("t")).collect()
    assert all(r.t == r.text for r in rows if r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 10)
