import random

import numpy as np

from memweave.llm import linededup
from memweave.llm.linededup import drop_repeated_lines, within_edits
from memweave.sources.tables import load
from tests.llm.helpers import LOWER, SF, WORD, awkward, nothing, sentence


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
    return row[-1]


def matches(v, w, near_words, edit_percent):
    """The stated rule, for different lines."""
    short = min(len(v), len(w))
    bound = max(1, short * edit_percent // 100)
    if short < near_words or abs(len(v) - len(w)) > bound:
        return False
    # far apart in what they hold is far apart in edits, which spares most of the table
    if len(set(v) ^ set(w)) > 2 * bound:
        return False
    return distance(v, w) <= bound


def brute(rows, near_words=10, edit_percent=5):
    """Removed line numbers by (id, text), by comparing every line with all at earlier places."""
    lines = sorted({(i, no, tuple(WORD.findall(x.translate(LOWER))), t) for i, t in rows if i is not None and t is not None
                    for no, x in enumerate(t.split("\n"))})
    gone, seen = {}, {}
    for i, no, w, t in lines:
        if not w:
            continue
        if any(at < (i, no) and (v == w or matches(v, w, near_words, edit_percent)) for v, at in seen.items()):
            gone.setdefault((i, t), set()).add(no)
        seen.setdefault(w, (i, no))
    return gone


def check(df, **options):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    gone = brute(rows, **options)
    got = drop_repeated_lines(df, **options).collect()
    want = []
    for i, t in rows:
        out = gone.get((i, t), set())
        want.append((i, None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in out), len(out)))
    key = lambda x: (x[0] is None, x[0] or 0, x[1] or "", x[2])
    assert sorted(((r.doc_id, r.text, r.n_removed) for r in got), key=key) == sorted(want, key=key)


def test_awkward_rows(spark):
    check(awkward(spark))


def test_small_table(spark):
    check(load(spark, SF, "documents").filter("length(text) < 3000"))


def test_empty_table(spark):
    assert drop_repeated_lines(nothing(spark)).count() == 0


def test_one_word_edits(spark):
    rng = random.Random(2)
    base = [sentence(rng, n).split() for n in (9, 10, 10, 11, 12, 30)]
    rows = []
    for d in range(40):
        lines = []
        for w in base:
            w = list(w)
            for _ in range(rng.choice([0, 1, 1, 2])):
                k = rng.randrange(len(w))
                kind = rng.random()
                if kind < 0.4:
                    w[k] = f"x{rng.randrange(50)}"
                elif kind < 0.7:
                    w.insert(k, f"y{rng.randrange(50)}")
                else:
                    del w[k]
            lines.append("  ".join(w))
        rows.append((d, "\n".join(lines)))
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_equal_lines_have_no_word_floor(spark):
    page = "Title\nA first line that is long enough to count here.\nBy me\n日本語の文には空白がない。\n\n* * *\nThe end."
    rows = [(1, page), (2, page), (3, page + "\nthe END.\nown words"), (4, None), (None, page)]
    got = {r.doc_id: (r.text, r.n_removed) for r in drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (page, 0), 2: ("", 6), 3: ("\nown words", 7), 4: (None, 0), None: (page, 0)}


def test_small_table_with_longer_texts_and_other_bounds(spark):
    docs = load(spark, SF, "documents").filter("length(text) between 2000 and 3500")
    check(docs)
    check(docs, edit_percent=0)
    check(docs, near_words=20, edit_percent=10)


def test_two_texts_under_one_id(spark):
    rng = random.Random(9)
    a, b, c = (sentence(rng, 14) for _ in range(3))
    long = [sentence(rng, 50) for _ in range(3)]
    rows = [(5, f"{a}\n{b}\nx"), (5, f"{c}\n{a}"), (5, "\n".join(["q", *long, b])), (5, f"{a}\n{b}\nx"),
            (7, f"{c} more\n{long[1]} and two"), (7, "own words only"), (7, long[2].replace(" ", " extra ", 1)), (None, a), (None, b)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(df)


def test_phrase_shared_by_many_long_lines(spark):
    rng = random.Random(11)
    phrase = sentence(rng, 26)
    rows = []
    for k in range(60):
        base = [*sentence(rng, rng.randrange(8, 30)).split(), *phrase.split(), *sentence(rng, rng.randrange(8, 30)).split()]
        for _ in range(2):
            w = list(base)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(999)}"
            rows.append((len(rows), " ".join(w)))
    rng.shuffle(rows)
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_within_edits():
    rng = random.Random(5)
    for _ in range(2000):
        a, b = ([rng.randrange(3) for _ in range(rng.randrange(9))] for _ in range(2))
        for k in range(6):
            assert within_edits(a, b, k) == (distance(a, b) <= k)


def test_bound_grows_with_the_line(spark):
    rng = random.Random(6)
    passage = sentence(rng, 30)
    rows = []
    for n in (39, 40, 59, 60, 100, 173, 300):
        base = sentence(rng, n).split()
        for d in range(12):
            w = list(base)
            for _ in range(rng.randrange(2 + n // 16)):
                k = rng.randrange(len(w))
                w[k:k + rng.randrange(2)] = [f"x{rng.randrange(999)}"] * rng.randrange(2)
            rows.append((len(rows), " ".join(w)))
    rows += [(len(rows) + k, sentence(rng, k) + " " + passage + " " + sentence(rng, 30 - k)) for k in range(1, 30)]
    rng.shuffle(rows)
    want = {i for i, _ in brute(rows)}
    got = {r.doc_id for r in drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).filter("n_removed > 0").collect()}
    old = {r.doc_id for r in drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), edit_percent=0).filter("n_removed > 0").collect()}
    assert got == want and old < want


def test_large_group_of_near_copies(spark):
    rng = random.Random(13)
    base = sentence(rng, 90).split()
    rows = []
    for k in range(70):
        w = list(base)
        for _ in range(rng.randrange(7)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(40)}"
        rows.append((k, " ".join(w)))
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_long_lines_of_few_words(spark):
    rng = random.Random(17)
    rows = []
    for k in range(90):
        kinds = rng.choice([1, 2, 3, 5])
        w = [f"v{j % kinds}" for j in range(rng.randrange(40, 70))]
        for _ in range(rng.randrange(6)):
            at = rng.randrange(len(w))
            w[at:at + rng.randrange(2)] = [f"v{rng.randrange(8)}"] * rng.randrange(2)
        rows.append((k, " ".join(w)))
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_lines_that_repeat_one_passage(spark):
    """Lines of few different words hold one mark at many places; each pair of them still counts once and no match is lost."""
    rng = random.Random(12)
    rows = []
    for k in range(60):
        words = (["over", "and", "again"] * 40)[:100 + rng.randrange(3)]
        for _ in range(rng.choice([0, 2, 4, 7, 12])):
            words[rng.randrange(len(words))] = rng.choice(["over", "and", f"word{k}"])
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    gone = brute(rows)
    got = {r.doc_id: r.n_removed for r in drop_repeated_lines(docs).collect() if r.n_removed}
    assert 0 < len(gone) < 60 and got == {i: len(v) for (i, _), v in gone.items()}


def test_pairs_are_verified_together(monkeypatch):
    """Pairs of all lengths and bounds in one batch, in blocks of any size, get the verdict of the edit distance."""
    rng = random.Random(21)
    pack = lambda lists: (np.cumsum([0, *map(len, lists)]).astype(np.int32), np.array([x for a in lists for x in a], np.int64))
    left, right = [], []
    for _ in range(400):
        a = [rng.randrange(rng.choice([2, 50])) for _ in range(rng.randrange(1, 90))]
        b = list(a)
        for _ in range(rng.randrange(8)):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randrange(2)] = [rng.randrange(50)] * rng.randrange(2)
        left.append(a)
        right.append(b)
    for percent in (0, 5, 30):
        want = [distance(a, b) <= max(1, min(len(a), len(b)) * percent // 100) for a, b in zip(left, right)]
        for cells in (1, 300, 1 << 17):
            monkeypatch.setattr(linededup, "CELLS", cells)
            assert linededup._pairs_within(pack(left), pack(right), percent).tolist() == want


def test_texts_are_read_once_for_the_words_of_all_steps(spark, monkeypatch):
    """One pass over the texts serves the halves, the classes and the marks; rows that repeat an id and a text change nothing."""
    rng = random.Random(22)
    rows = []
    for n, words in ((12, 30), (60, 30), (60, 2), (60, 30), (200, 3)):
        base = [f"w{rng.randrange(words)}" for _ in range(n)]
        for _ in range(30):
            w = list(base)
            for _ in range(rng.randrange(5)):
                w[rng.randrange(n)] = f"x{rng.randrange(40)}"
            rows.append((len(rows), " ".join(w)))
    rows += rows[::7]
    written = []
    plain = linededup.materialize
    monkeypatch.setattr(linededup, "materialize", lambda df, name="table", *args, **options: written.append(name) or plain(df, name, *args, **options))
    check(spark.createDataFrame(rows, "doc_id long, text string"))
    assert written.count("wanted") == 1


def test_texts_go_to_python_by_the_line(spark, monkeypatch):
    """No Arrow batch holds whole texts: lines go to Python, wanted lines for their words, and what is left of a text is joined in Spark."""
    rng = random.Random(23)
    base = [sentence(rng, n) for n in (3, 12, 45, 80)]
    rows = [(k, "\n".join(rng.sample([*base, "", " ", f"own {k}", base[k % 4].replace(" ", f" x{k} ", 1)], 8))) for k in range(30)]
    rows += [(100, "\n"), (101, "\n\na\r\n\n"), (102, "\x00é\n🙂\n"), (103, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    plans = []
    plain = linededup.materialize
    monkeypatch.setattr(linededup, "materialize", lambda d, *args, **options: plans.append(d) or plain(d, *args, **options))
    got = drop_repeated_lines(df)
    node = lambda d: str(d._jdf.queryExecution().optimizedPlan())
    assert "MapInArrow" not in node(got)
    assert sum("MapInArrow" in node(d) and ("split(" in node(d)) for d in plans) == 2  # the lines, and the words of some of them
    check(df)
