import collections

import pytest

from memweave.llm.linerules import clean_lines
from memweave.sources.tables import load
from tests.llm.helpers import SF, WORD, awkward, nothing


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    seen = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    cover = {j for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    base = len(w) < 10 or 100 * len(cover) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover), base)


def check(rows):
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == brute(r.text)
        assert not (r.base_failed and r.kept)


def test_base_counts_match_brute_force(spark):
    check(clean_lines(load(spark, SF, "documents")).collect())


def test_awkward_rows(spark):
    df = awkward(spark)
    rows = clean_lines(df).collect()
    assert len(rows) == df.count()
    check(rows)
    assert not any(r.kept for r in rows if not WORD.search(r.text or ""))


def test_empty_table(spark):
    assert clean_lines(nothing(spark)).count() == 0


@pytest.mark.parametrize("bad", [
    "Home | News | Sport | Weather | Contact | About | Login",
    "no mark anywhere in this long line of many plain words that never ends",
    "All rights reserved. Some Company of the wide world, since the year ninety.",
    "x*** y*** z### w$$$ v&&& u%%% t*** s### r$$$ q&&&.",
    "SHOUT!! IT!! ALL!! OUT!! THESE!! ARE!! THE!! THINGS!!",
])
def test_rules_remove_lines_and_text_loss_rejects(spark, bad):
    good = ("This is a plain sentence with enough words to stand. Another one follows, and it is fine as well.\n"
            "Here is a second line that reads like prose and ends with a mark. Nothing in it should trip a rule at all.")
    rows = spark.createDataFrame([(1, good), (2, good + "\n" + bad), (3, bad + "\n" + bad.replace("s", "z"))], "doc_id long, text string")
    got = {r.doc_id: r for r in clean_lines(rows, with_text=True).collect()}
    assert got[1].kept and got[1].clean_text == good and got[1].n_failed_lines == 0
    assert got[2].n_failed_lines == 1 and got[2].kept and got[2].clean_text == good
    assert not got[3].kept


def test_clean_documents_stay(spark):
    docs = clean_lines(load(spark, SF, "documents"), keep=["doc_id"]).join(load(spark, SF, "labels"), "doc_id")
    rows = docs.filter("not base_failed").collect()
    good = [r for r in rows if r.quality == 1]
    junk = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(not r.kept for r in junk) >= 0.9 * len(junk)
