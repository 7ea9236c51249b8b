import random

from memweave.llm.decontaminate import contamination, leaks
from memweave.sources.tables import load
from tests.llm.helpers import SF, awkward, nothing, sentence

ITEM = "John Doe has 3 apples and gives 8 km of rope to Carla. How many apples does John Doe keep after that long day of giving?"
ITEMS = [(7, ITEM), (8, "Was ist das?"), (9, None), (10, ""), (None, "some text of an item without id that is long enough to matter here")]


def frame(spark, rows, name="doc_id"):
    return spark.createDataFrame(rows, f"{name} long, text string")


def found(spark, texts, items=ITEMS, **options):
    rows = contamination(frame(spark, list(enumerate(texts))), frame(spark, items, "item_id"), **options).collect()
    assert len(rows) == len(texts)
    return {r.doc_id: r.item_ids or [] for r in rows}


def test_verbatim_items_in_the_table(spark):
    docs, bench = load(spark, SF, "documents"), load(spark, SF, "benchmark")
    got = {(r.doc_id, i) for r in contamination(docs, bench).collect() for i in r.item_ids or []}
    flat = {r.doc_id: " ".join(r.text.split()) for r in docs.collect()}
    want = {(d, r.item_id) for r in bench.collect() for d, t in flat.items() if " ".join(r.text.split()) in t}
    assert want and got == want


def test_reparameterised_questions(spark):
    texts = [
        "Intro words come here. " + ITEM + " And an end.",
        ITEM.replace("John Doe", "Anna Smith").replace("3", "1,250").replace("8 km", "7 miles").replace("Carla", "Berta"),
        ITEM.upper().lower().replace("john doe", "John Doe").replace("carla", "Carla").replace("how", "How"),
        # slots that change their value along the way are another text
        "Tom Roe has 1 apples and gives 2 km of rope to Paul. Where many apples does Kim Lee keep after that long day of giving?",
        "A clean text that speaks of apples and rope, and of a long day of giving things to others.",
        "John Doe has 3 apples and gives 8 km",
    ]
    got = found(spark, texts, max_conflicts=0.1)
    assert got == {0: [7], 1: [7], 2: [7], 3: [], 4: [], 5: []}


def test_case_and_punctuation_do_not_hide_an_item(spark):
    texts = ["xx " + ITEM.upper() + " yy", ITEM.lower(), "- " + " ** ".join(ITEM.split()), "\n".join(ITEM.replace(",", "").split())]
    assert found(spark, texts) == {0: [7], 1: [7], 2: [7], 3: [7]}


def test_short_items_match_whole(spark):
    got = found(spark, ["Ich frage: Was ist das? Nichts.", "Was ist das", "Was ist denn das?"])
    assert got == {0: [8], 1: [8], 2: []}


def test_shuffled_join_equals_broadcast(spark, monkeypatch):
    docs, bench = load(spark, SF, "documents").filter("length(text) < 4000"), load(spark, SF, "benchmark")
    small = sorted(map(tuple, leaks(docs, bench).collect()))
    monkeypatch.setattr("memweave.llm.decontaminate.BROADCAST_KEYS", 0)
    assert small and sorted(map(tuple, leaks(docs, bench).collect())) == small


def test_placeholders_alone_never_match(spark):
    items = [(1, "Anna Berta Carla Dora Emil Fritz Gustav Hans 1 2 3 4 5 6 7 8")]
    got = found(spark, ["Udo Willi Xaver Yves Zeno Otto Paul Quinn 9 8 7 6 5 4 3 2", "Anna Berta Carla Dora Emil Fritz Gustav Hans 1 2 3 4 5 6 7 8"], items)
    assert got == {0: [], 1: [1]}


def test_awkward_rows_and_empty_tables(spark):
    bench = awkward(spark).select("doc_id", "text", "id", "key").withColumnRenamed("doc_id", "item_id")
    rows = contamination(awkward(spark), bench).collect()
    assert len(rows) == awkward(spark).count()
    assert all(30 in r.item_ids for r in rows if r.doc_id == 30) and all({20, 21, 22} <= set(r.item_ids) for r in rows if r.doc_id in (20, 21, 22))
    assert not any(r.contaminated for r in rows if r.doc_id in (1, 2, 3, 6))
    assert contamination(nothing(spark), load(spark, SF, "benchmark")).count() == 0
    assert not any(r.contaminated for r in contamination(awkward(spark), nothing(spark).withColumnRenamed("doc_id", "item_id")).collect())


def test_random_prose_is_clean(spark):
    rng = random.Random(4)
    items = [(k, sentence(rng, 30)) for k in range(40)]
    assert not any(found(spark, [sentence(rng, 60) for _ in range(60)], items).values())


SHORT = "a heavy stone rolls down from this steep hill until water stops its long way"


def test_one_changed_word_does_not_hide_a_short_item(spark):
    words = SHORT.split()
    items = [(n, " ".join(words[:n])) for n in range(8, 16)]
    texts, want = [], []
    for n in range(8, 16):
        for k in range(n):
            for middle in (["xx"], [], ["xx", words[k]]):
                texts.append("yy zz " + " ".join(words[:k] + middle + words[k + 1:n]) + " zz yy")
                want.append(n)
    got = found(spark, texts, items)
    assert all(n in got[d] for d, n in enumerate(want))
    # the words in another order, or far from each other, are no copy
    apart = " ".join(" ".join(words[k:k + 4]) + " ww" * 9 for k in range(0, 15, 4))
    assert found(spark, [" ".join(reversed(words)), apart], [items[-1]]) == {0: [], 1: []}


def test_parts_of_long_items(spark):
    rng = random.Random(8)
    words = sentence(rng, 100).lower().split()
    item = [(1, " ".join(words))]
    texts = ["aa " + " ".join(words[40:40 + n]) + " bb" for n in (12, 13, 32)]
    # every ninth word is another one: runs of eight tokens, four of five tokens covered
    texts.append(" ".join("xx" if k % 9 == 8 else w for k, w in enumerate(words)))
    assert found(spark, texts, item) == {0: [], 1: [1], 2: [1], 3: [1]}


def test_dense_windows_do_not_count_against_new_values(spark):
    text = "the red box is put on top of another old box by %s"
    item = [(1, text % " ".join(f"{k}" for k in range(10, 40)))]
    other = text % " ".join(f"{k}" for k in range(50, 80))
    assert found(spark, [other, "the red box stands here, " + " ".join(f"{k}" for k in range(50, 80))], item) == {0: [1], 1: []}


def test_rows_are_judged_by_their_own_text(spark):
    """A null id, or one id with two texts, does not carry a finding over to a clean row."""
    clean = "nothing of the kind stands here, only a plain remark about the weather and the sea on a long quiet day"
    item = "which of the four listed rivers flows through the old town before it meets the sea near the northern harbour"
    rows = [(None, item), (None, clean), (4, clean), (4, item), (4, item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(9, item)], "item_id long, text string")
    got = contamination(docs, items).collect()
    assert sorted((r.doc_id or 0, r.contaminated, tuple(r.item_ids or ())) for r in got) == [
        (0, False, ()), (0, True, (9,)), (4, False, ()), (4, True, (9,)), (4, True, (9,))]
