import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from memweave.llm import decontaminate, linededup, neardup, packing, quality
from memweave.session import materialize
from memweave.sources.tables import load
from tests.llm.helpers import SF, awkward, awkward_rows, nothing

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = load(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        made = materialize(stage(spark, docs, SF), "step")
        out.append((name, docs, made))
        docs = made
    return out


def test_stages_are_the_five_in_order(steps):
    assert [n for n, _, _ in steps] == ["quality_classifier", "line_dedup", "near_duplicates", "decontamination", "packing"]
    assert all(made.columns == COLUMNS for _, _, made in steps[:-1])


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_each_stage_acts_on_its_input(spark, steps):
    quality_in, lines_in, near_in, bench_in, pack_in = (docs for _, docs, _ in steps)
    judged = quality.classify(quality_in, load(spark, SF, "labels"), keep=["doc_id", "kept"])
    assert ids(lines_in) == ids(judged.filter("kept"))
    cleaned = {r.doc_id: r.text for r in linededup.drop_repeated_lines(lines_in).collect()}
    left = {r.doc_id: r.text for r in near_in.collect()}
    assert left.items() <= cleaned.items() and not any(t.strip() for i, t in cleaned.items() if i not in left)
    assert all(r.n_chars == len(r.text) for r in near_in.collect())
    groups = neardup.group_near_duplicates(near_in, percent=80)
    assert ids(bench_in) == sorted(r.id for r in groups.collect() if r.id == r.component)
    leaked = {r.id for r in decontaminate.leaks(bench_in, load(spark, SF, "benchmark")).collect()}
    assert leaked and ids(pack_in) == sorted(set(ids(bench_in)) - leaked)
    assert sorted(map(tuple, steps[-1][2].collect())) == sorted(map(tuple, packing.pack(pack_in).collect()))


def test_clean_documents_pass_the_classifier(spark, steps):
    good = ids(load(spark, SF, "labels").filter("quality = 1 and toxic = 0"))
    assert len(set(good) & set(ids(steps[0][2]))) >= 0.95 * len(good)


def test_stages_take_awkward_and_empty_input(spark):
    for docs in (awkward(spark, clash=False), nothing(spark)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= len(awkward_rows())


def test_decontamination_judges_rows_without_or_with_one_id_by_their_texts(spark):
    item = max((r.text for r in load(spark, SF, "benchmark").collect() if r.text), key=len)
    clean = "a clean text about other things that no benchmark holds, with words enough for some windows of tokens in it"
    rows = [(None, item, "en", "s", 1), (None, clean, "en", "s", 2), (7, clean + " too", "en", "s", 3), (7, "Before it. " + item, "en", "s", 4), (8, None, "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.decontamination_stage(spark, docs, SF)
    assert kept.columns == COLUMNS and sorted(r.n_chars for r in kept.collect()) == [2, 3, 5]


def test_registered(spark):
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
