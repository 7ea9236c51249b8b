import hashlib
from itertools import groupby

from hypothesis import given, settings
from hypothesis import strategies as st

from memweave.llm.chatformat import CONTROL, digests, escape, format_windows, parse, render, unescape
from memweave.llm.queries import QUERIES
from memweave.sources.tables import load
from tests.llm.helpers import SF

SCHEMA = "conv_id long, turn long, role string, text string"
PIECES = st.sampled_from([*CONTROL, "\\", "<", ">", "]", "[", "/", "s>", "\n", " ", "é", "word"])
TEXT = st.lists(PIECES, max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(turns=st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "a]b\\", "", None]) | TEXT, TEXT, st.booleans()), max_size=6))
def test_round_trip(turns):
    text, starts, ends = render(turns)
    assert parse(text) == [(role, said) for role, said, _ in turns]
    assert [unescape(text[a:b]) for a, b in zip(starts, ends)] == [said for _, said, learned in turns if learned]


@settings(max_examples=300, deadline=None)
@given(text=TEXT)
def test_escaped_text_holds_no_control_string(text):
    assert not any(c in escape(text) for c in CONTROL) and unescape(escape(text)) == text


def want(rows):
    key = lambda r: (r[0] is not None, r[0] or 0)
    order = sorted(rows, key=lambda r: (*key(r), r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] or ""))
    out = {}
    for _, g in groupby(order, key=key):
        g = list(g)
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in g)
        learned = "".join(r[3] or "" for r in g if r[2] == "assistant")
        out[g[0][0]] = (len(g), hashlib.sha256(turns.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    return out


def check(df, rows, **options):
    windows = format_windows(df, **options)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in digests(windows).collect()}
    assert got == want(rows)
    return windows.collect()


def test_query_reads_back_every_conversation(spark):
    rows = [tuple(r) for r in load(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    control = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in QUERIES["op8_budgeted_chat_windows"](spark, SF).collect()}
    assert got == want(rows + control)


def test_windows_of_long_conversations(spark):
    rows = [(1, 0, "system", "be kind")]
    rows += [(1, k, "user" if k % 2 else "assistant", f"w{k} " * (k % 13)) for k in range(1, 400)]
    rows += [(2, k, "user", "many words " * 300) for k in range(3)] + [(3, 0, "assistant", "only")]
    windows = check(spark.createDataFrame(rows, SCHEMA), rows, budget=80)
    one = sorted((w for w in windows if w.conv_id == 1), key=lambda w: w.span)
    assert len(one) > 30 and not any(w.over_budget for w in one) and all(w.n_tokens <= 80 for w in one)
    seen = []
    for w in one:
        turns = parse(w.text)
        assert turns[0] == ("system", "be kind")
        again = turns[1:w.n_repeated] if w.span else []
        assert again == seen[len(seen) - len(again):]  # the turns right before this span
        seen += turns[w.n_repeated:]
    assert any(w.n_repeated > 1 for w in one) and all(w.over_budget for w in windows if w.conv_id == 2)


def test_awkward_rows(spark):
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (1, None, "user", None), (1, 0, None, "x"), (1, 0, "tool]", "y\\"), (1, 0, "assistant", None),
            (1, 1, "assistant", "t" * 50_000), (2, 0, "user", "same"), (2, 0, "user", "same"), (2, 0, "assistant", "</s></s>"), (3, 5, "system", "s"), (3, 6, "system", "s")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as span", "'x' as prefix", "'x' as cost", "2 as own", "'c' as c")
    check(df, rows, budget=32)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert format_windows(empty).count() == 0 and digests(format_windows(empty)).count() == 0
