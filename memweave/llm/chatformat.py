r"""Chat formatting in budgeted windows.

Turns are ordered by (turn, role, text). A turn costs its words plus
``overhead`` tokens; prefix sums of these costs cut a conversation into spans:
a turn belongs to span ``prefix // stride`` of the sum before it, so spans are
aligned to turns and need no scan. A span's window holds, in this order, the
conversation's leading system turn (again, from the second span on), the last
turns of the span before that start within ``history`` tokens (again), and the
span's own turns. With ``stride`` at half and ``history`` at a quarter of
``budget`` a window stays within the budget unless its system turn and last
turn together exceed a quarter; ``over_budget`` says so. No turn is cut or
dropped. The loss mask covers the texts of a span's own assistant turns; all
that is repeated is masked, so each assistant text is learned once.

Template: ``<s>HEAD text</s>`` for each turn, HEAD being ``[INST]`` (user),
``[/INST]`` (assistant), ``[SYS]`` (system), ``[ROLE:name]`` (others) or
``[NULL]`` (no role). In texts and names a backslash is doubled and every control string is
broken by a backslash after its first character, so ``parse`` restores them
exactly.

Edge cases: a null text counts as empty, a null turn comes first, a null
conv_id is a conversation of its own; equal rows stay separate turns; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from memweave.functions.ordering import running_total

#: The template's control strings.
HEADS = {"user": "[INST]", "assistant": "[/INST]", "system": "[SYS]", None: "[NULL]"}
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[NULL]", "[ROLE:")
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_TURN = re.compile(r"<s>(\[INST\]|\[/INST\]|\[SYS\]|\[NULL\]|\[ROLE:(?:\\.|[^\]\\])*\]) (.*?)</s>", re.DOTALL)
_ROLES = {v: k for k, v in HEADS.items()}


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


def head(role: str | None) -> str:
    return HEADS.get(role) or "[ROLE:" + escape(role).replace("]", "\\]") + "]"


def render(turns: list[tuple[str | None, str, bool]]) -> tuple[str, list[int], list[int]]:
    """(text, starts, ends) of one window; a turn is (role, text, learned)."""
    parts, starts, ends, at = [], [], [], 0
    for role, text, learned in turns:
        before, body = f"<s>{head(role)} ", escape(text)
        if learned:
            starts.append(at + len(before))
            ends.append(at + len(before) + len(body))
        parts.append(before + body + "</s>")
        at += len(parts[-1])
    return "".join(parts), starts, ends


def parse(text: str) -> list[tuple[str | None, str]]:
    """(role, text) of every turn of a rendered window."""
    out = []
    for m in _TURN.finditer(text):
        mark = m[1]
        out.append((_ROLES[mark] if mark in _ROLES else unescape(mark[6:-1]), unescape(m[2])))
    return out


def format_windows(conversations: DataFrame, *, budget: int = 1024, overhead: int = 4) -> DataFrame:
    """(conv_id, span, text, loss_start, loss_end, n_repeated, n_own, n_tokens, over_budget): one row per window.

    ``loss_start`` and ``loss_end`` are code point offsets into ``text``;
    ``n_repeated`` is the number of leading turns that repeat earlier ones.
    """
    stride, history = budget // 2, budget // 4
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    turns = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    turns = turns.withColumn("cost", (words + overhead).cast("bigint"))
    turns = running_total(turns, ["conv_id"], ["turn", "role", "text"], "cost", "prefix")
    turns = turns.withColumn("span", F.floor(F.col("prefix") / stride).cast("bigint"))
    starts = turns.groupBy(F.col("conv_id").alias("c"), F.col("span").alias("next")).agg(F.min("prefix").alias("first"))
    leads = (F.col("prefix") == 0) & (F.col("role") == "system")
    again = turns.join(starts.filter("next > 0"), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("span") + 1 == F.col("next")))
    again = again.filter((F.col("prefix") >= F.col("first") - history) & ~F.coalesce(leads, F.lit(False)))
    system = turns.filter(leads).select(F.col("conv_id").alias("s"), "turn", "role", "text", "cost", "prefix")
    system = system.join(starts.filter("next > 0"), F.col("s").eqNullSafe(F.col("c"))).withColumn("conv_id", F.col("s"))
    cols = ["conv_id", "span", "prefix", "own", "role", "text", "cost"]
    rows = (turns.withColumn("own", F.lit(True)).select(*cols)
            .unionByName(again.withColumn("own", F.lit(False)).withColumn("span", F.col("next")).select(*cols))
            .unionByName(system.withColumn("own", F.lit(False)).withColumn("span", F.col("next")).select(*cols)))
    # a window holds a bounded number of turns: each costs at least ``overhead``
    windows = rows.groupBy("conv_id", "span").agg(F.sort_array(F.collect_list(F.struct("prefix", "own", "role", "text"))).alias("turns"),
                                                  F.sum("cost").alias("n_tokens"))
    schema = StructType([conversations.schema["conv_id"], StructField("span", LongType()), StructField("text", StringType()),
                         StructField("loss_start", ArrayType(IntegerType())), StructField("loss_end", ArrayType(IntegerType())),
                         StructField("n_repeated", IntegerType()), StructField("n_own", IntegerType()), StructField("n_tokens", LongType()),
                         StructField("over_budget", BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, start, end, repeated, own = [], [], [], [], []
            for turns in b.column(2):
                turns = turns.as_py()
                t, s, e = render([(x["role"], x["text"], x["own"] and x["role"] == "assistant") for x in turns])
                text.append(t)
                start.append(s)
                end.append(e)
                own.append(sum(x["own"] for x in turns))
                repeated.append(len(turns) - own[-1])
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(text, pa.string()), pa.array(start, ints), pa.array(end, ints), pa.array(repeated, pa.int32()),
                 pa.array(own, pa.int32()), b.column(3), pa.array([n > budget for n in b.column(3).to_pylist()], pa.bool_())], names=schema.names)

    return windows.select("conv_id", "span", "turns", "n_tokens").mapInArrow(run, schema)


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from its windows: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows.

    The windows of a conversation pass through its task one after another;
    only hash states are kept.
    """
    schema = StructType([windows.schema["conv_id"], StructField("n_turns", LongType()), StructField("turns_sha256", StringType()),
                         StructField("loss_chars", LongType()), StructField("loss_sha256", StringType()), StructField("formatted_chars", LongType()),
                         StructField("n_windows", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None

        def row(s: list) -> pa.RecordBatch:
            values = [[s[0]], [s[1]], [s[2].hexdigest()], [s[3]], [s[4].hexdigest()], [s[5]], [s[6]]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], names=schema.names)

        for b in batches:
            kinds = [b.schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            for conv, text, start, end, repeated in zip(*(b.column(k).to_pylist() for k in (0, 2, 3, 4, 5))):
                if state is None or state[0] != conv:
                    if state is not None:
                        yield row(state)
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, said in parse(text)[repeated:]:
                    state[1] += 1
                    state[2].update(f"{role or ''}\n{said}\n".encode())
                for s, e in zip(start, end):
                    learned = unescape(text[s:e])
                    state[3] += len(learned)
                    state[4].update(learned.encode())
                state[5] += len(text)
                state[6] += 1
        if state is not None:
            yield row(state)

    ordered = windows.select("conv_id", "span", "text", "loss_start", "loss_end", "n_repeated").repartition("conv_id")
    return ordered.sortWithinPartitions("conv_id", "span").mapInArrow(run, schema)
