"""Chat request and usage shaping (H1-H9).

Input is a ``conversations(conv_id, turn, role, text)`` table. Every operator
groups by conversation (bounded by one chat history) or works per row; usage
running sums are windows partitioned by conversation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from memweave.operators.tokens import count_tokens, words

# --- fixed values: chat roles, limits and service lookups --------------------
VALID_ROLES = ("user", "assistant", "system")
MAX_RESULTS_PER_PROMPT = 128
SERVICE_MODELS = (
    ("TextCompletion", "gpt-4-1106-preview"),
    ("Vision", "gpt-4-vision-preview"),
    ("SpeechToText", "whisper-1"),
    ("TextToSpeechSpeed", "tts-1-hd"),
    ("TextToSpeechQuality", "tts-1"),
    ("ImageGeneration", "dall-e-3"),
    ("Embedding", "text-embedding-ada-002"),
)
TTS_VOICES = (("Echo", "echo"), ("Fable", "fable"), ("Onyx", "onyx"), ("Nova", "nova"), ("Shimmer", "shimmer"))
DEFAULT_VOICE = "alloy"
# ---------------------------------------------------------------------------


class ChatError(ValueError):
    pass


def lenient_role(role: Column) -> Column:
    """H2: user and assistant stay; any other role becomes system."""
    return F.when(role.isin("user", "assistant"), role).otherwise(F.lit("system"))


def role_is_valid(role: Column) -> Column:
    return F.coalesce(role.isin(*VALID_ROLES), F.lit(False))


def invalid_roles(conversations: DataFrame) -> DataFrame:
    """H3: count of messages per invalid role."""
    return (conversations.filter(~role_is_valid(F.col("role")))
            .groupBy("role").agg(F.count(F.lit(1)).alias("n_messages")))


def assemble_requests(conversations: DataFrame, *, strict: bool = True,
                      fail_on_invalid: bool = False) -> tuple[DataFrame, DataFrame]:
    """H1 (strict) / H2 (lenient): one ordered message list per conversation.

    Returns ``(requests, rejects)``: requests have ``messages`` =
    array<struct<role, content>> in turn order; in strict mode a conversation
    holding any other role than user/assistant/system is a reject, or, with
    ``fail_on_invalid``, fails the job as the original request builder does.
    """
    role = F.col("role") if strict else lenient_role(F.col("role"))
    msgs = conversations.select("conv_id", "turn", role.alias("role"), F.col("text").alias("content"))
    grouped = msgs.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "content"))).alias("_m"),
        F.min(role_is_valid(F.col("role")).cast("int")).alias("_ok"))
    requests = grouped.select(
        "conv_id", F.transform("_m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
        .alias("messages"), "_ok")
    if not strict:
        return requests.drop("_ok"), requests.filter(F.lit(False)).drop("_ok")
    if fail_on_invalid:
        checked = requests.filter(F.when(F.col("_ok") == 0, F.raise_error(
            F.concat(F.lit("unknown role in conversation "), F.col("conv_id").cast("string"))))
            .otherwise(F.lit(True)))
        return checked.drop("_ok"), requests.filter(F.lit(False)).drop("_ok")
    return requests.filter(F.col("_ok") == 1).drop("_ok"), requests.filter(F.col("_ok") == 0).drop("_ok")


def validate_settings(settings: DataFrame) -> DataFrame:
    """H4: ``1 <= results_per_prompt <= 128`` and ``max_tokens`` NULL or >= 1."""
    rpp, mt = F.col("results_per_prompt"), F.col("max_tokens")
    bad_rpp = rpp.isNull() | (rpp < 1) | (rpp > MAX_RESULTS_PER_PROMPT)
    bad_mt = mt.isNotNull() & (mt < 1)
    reason = (F.when(bad_rpp, F.lit("results_per_prompt out of range"))
              .when(bad_mt, F.lit("max_tokens must be greater than zero")))
    return settings.withColumn("is_valid", ~(bad_rpp | bad_mt)).withColumn("reason", reason)


def append_answers(history: DataFrame, replies: DataFrame) -> DataFrame:
    """H5: the first choice of each reply becomes the next assistant turn.

    ``replies(conv_id, choice_index, text)``; returns the appended rows.
    """
    first = replies.groupBy("conv_id").agg(F.min_by("text", F.col("choice_index")).alias("text"))
    last_turn = history.groupBy("conv_id").agg(F.max("turn").alias("_last"))
    return (first.join(last_turn, "conv_id")
            .select("conv_id", (F.col("_last") + 1).alias("turn"), F.lit("assistant").alias("role"), "text"))


def choice_rows(results: DataFrame) -> DataFrame:
    """H6: one row per choice with the response id, created stamp and usage repeated."""
    return results.select("id", "created", "usage", F.posexplode("choices").alias("choice_index", "choice")).select(
        "id", "created", "choice_index", F.col("choice").alias("text"),
        F.col("usage.prompt_tokens").alias("prompt_tokens"),
        F.col("usage.completion_tokens").alias("completion_tokens"),
        F.col("usage.total_tokens").alias("total_tokens"))


def usage_per_answer(conversations: DataFrame, *, count_mode: str = "pretoken") -> DataFrame:
    """H7: per assistant turn, prompt = tokens of all earlier turns, completion = its own."""
    tok = conversations.withColumn("_tokens", count_tokens(F.col("text"), count_mode).cast("bigint"))
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    tok = tok.withColumn("prompt_tokens", F.coalesce(F.sum("_tokens").over(w), F.lit(0)).cast("bigint"))
    answers = tok.filter(F.col("role") == "assistant")
    return answers.select("conv_id", "turn", "prompt_tokens", F.col("_tokens").alias("completion_tokens"),
                          (F.col("prompt_tokens") + F.col("_tokens")).alias("total_tokens"))


def usage_totals(per_answer: DataFrame) -> DataFrame:
    """H7 / P5: totals per conversation plus a grand total (conv_id NULL)."""
    return per_answer.rollup("conv_id").agg(
        F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"),
        F.sum("total_tokens").alias("total_tokens"))


def stream_deltas(conversations: DataFrame) -> DataFrame:
    """Delta rows of streamed messages: each word is one update, the role only on the first."""
    return (conversations.select("conv_id", "turn", "role", F.posexplode(words(F.col("text"))).alias("seq", "delta"))
            .withColumn("role", F.when(F.col("seq") == 0, F.col("role"))))


def carry_stream(deltas: DataFrame) -> DataFrame:
    """H8: at each update, the last role seen and the last non-empty content."""
    w = Window.partitionBy("conv_id", "turn").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    content = F.when(F.length("delta") > 0, F.col("delta"))
    return deltas.select("conv_id", "turn", "seq",
                         F.last("role", ignorenulls=True).over(w).alias("role"),
                         F.last(content, ignorenulls=True).over(w).alias("content"))


def stream_messages(deltas: DataFrame) -> DataFrame:
    """H8: final role, last content and the concatenated text per streamed message."""
    return deltas.groupBy("conv_id", "turn").agg(
        F.max_by("role", F.when(F.col("role").isNotNull(), F.col("seq"))).alias("role"),
        F.max_by("delta", F.when(F.length("delta") > 0, F.col("seq"))).alias("content"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "delta"))), lambda x: x["delta"]), " ")
        .alias("text"),
        F.count(F.lit(1)).alias("n_deltas"))


def _lookup(pairs: Sequence[tuple[str, str]]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs for x in kv])


def model_for(kind: Column) -> Column:
    """H9: model name of a service kind; NULL for an unknown kind (route to rejects)."""
    return F.try_element_at(_lookup(SERVICE_MODELS), kind)


def voice_for(voice: Column) -> Column:
    """H9: voice name; anything unknown falls back to the default voice."""
    return F.coalesce(F.try_element_at(_lookup(TTS_VOICES), voice), F.lit(DEFAULT_VOICE))


def resolve_models(requests: DataFrame, *, strict: bool = True, kind_col: str = "kind") -> DataFrame:
    """H9 batch form: an unknown kind fails the job (``strict``) or yields NULL."""
    m = model_for(F.col(kind_col))
    out = requests.withColumn("model", m)
    if strict:
        out = out.filter(F.when(F.col("model").isNull(),
                                F.raise_error(F.concat(F.lit("unknown service kind: "), F.col(kind_col))))
                         .otherwise(F.lit(True)))
    return out
