"""Registered rendering (T1-T4) and chat (H1-H9) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from memweave.operators import chat as H
from memweave.operators import render as RD
from memweave.plans.catalog import register
from memweave.plans.text_queries import W, WORD_RE2
from memweave.sources.tables import load

TRIM_SQL = f"'^[{W}]+|[{W}]+$'"


def _digest(df, key):
    return df.select(key, F.sha2("text", 256).alias("sha256"), F.length("text").cast("bigint").alias("n_chars"))


def _digest_sql(expr: str) -> str:
    t = f"regexp_replace({expr}, {TRIM_SQL}, '', 'g')"
    return f"sha256({t}) AS sha256, CAST(length({t}) AS BIGINT) AS n_chars"


# --- derived element tables -------------------------------------------------------

def paragraphs(spark, sf_dir):
    d = load(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "text"))


def slide_texts(spark, sf_dir):
    c = load(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("doc"), (F.col("turn") + 1).alias("slide_no"),
                    (F.col("turn") % 5 == 4).alias("hidden"),
                    F.posexplode(F.split("text", "\n", -1)).alias("pos", "text"))


SLIDES_SQL = """
st AS (
  SELECT conv_id AS doc, turn + 1 AS slide_no, turn % 5 = 4 AS hidden,
         unnest(range(len(ls))) AS pos, unnest(ls) AS text
  FROM (SELECT conv_id, turn, string_split(text, chr(10)) AS ls FROM conversations)),
s AS (SELECT doc, slide_no, string_agg(text, ' ' ORDER BY pos) AS content, bool_or(hidden) AS hidden
      FROM st GROUP BY doc, slide_no)"""


def cells(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    sup = load(spark, sf_dir, "supplier")

    def unpivot(df, key, sheet, cols):
        items = F.array(*[F.struct(F.lit(i + 1).alias("col"), F.col(c).cast("string").alias("value"),
                                   F.lit(is_text).alias("is_text")) for i, (c, is_text) in enumerate(cols)])
        n = len(cols)
        out = df.select(F.concat(F.lit("book"), F.floor(F.col(key) / 50).cast("string")).alias("doc"),
                        F.lit(sheet).alias("sheet_no"), (F.col(key) % 50 + 1).cast("int").alias("row"),
                        F.explode(items).alias("c")).select("doc", "sheet_no", "row", "c.*")
        # every 7th cell of a sheet is blank
        return out.withColumn("value", F.when((F.col("row") * n + F.col("col")) % 7 == 0, F.lit(None))
                              .otherwise(F.col("value")))

    p = unpivot(part, "p_partkey", 1, [("p_partkey", False), ("p_name", True), ("p_brand", True), ("p_type", True),
                                       ("p_size", False), ("p_retailprice", False)])
    s = unpivot(sup, "s_suppkey", 2, [("s_suppkey", False), ("s_name", True), ("s_nationkey", False),
                                      ("s_acctbal", False)])
    return p.unionByName(s)


def _cells_sql_part(table, key, sheet, cols):
    n = len(cols)
    unions = []
    for i, (c, is_text) in enumerate(cols):
        col = i + 1
        unions.append(f"""SELECT 'book' || CAST(floor({key} / 50) AS BIGINT) AS doc, {sheet} AS sheet_no,
       CAST({key} % 50 + 1 AS INTEGER) AS row, {col} AS col,
       CASE WHEN (({key} % 50 + 1) * {n} + {col}) % 7 = 0 THEN NULL ELSE CAST({c} AS VARCHAR) END AS value,
       {str(is_text).lower()} AS is_text FROM {table}""")
    return "\nUNION ALL\n".join(unions)


CELLS_SQL = "cells AS (\n" + _cells_sql_part("part", "p_partkey", 1, [
    ("p_partkey", False), ("p_name", True), ("p_brand", True), ("p_type", True), ("p_size", False),
    ("p_retailprice", False)]) + "\nUNION ALL\n" + _cells_sql_part("supplier", "s_suppkey", 2, [
    ("s_suppkey", False), ("s_name", True), ("s_nationkey", False), ("s_acctbal", False)]) + ")"


# --- T ------------------------------------------------------------------------------

@register("t1_paragraph_text", f"""
WITH p AS (
  SELECT doc_id AS doc, unnest(range(len(ls))) AS pos, unnest(ls) AS text
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
j AS (SELECT doc, string_agg(text, chr(10) ORDER BY pos) AS t FROM p GROUP BY doc)
SELECT doc, {_digest_sql('t')} FROM j""")
def t1_paragraph_text(spark, sf_dir):
    return _digest(RD.paragraphs_to_text(paragraphs(spark, sf_dir)), "doc")


@register("t2_slide_text", f"""
WITH {SLIDES_SQL},
b AS (SELECT doc, slide_no, '# Slide ' || slide_no || chr(10) || content || chr(10) AS block
      FROM s WHERE length(content) >= 1 AND NOT hidden),
d AS (SELECT doc, string_agg(block, '' ORDER BY slide_no) AS t FROM b GROUP BY doc)
SELECT doc, {_digest_sql('t')} FROM d""")
def t2_slide_text(spark, sf_dir):
    return _digest(RD.slides_to_text(slide_texts(spark, sf_dir)), "doc")


@register("t2_slide_text_markers", f"""
WITH {SLIDES_SQL},
b AS (SELECT doc, slide_no, content || chr(10) || '# End of slide ' || slide_no || chr(10) AS block
      FROM s WHERE length(content) >= 1),
d AS (SELECT doc, string_agg(block, '' ORDER BY slide_no) AS t FROM b GROUP BY doc)
SELECT doc, {_digest_sql('t')} FROM d""")
def t2_slide_text_markers(spark, sf_dir):
    out = RD.slides_to_text(slide_texts(spark, sf_dir), with_slide_number=False, with_end_marker=True,
                            skip_hidden=False)
    return _digest(out, "doc")


@register("t3_sheet_text", f"""
WITH {CELLS_SQL},
used AS (SELECT *, CASE WHEN is_text THEN '"' || replace(value, '"', '""') || '"' ELSE value END AS cell
         FROM cells WHERE value IS NOT NULL AND value <> ''),
r AS (SELECT doc, sheet_no, row, string_agg(cell, ', ' ORDER BY col) || chr(10) AS line FROM used GROUP BY ALL),
sh AS (SELECT doc, sheet_no, chr(10) || '# Worksheet ' || sheet_no || chr(10) || chr(10)
              || string_agg(line, '' ORDER BY row) AS sheet FROM r GROUP BY doc, sheet_no),
d AS (SELECT doc, string_agg(sheet, '' ORDER BY sheet_no) AS t FROM sh GROUP BY doc)
SELECT doc, {_digest_sql('t')} FROM d""")
def t3_sheet_text(spark, sf_dir):
    return _digest(RD.cells_to_text(cells(spark, sf_dir)), "doc")


@register("t4_pages", """
WITH l AS (
  SELECT doc_id, unnest(range(len(ls))) AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))
SELECT doc_id, CAST(pos // 20 + 1 AS INTEGER) AS page_no, sha256(string_agg(line, chr(10) ORDER BY pos)) AS sha256,
       count(*) AS n_lines
FROM l GROUP BY doc_id, pos // 20""")
def t4_pages(spark, sf_dir):
    pages = RD.paginate(load(spark, sf_dir, "documents"), lines_per_page=20)
    return pages.select("doc_id", F.col("page_no").cast("int").alias("page_no"), F.sha2("text", 256).alias("sha256"),
                        F.size(F.split("text", "\n", -1)).cast("bigint").alias("n_lines"))


# --- H ------------------------------------------------------------------------------

def chat_messages(spark, sf_dir):
    """Conversations with some tool messages (turn % 6 = 5) for the role rules."""
    c = load(spark, sf_dir, "conversations")
    return c.withColumn("role", F.when(F.col("turn") % 6 == 5, F.lit("tool")).otherwise(F.col("role")))


CHAT_SQL = """
msgs AS (SELECT conv_id, turn, CASE WHEN turn % 6 = 5 THEN 'tool' ELSE role END AS role, text FROM conversations)"""


@register("h1_assemble_requests", f"""
WITH {CHAT_SQL}
SELECT conv_id, CAST(count(*) AS INTEGER) AS n_messages, string_agg(role, ',' ORDER BY turn) AS roles,
       sha256(string_agg(text, chr(10) ORDER BY turn)) AS content_sha256,
       CASE WHEN bool_and(role IN ('user', 'assistant', 'system')) THEN 'request' ELSE 'reject' END AS status
FROM msgs GROUP BY conv_id""")
def h1_assemble_requests(spark, sf_dir):
    ok, bad = H.assemble_requests(chat_messages(spark, sf_dir), strict=True)

    def digest(df, status):
        return df.select("conv_id", F.size("messages").alias("n_messages"),
                         F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"),
                         F.sha2(F.array_join(F.transform("messages", lambda m: m["content"]), "\n"), 256)
                         .alias("content_sha256"), F.lit(status).alias("status"))

    return digest(ok, "request").unionByName(digest(bad, "reject"))


@register("h2_lenient_roles", f"""
WITH {CHAT_SQL}
SELECT conv_id, turn, CASE WHEN role IN ('user', 'assistant') THEN role ELSE 'system' END AS role FROM msgs""")
def h2_lenient_roles(spark, sf_dir):
    c = chat_messages(spark, sf_dir)
    return c.select("conv_id", "turn", H.lenient_role(F.col("role")).alias("role"))


@register("h3_invalid_roles", f"""
WITH {CHAT_SQL}
SELECT role, count(*) AS n_messages FROM msgs WHERE role NOT IN ('user', 'assistant', 'system') GROUP BY role""")
def h3_invalid_roles(spark, sf_dir):
    return H.invalid_roles(chat_messages(spark, sf_dir))


def chat_settings(spark, sf_dir):
    """The settings of one request a message."""
    c, n = load(spark, sf_dir, "conversations"), F.col("conv_id") + F.col("turn")
    return c.select("conv_id", "turn", (n % 130).cast("int").alias("results_per_prompt"),
                    F.when(n % 3 == 0, F.lit(None)).when(n % 3 == 1, F.lit(0)).otherwise(n % 7).cast("int").alias("max_tokens"))


@register("h4_settings", """
WITH s AS (
  SELECT conv_id, turn, CAST((conv_id + turn) % 130 AS INTEGER) AS rpp,
         CAST(CASE (conv_id + turn) % 3 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE (conv_id + turn) % 7 END AS INTEGER) AS mt
  FROM conversations)
SELECT conv_id, turn, NOT (rpp < 1 OR rpp > 128 OR (mt IS NOT NULL AND mt < 1)) AS is_valid,
       CASE WHEN rpp < 1 OR rpp > 128 THEN 'results_per_prompt out of range'
            WHEN mt IS NOT NULL AND mt < 1 THEN 'max_tokens must be greater than zero' END AS reason
FROM s""")
def h4_settings(spark, sf_dir):
    return H.validate_settings(chat_settings(spark, sf_dir)).select("conv_id", "turn", "is_valid", "reason")


@register("h5_append_answers", """
WITH first AS (
  SELECT conv_id, text FROM conversations WHERE role = 'user'
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1),
last AS (SELECT conv_id, max(turn) AS t FROM conversations GROUP BY conv_id)
SELECT f.conv_id, l.t + 1 AS turn, 'assistant' AS role, sha256(f.text) AS text_sha256
FROM first f JOIN last l USING (conv_id)""")
def h5_append_answers(spark, sf_dir):
    c = load(spark, sf_dir, "conversations")
    replies = c.filter(F.col("role") == "user").select("conv_id", F.col("turn").alias("choice_index"), "text")
    out = H.append_answers(c, replies)
    return out.select("conv_id", "turn", "role", F.sha2("text", 256).alias("text_sha256"))


def chat_results(spark, sf_dir):
    c = load(spark, sf_dir, "conversations").withColumn("_tok", H.count_tokens(F.col("text"), "whitespace"))
    g = c.groupBy("conv_id").agg(
        F.transform(F.array_sort(F.collect_list(F.when(F.col("role") == "assistant", F.struct("turn", "text")))),
                    lambda x: x["text"]).alias("choices"),
        F.sum(F.when(F.col("role") != "assistant", F.col("_tok")).otherwise(0)).cast("bigint").alias("p"),
        F.sum(F.when(F.col("role") == "assistant", F.col("_tok")).otherwise(0)).cast("bigint").alias("c"))
    return g.select(F.concat(F.lit("chatcmpl-"), F.col("conv_id").cast("string")).alias("id"),
                    (F.lit(1700000000) + F.col("conv_id")).cast("bigint").alias("created"), "choices",
                    F.struct(F.col("p").alias("prompt_tokens"), F.col("c").alias("completion_tokens"),
                             (F.col("p") + F.col("c")).alias("total_tokens")).alias("usage"))


@register("h6_choice_rows", f"""
WITH t AS (SELECT *, len(regexp_extract_all(coalesce(text, ''), '{WORD_RE2}')) AS tok FROM conversations),
u AS (SELECT conv_id, sum(CASE WHEN role <> 'assistant' THEN tok ELSE 0 END) AS p,
             sum(CASE WHEN role = 'assistant' THEN tok ELSE 0 END) AS c FROM t GROUP BY conv_id),
a AS (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS choice_index
      FROM conversations WHERE role = 'assistant')
SELECT 'chatcmpl-' || a.conv_id AS id, CAST(1700000000 + a.conv_id AS BIGINT) AS created,
       CAST(a.choice_index AS INTEGER) AS choice_index, sha256(a.text) AS text_sha256,
       CAST(u.p AS BIGINT) AS prompt_tokens, CAST(u.c AS BIGINT) AS completion_tokens,
       CAST(u.p + u.c AS BIGINT) AS total_tokens
FROM a JOIN u USING (conv_id)""")
def h6_choice_rows(spark, sf_dir):
    rows = H.choice_rows(chat_results(spark, sf_dir))
    return rows.select("id", "created", "choice_index", F.sha2("text", 256).alias("text_sha256"),
                       "prompt_tokens", "completion_tokens", "total_tokens")


@register("h7_usage_totals", f"""
WITH t AS (SELECT *, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD_RE2}')) AS BIGINT) AS tok
           FROM conversations),
r AS (SELECT conv_id, role, tok, coalesce(sum(tok) OVER (PARTITION BY conv_id ORDER BY turn
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prompt FROM t),
a AS (SELECT conv_id, prompt, tok AS completion FROM r WHERE role = 'assistant')
SELECT coalesce(conv_id, -1) AS conv_id, CAST(sum(prompt) AS BIGINT) AS prompt_tokens,
       CAST(sum(completion) AS BIGINT) AS completion_tokens, CAST(sum(prompt + completion) AS BIGINT) AS total_tokens
FROM a GROUP BY ROLLUP (conv_id)""")
def h7_usage_totals(spark, sf_dir):
    per = H.usage_per_answer(load(spark, sf_dir, "conversations"), count_mode="whitespace")
    tot = H.usage_totals(per)
    return tot.select(F.coalesce(F.col("conv_id"), F.lit(-1)).alias("conv_id"),
                      *[F.col(c).cast("bigint").alias(c) for c in ("prompt_tokens", "completion_tokens", "total_tokens")])


@register("h8_stream_messages", f"""
WITH w AS (SELECT conv_id, turn, role, regexp_extract_all(text, '{WORD_RE2}') AS ws FROM conversations)
SELECT conv_id, turn, role, ws[len(ws)] AS content, sha256(array_to_string(ws, ' ')) AS text_sha256,
       CAST(len(ws) AS BIGINT) AS n_deltas
FROM w WHERE len(ws) > 0""")
def h8_stream_messages(spark, sf_dir):
    m = H.stream_messages(H.stream_deltas(load(spark, sf_dir, "conversations")))
    return m.select("conv_id", "turn", "role", "content", F.sha2("text", 256).alias("text_sha256"), "n_deltas")


@register("h8_carry_stream", f"""
WITH w AS (SELECT conv_id, turn, role, regexp_extract_all(text, '{WORD_RE2}') AS ws FROM conversations)
SELECT conv_id, turn, CAST(i - 1 AS INTEGER) AS seq, role, ws[i] AS content
FROM w, range(1, len(ws) + 1) r(i)""")
def h8_carry_stream(spark, sf_dir):
    return H.carry_stream(H.stream_deltas(load(spark, sf_dir, "conversations")))


KINDS = ["TextCompletion", "Vision", "SpeechToText", "TextToSpeechSpeed", "TextToSpeechQuality",
         "ImageGeneration", "Embedding", "Translation"]
VOICES = ["Echo", "Fable", "Onyx", "Nova", "Shimmer", "Alloy", "Whisper"]


def service_requests(spark, sf_dir):
    """One request a message: a service kind and a voice."""
    c, n = load(spark, sf_dir, "conversations"), F.col("conv_id") + F.col("turn")
    kinds = F.array(*[F.lit(k) for k in KINDS])
    voices = F.array(*[F.lit(v) for v in VOICES])
    return c.select("conv_id", "turn", F.get(kinds, (n % len(KINDS)).cast("int")).alias("kind"),
                    F.get(voices, (n % len(VOICES)).cast("int")).alias("voice"))


def _list_sql(items):
    return "[" + ", ".join(f"'{x}'" for x in items) + "]"


@register("h9_model_lookup", f"""
WITH r AS (
  SELECT conv_id, turn, {_list_sql(KINDS)}[(conv_id + turn) % {len(KINDS)} + 1] AS kind,
         {_list_sql(VOICES)}[(conv_id + turn) % {len(VOICES)} + 1] AS voice
  FROM conversations),
m AS (SELECT * FROM (VALUES {", ".join(f"('{k}', '{v}')" for k, v in H.SERVICE_MODELS)}) m(kind, model)),
v AS (SELECT * FROM (VALUES {", ".join(f"('{k}', '{x}')" for k, x in H.TTS_VOICES)}) v(voice, voice_name))
SELECT r.conv_id, r.turn, r.kind, m.model, coalesce(v.voice_name, 'alloy') AS voice
FROM r LEFT JOIN m USING (kind) LEFT JOIN v USING (voice)""")
def h9_model_lookup(spark, sf_dir):
    r = service_requests(spark, sf_dir)
    return r.select("conv_id", "turn", "kind", H.model_for(F.col("kind")).alias("model"),
                    H.voice_for(F.col("voice")).alias("voice"))
