"""Registered token and chunking queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from memweave.operators import chunking as CH
from memweave.operators import tokens as K
from memweave.functions.parallel import spread
from memweave.plans.catalog import register
from memweave.sources.tables import load

# DuckDB (RE2) forms of the whitespace class and patterns: RE2 writes the NEL
# escape as \x{85} and has no look-ahead, so the pre-token count inserts a
# marker before the last character of every whitespace run that precedes a
# non-whitespace character and matches the pieces separately.
W = r"\f\n\r\t\x0B\x{85}\p{Z}"
WORD_RE2 = f"[^{W}]+"
PRE_RE2 = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + W + r"\p{L}\p{N}]+|[" + W + "]+"
PRE_SQL = PRE_RE2.replace("'", "''")  # as an SQL string literal

PRETOKENS_SQL = f"""
toks AS (
  SELECT doc_id, unnest(regexp_extract_all(piece, '{PRE_SQL}')) AS tok FROM (
    SELECT doc_id,
           unnest(string_split(regexp_replace(text, '([{W}])([{W}][^{W}])', '\\1' || chr(1) || '\\2', 'g'), chr(1))) AS piece
    FROM documents)),
tok_counts AS (
  SELECT doc_id, count(*) AS n, CAST(count_if(starts_with(tok, ' ')) AS BIGINT) AS n_space FROM toks GROUP BY doc_id)"""

LINE_LIMIT, PARAGRAPH_LIMIT, OVERLAP = 40, 200, 20


@register("k1_pretokens", f"""
WITH {PRETOKENS_SQL}
SELECT d.doc_id, coalesce(t.n, 0) AS n_pretokens, coalesce(t.n_space, 0) AS n_space_led
FROM documents d LEFT JOIN tok_counts t USING (doc_id)""")
def k1_pretokens(spark, sf_dir):
    docs = spread(load(spark, sf_dir, "documents"), "doc_id")
    toks = K.pretokens("text")
    return docs.select("doc_id", F.size(toks).cast("bigint").alias("n_pretokens"),
                       F.size(F.filter(toks, lambda t: t.startswith(" "))).cast("bigint").alias("n_space_led"))


@register("k5_token_counts", f"""
WITH {PRETOKENS_SQL}
SELECT d.doc_id, CAST(len(regexp_extract_all(coalesce(d.text, ''), '{WORD_RE2}')) AS BIGINT) AS n_whitespace,
       coalesce(t.n, 0) AS n_pretoken
FROM documents d LEFT JOIN tok_counts t USING (doc_id)""")
def k5_token_counts(spark, sf_dir):
    docs = spread(load(spark, sf_dir, "documents"), "doc_id")
    return docs.select("doc_id", K.count_tokens("text", "whitespace").cast("bigint").alias("n_whitespace"),
                       K.count_tokens("text", "pretoken").cast("bigint").alias("n_pretoken"))


@register("k6_over_budget", f"""
WITH {PRETOKENS_SQL}
SELECT d.doc_id, coalesce(t.n, 0) AS n_tokens, coalesce(t.n, 0) > 2048 AS over_budget
FROM documents d LEFT JOIN tok_counts t USING (doc_id)""")
def k6_over_budget(spark, sf_dir):
    docs = spread(load(spark, sf_dir, "documents"), "doc_id").select(
        "doc_id", K.count_tokens("text").cast("bigint").alias("n_tokens"))
    return docs.withColumn("over_budget", K.over_budget("n_tokens", 2048))


def sublines_sql(L: int, p: str = "", src: str = "documents") -> str:
    return f"""
{p}raw AS (
  SELECT doc_id, unnest(range(len(ls))) AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM {src})),
{p}wl AS (SELECT doc_id, pos, regexp_extract_all(line, '{WORD_RE2}') AS ws,
                 regexp_matches(line, '^#{{1,6}} ') AS heading FROM {p}raw),
{p}subs AS (
  SELECT doc_id, pos, unnest(range(CAST(ceil(len(ws) / {L}) AS BIGINT))) AS sub, ws, heading
  FROM {p}wl WHERE len(ws) > 0),
{p}sublines AS (
  SELECT doc_id, pos, sub, array_to_string(ws[sub * {L} + 1 : sub * {L} + {L}], ' ') AS line,
         least({L}, len(ws) - sub * {L}) AS n, heading AND sub = 0 AS heading
  FROM {p}subs)"""


def chunk_ctes(L: int, P: int, O: int, p: str = "", src: str = "documents", markdown: bool = False) -> str:
    """CTEs ending in ``{p}chunks(doc_id, part_no, text, n_tokens, n_lines)``; needs WITH RECURSIVE."""
    B = P - O
    brk = f"(s.cur + o.n > {B} OR o.heading)" if markdown else f"s.cur + o.n > {B}"
    return f"""{sublines_sql(L, p, src)},
{p}ordered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos, sub) AS ord FROM {p}sublines),
{p}seq AS (
  SELECT doc_id, ord, n AS cur, 0 AS par FROM {p}ordered WHERE ord = 1
  UNION ALL
  SELECT o.doc_id, o.ord,
         CASE WHEN s.cur > 0 AND {brk} THEN o.n ELSE s.cur + o.n END,
         CASE WHEN s.cur > 0 AND {brk} THEN s.par + 1 ELSE s.par END
  FROM {p}seq s JOIN {p}ordered o ON o.doc_id = s.doc_id AND o.ord = s.ord + 1),
{p}par AS (SELECT o.doc_id, o.ord, s.par, o.line, o.n FROM {p}seq s JOIN {p}ordered o USING (doc_id, ord)),
{p}npar AS (SELECT doc_id, max(par) AS maxp FROM {p}par GROUP BY doc_id),
{p}suffix AS (
  SELECT *, sum(n) OVER (PARTITION BY doc_id, par ORDER BY ord DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS suf
  FROM {p}par),
{p}ov AS (
  SELECT s.doc_id, s.par + 1 AS par, s.ord, s.line, s.n FROM {p}suffix s JOIN {p}npar USING (doc_id)
  WHERE {O} > 0 AND s.suf <= {O} AND s.par < {p}npar.maxp),
{p}allp AS (SELECT doc_id, par, ord, line, n FROM {p}par UNION ALL SELECT doc_id, par, ord, line, n FROM {p}ov),
{p}chunks AS (
  SELECT doc_id, par AS part_no, string_agg(line, chr(10) ORDER BY ord) AS text,
         sum(n) AS n_tokens, count(*) AS n_lines
  FROM {p}allp GROUP BY doc_id, par)"""


def chunks_sql(L: int, P: int, O: int) -> str:
    return "WITH RECURSIVE " + chunk_ctes(L, P, O)


@register("c1_split_lines", f"""
WITH {sublines_sql(LINE_LIMIT)}
SELECT doc_id, CAST(pos AS INTEGER) AS pos, CAST(sub AS INTEGER) AS sub, line, CAST(n AS INTEGER) AS n_tokens
FROM sublines""")
def c1_split_lines(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return CH.split_lines(docs, max_tokens_per_line=LINE_LIMIT)


def _chunk_rows(spark, sf_dir, overlap):
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    ch = CH.chunk_documents(docs, max_tokens_per_line=LINE_LIMIT, max_tokens_per_paragraph=PARAGRAPH_LIMIT,
                            overlap_tokens=overlap)
    return ch.select(F.col("doc_id").cast("string").alias("document_id"), "part_no",
                     F.col("n_tokens").cast("bigint").alias("n_tokens"), F.col("n_lines").cast("bigint").alias("n_lines"),
                     F.length("text").cast("bigint").alias("n_chars"), F.sha2("text", 256).alias("sha256"))


CHUNK_OUT = """
SELECT CAST(doc_id AS VARCHAR) AS document_id, CAST(part_no AS INTEGER) AS part_no,
       CAST(n_tokens AS BIGINT) AS n_tokens, CAST(n_lines AS BIGINT) AS n_lines,
       CAST(length(text) AS BIGINT) AS n_chars, sha256(text) AS sha256
FROM chunks"""


@register("c2_pack_paragraphs", chunks_sql(LINE_LIMIT, PARAGRAPH_LIMIT, 0) + CHUNK_OUT)
def c2_pack_paragraphs(spark, sf_dir):
    return _chunk_rows(spark, sf_dir, 0)


@register("c3_overlap_chunks", chunks_sql(LINE_LIMIT, PARAGRAPH_LIMIT, OVERLAP) + CHUNK_OUT)
def c3_overlap_chunks(spark, sf_dir):
    return _chunk_rows(spark, sf_dir, OVERLAP)


# --- C4: markdown rule (conversations rendered as markdown, one heading per turn) ---

MD_SQL = """md AS (
  SELECT conv_id AS doc_id,
         string_agg('## ' || role || chr(10) || coalesce(text, ''), chr(10) ORDER BY turn) AS text
  FROM conversations GROUP BY conv_id)"""


def markdown_docs(spark, sf_dir):
    c = load(spark, sf_dir, "conversations")
    block = F.struct("turn", F.concat(F.lit("## "), F.col("role"), F.lit("\n"), F.coalesce("text", F.lit(""))).alias("b"))
    return c.groupBy(F.col("conv_id").alias("doc_id")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(block)), lambda x: x["b"]), "\n").alias("text"))


@register("c4_markdown_chunks", "WITH RECURSIVE " + MD_SQL + "," + chunk_ctes(LINE_LIMIT, 120, 0, src="md", markdown=True)
          + CHUNK_OUT)
def c4_markdown_chunks(spark, sf_dir):
    ch = CH.chunk_documents(markdown_docs(spark, sf_dir), max_tokens_per_line=LINE_LIMIT, max_tokens_per_paragraph=120,
                            overlap_tokens=0, markdown=True)
    return ch.select(F.col("doc_id").cast("string").alias("document_id"), "part_no",
                     F.col("n_tokens").cast("bigint").alias("n_tokens"), F.col("n_lines").cast("bigint").alias("n_lines"),
                     F.length("text").cast("bigint").alias("n_chars"), F.sha2("text", 256).alias("sha256"))


@register("c6_skip_empty", chunks_sql(LINE_LIMIT, PARAGRAPH_LIMIT, 0) + """
SELECT d.doc_id, coalesce(c.n, 0) AS n_chunks
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM chunks GROUP BY doc_id) c USING (doc_id)""")
def c6_skip_empty(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    ch = CH.chunk_documents(docs, max_tokens_per_line=LINE_LIMIT, max_tokens_per_paragraph=PARAGRAPH_LIMIT)
    counts = ch.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return docs.join(counts, "doc_id", "left").select("doc_id", F.coalesce("n", F.lit(0)).alias("n_chunks"))


# --- K2: byte -> symbol classes -------------------------------------------------

def _extended_bytes() -> list[str]:
    """Hex of the bytes that the byte table maps outside themselves (from its rule)."""
    from memweave.operators.bpe import bytes_to_unicode
    return [f"{b:02X}" for b, ch in bytes_to_unicode().items() if ord(ch) != b]


@register("k2_byte_symbols", f"""
SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
       CAST(len(list_filter(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                            lambda h: h IN ({", ".join("'" + h + "'" for h in _extended_bytes())}))) AS BIGINT) AS n_extended
FROM documents""")
def k2_byte_symbols(spark, sf_dir):
    docs = spread(load(spark, sf_dir, "documents"), "doc_id")
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    pairs = F.regexp_extract_all(F.hex(raw), F.lit("(..)"), 1)
    ext = _extended_bytes()
    return docs.select("doc_id", F.octet_length(raw).cast("bigint").alias("n_bytes"),
                       F.size(F.filter(pairs, lambda h: h.isin(*ext))).cast("bigint").alias("n_extended"))
