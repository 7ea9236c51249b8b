"""One registered query for each operator, over its whole table with production parameters.

``QUERIES`` maps names to builders ``(spark, sf_dir) -> DataFrame``; ``SQL``
holds the DuckDB form of those that SQL can express.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memweave.functions.arrays import let
from memweave.llm import (bestfit, bpecount, chatformat, decontaminate, hardneg, htmltext, langid, linededup, linerules, neardup, packing, periodic,
                          quality)
from memweave.sources.tables import load

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), keep=["doc_id"])


@query
def op5_line_first_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linerules.clean_lines(load(spark, sf_dir, "documents"), keep=["doc_id"])


@query
def op6_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.group_near_duplicates(load(spark, sf_dir, "documents"), percent=85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
                        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))


@query
def op9_heap_bpe_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpecount.count_tokens(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), keep=["doc_id"])


#: The control conversation that op8 formats beside the table's rows.
CONTROL_CONVERSATION = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


@query
def op8_budgeted_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(CONTROL_CONVERSATION, "conv_id long, turn long, role string, text string")
    return chatformat.digests(chatformat.format_windows(rows.unionByName(extra)))


@query
def op1_optimal_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"))


@query
def op2_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


@query
def op7_deletion_neighbourhood_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = linededup.drop_repeated_lines(load(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


@query
def op10_byte_cnn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    rows = docs.select("doc_id", langid.held_out().alias("held_out"), "lang", "text")
    return langid.identify(rows, keep=["doc_id", "held_out"], train_filter=~F.col("held_out"))


@query
def op4_boosted_dom_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract_main_text(load(spark, sf_dir, "pages"), keep=["page_id", "url"])


@query
def op11_threshold_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hardneg.mine(rows, F.col("vec_id") % 50 == 0)


SQL["op11_threshold_hard_negatives"] = """
with raw as (
  select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.id as a, r.id as r, a.label = r.label as same, cast(list_inner_product(a.v, r.v) as bigint) as s
  from raw a join raw r on a.id % 50 = 0 and a.id <> r.id),
pos as (
  select a, r as p, s as ps from scored where same qualify row_number() over (partition by a order by s desc, r) <= 5)
select pos.a as anchor_id, pos.p as positive_id,
       cast(row_number() over (partition by pos.a, pos.p order by n.s desc, n.r) as integer) as rank,
       n.r as negative_id, pos.ps as positive_score, n.s as negative_score
from pos join scored n on n.a = pos.a and not n.same and 50 * pos.ps <= 100 * n.s and 100 * n.s <= 95 * pos.ps
qualify rank <= 3
"""


def periodic_copy(text: Column, doc_id: Column) -> Column:
    """The text with its words made periodic where crc32 of the id ends in 0; other texts, and those without an id, as they are."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def rewritten(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        word = lambda i: F.element_at(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int") + 1)
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), word), " ")).otherwise("")

    return F.when(h % 10 == 0, let(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)), rewritten)).otherwise(text)


@query
def op12_difference_cover_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", periodic_copy(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic.find_runs(docs, keep=["doc_id"])
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    found = found.withColumn("top", top)
    return found.select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.back")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.short")).alias("period"), F.expr("1000 * top.length div -top.short").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op13_bound_certified_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    cut = bestfit.pieces(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), keep=["doc_id"])
    return bestfit.pack(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))).rows


def _quoted(words) -> str:
    return ", ".join("'" + w + "'" for w in words)


SQL["op5_line_first_cleaning"] = rf"""
with docs as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
words as (select doc_id, unnest(ws) as w, unnest(range(len(ws))) as i from docs),
windows as (
  select doc_id, i, [w, lead(w, 1) over p, lead(w, 2) over p, lead(w, 3) over p, lead(w, 4) over p] as five, lead(w, 4) over p as last
  from words window p as (partition by doc_id order by i)),
twice as (select doc_id, i from windows where last is not null qualify count(*) over (partition by doc_id, five) > 1),
repeated as (select doc_id, count(distinct i + k) as n from twice, range(5) r(k) group by doc_id),
split as (select doc_id, string_split(text, chr(10)) as ls from docs),
lines as (select doc_id, unnest(ls) as line, unnest(range(len(ls))) as pos from split),
read as (
  select doc_id, pos, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') as ws,
         translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low,
         length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) as symbols,
         row_number() over (partition by doc_id, line order by pos) > 1 as seen
  from lines),
counted as (
  select doc_id, symbols, len(ws) as n, len(ws) > 0 and seen as again,
         coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) as chars,
         len(list_filter(ws, lambda w: w in ({_quoted(linerules.SEPARATORS)}))) as seps,
         len(list_filter(ws, lambda w: suffix(w, '!!') and strlen(w) >= 3)) as shouts,
         regexp_matches(line, '[.!?{"".join(linerules.WIDE_MARKS)}]') as ends, length(line) as width,
         len(list_filter([{_quoted(linerules.STOCK_PHRASES)}], lambda x: contains(low, x))) > 0 as stock
  from read),
judged as (
  select *, (n >= 8 and not ends) or (seps >= 2 and 5 * seps >= n) or (symbols > 0 and 10 * symbols >= width)
            or (shouts > 0 and 4 * shouts >= 3 * n) or stock or again as bad
  from counted),
sums as (
  select doc_id, sum(n) as n_words, sum(chars) as word_chars, sum(symbols) as n_symbols, count(*) filter (again) as n_dup_lines,
         count(*) as n_lines, count(*) filter (bad) as n_failed_lines, coalesce(sum(chars) filter (not bad), 0) as kept_chars
  from judged group by doc_id),
based as (
  select s.*, coalesce(r.n, 0) as n_repeat_words, n_words < 10 or 100 * coalesce(r.n, 0) > 20 * n_words as base_failed
  from sums s left join repeated r using (doc_id))
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
       n_dup_lines, n_repeat_words, base_failed, not base_failed and 2 * kept_chars >= word_chars and kept_chars > 0 as kept,
       n_lines, n_failed_lines, cast(kept_chars as bigint) as kept_chars
from based
"""


SQL["op6_superminhash"] = r"""
with recursive docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as ws from documents),
words as (select doc_id, len(ws) as n, unnest(ws) as w, unnest(range(len(ws))) as i from docs),
windows as (
  select doc_id, i, [w, lead(w, 1) over p, lead(w, 2) over p, lead(w, 3) over p, lead(w, 4) over p] as five, n
  from words window p as (partition by doc_id order by i)),
sets as materialized (select distinct doc_id, hash(five) as h, five from windows where i = 0 or i + 5 <= n),
sizes as materialized (select doc_id, count(*) as n from sets group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as n from sets a join sets b on a.h = b.h and a.five = b.five and a.doc_id < b.doc_id
  group by all),
links as materialized (
  select a, b from common c join sizes x on x.doc_id = c.a join sizes y on y.doc_id = c.b where 100 * c.n >= 85 * (x.n + y.n - c.n)),
ways as materialized (select a, b from links union all select b, a from links),
reach as (
  select doc_id, doc_id as other from docs
  union
  select r.doc_id, w.b from reach r join ways w on w.a = r.other)
select d.doc_id, coalesce(z.n, 0) as n_shingles, c.component_id, c.component_id = d.doc_id as kept
from docs d left join sizes z using (doc_id) join (select doc_id, min(other) as component_id from reach group by doc_id) c using (doc_id)
"""
