"""Registered queries over generated files: Office documents (S4-S6), merge files (S9), BPE ids and counts (K4, K5), raw filter query.

The files are made from the given tables with Spark, so the work grows with
them, and go through the same readers as files from a folder.
"""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Iterable
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memweave.functions.parallel import slices, spread
from memweave.operators import bpe, chunking, search
from memweave.plans.catalog import register
from memweave.plans.fixtures import records, with_views
from memweave.plans.text_queries import CHUNK_OUT, WORD_RE2, chunk_ctes, sublines_sql
from memweave.session import scratch_dir
from memweave.sources import office
from memweave.sources.files import write_text_files
from memweave.sources.tables import load

REL_TAG = f'xmlns="{office.NS_PKG_REL}"'
PPT_TAG = f'xmlns:p="{office.NS_P}" xmlns:a="{office.NS_A}" xmlns:r="{office.NS_R}"'
XL_TAG = f'xmlns="{office.NS_S}" xmlns:r="{office.NS_R}"'


def _package(parts: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in parts.items():
            z.writestr(name, body)
    return out.getvalue()


def word_file(paragraphs: list[str]) -> bytes:
    body = "".join(f"<w:p><w:r><w:t>{escape(p)}</w:t></w:r></w:p>" for p in paragraphs)
    return _package({office.WORD_MAIN: f'<w:document xmlns:w="{office.NS_W}"><w:body>{body}</w:body></w:document>'})


def slide_file(text: str, hidden: bool) -> bytes:
    show = ' show="0"' if hidden else ""
    return _package({
        office.PPT_MAIN: f'<p:presentation {PPT_TAG}><p:sldIdLst><p:sldId id="256" r:id="rId1"/></p:sldIdLst></p:presentation>',
        "ppt/_rels/presentation.xml.rels": f'<Relationships {REL_TAG}><Relationship Id="rId1" Target="slides/slide1.xml"/></Relationships>',
        "ppt/slides/slide1.xml": f"<p:sld {PPT_TAG}{show}><p:cSld><a:t>{escape(text)}</a:t></p:cSld></p:sld>"})


def sheet_file(name: str, number: int) -> bytes:
    return _package({
        office.XL_MAIN: f'<workbook {XL_TAG}><sheets><sheet name="S1" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships {REL_TAG}><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/sharedStrings.xml": f"<sst {XL_TAG}><si><t>{escape(name)}</t></si></sst>",
        "xl/worksheets/sheet1.xml": f'<worksheet {XL_TAG}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1"/>'
                                    f'<c r="C1"><v>{number}</v></c></row></sheetData></worksheet>'})


def _files(rows: DataFrame, build) -> DataFrame:
    """(path, content) with one file per row (path, *arguments of ``build``)."""
    schema = pa.schema([("path", pa.string()), ("content", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            for part in slices(batch):
                paths, *args = [c.to_pylist() for c in part.columns]
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array([build(*r) for r in zip(*args)], pa.binary())], schema=schema)

    return rows.mapInArrow(run, "path string, content binary")


@register("s4_word_paragraphs", """
SELECT CAST(doc_id AS VARCHAR) AS doc, CAST(i - 1 AS INTEGER) AS pos, lines[i] AS text
FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL) d, unnest(range(1, len(lines) + 1)) t(i)""")
def s4_word_paragraphs(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").filter("text is not null")
    made = _files(docs.select(F.col("doc_id").cast("string").alias("path"), F.split("text", "\n").alias("lines")), lambda lines: word_file(list(lines)))
    return made.mapInArrow(office._files_to_rows("word"), office.PARAGRAPH_SCHEMA)


@register("s5_slide_texts", """
SELECT conv_id || '/' || turn AS doc, 1 AS slide_no, 0 AS pos, text, turn % 5 = 4 AS hidden FROM conversations WHERE text IS NOT NULL""")
def s5_slide_texts(spark, sf_dir):
    rows = load(spark, sf_dir, "conversations").filter("text is not null")
    made = _files(rows.select(F.concat_ws("/", "conv_id", "turn").alias("path"), "text", (F.col("turn") % 5 == 4).alias("h")), slide_file)
    return made.mapInArrow(office._files_to_rows("slides"), office.SLIDE_SCHEMA)


@register("s6_sheet_cells", """
SELECT CAST(s_suppkey AS VARCHAR) AS doc, 1 AS sheet_no, 1 AS row, 1 AS col, true AS is_text, s_name AS value FROM supplier
UNION ALL
SELECT CAST(s_suppkey AS VARCHAR), 1, 1, 3, false, CAST(s_nationkey AS VARCHAR) FROM supplier""")
def s6_sheet_cells(spark, sf_dir):
    rows = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("path"), "s_name", "s_nationkey")
    return _files(rows, sheet_file).mapInArrow(office._files_to_rows("cells"), office.CELL_SCHEMA)


@register("s9_load_merges", """
WITH pairs AS (SELECT unnest(regexp_extract_all(lower(text), '[a-z][a-z]')) AS pair FROM documents),
counted AS (SELECT pair, count(*) AS n FROM pairs GROUP BY pair)
SELECT CAST(row_number() OVER (ORDER BY n DESC, pair) - 1 AS INTEGER) AS rank, pair[1] AS "left", pair[2] AS "right" FROM counted""")
def s9_load_merges(spark, sf_dir):
    """Letter pairs of all documents by falling frequency, written as a merge file (at most 26 * 26 lines) and loaded."""
    pairs = load(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z][a-z]"), F.lit(0))).alias("pair"))
    counted = pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    lines = counted.select("n", F.concat(F.substring("pair", 1, 1), F.lit(" "), F.substring("pair", 2, 1)).alias("text"))
    header = spark.createDataFrame([(None, "#version: made from documents")], "n long, text string")
    ordered = header.union(lines).repartition(1).sortWithinPartitions(F.col("n").desc_nulls_first(), "text")
    path = f"{scratch_dir(spark, 's9')}/merges.txt"
    write_text_files(ordered, path)
    return bpe.load_merges(spark, path)


#: A small merge table in rank order; later merges may use the products of earlier ones.
MERGES = (("t", "h"), ("e", "r"), ("i", "n"), ("th", "e"), ("o", "n"), ("in", "g"), ("e", "n"), ("a", "n"), ("i", "on"), ("r", "e"), ("t", "ion"), ("d", "e"))


def _merged_bytes(text: str = "text") -> str:
    """DuckDB expression: bytes of the text after replacing, in rank order, each pair by one spare byte."""
    symbol, expr = {}, text
    for rank, (left, right) in enumerate(MERGES):
        code = lambda s: symbol.get(s, f"'{s}'")
        symbol[left + right] = f"chr({rank + 14})"  # control bytes that no text holds
        expr = f"replace({expr}, {code(left)} || {code(right)}, {symbol[left + right]})"
    return f"strlen({expr})"


@register("k5_bpe_counts", f"SELECT doc_id, CAST({_merged_bytes()} AS INTEGER) AS n_tokens FROM documents")
def k5_bpe_counts(spark, sf_dir):
    merges = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(MERGES)], "rank int, left string, right string")
    table = bpe.broadcast_vocabulary(merges)
    return load(spark, sf_dir, "documents").select("doc_id", bpe.count_bpe_tokens(F.col("text"), table).alias("n_tokens"))


def vocabulary_merges(spark):
    """The merge table of a public 50,000-entry byte-level vocabulary; its file is part of the environment."""
    import public_tokenizers

    return bpe.load_tokenizer_merges(spark, "file://" + os.path.abspath(public_tokenizers.path("byte_bpe_50k.json")))


@register("k4_encode")
def k4_encode(spark, sf_dir):
    """Ids of every document over a merge table of vocabulary size, as their number and a digest."""
    table = bpe.broadcast_vocabulary(vocabulary_merges(spark))
    ids = spread(load(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id").select("doc_id", bpe.encode("text", table).alias("ids"))
    return ids.select("doc_id", F.size("ids").alias("n_ids"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"))


@register("n6_filter_query", with_views("""
SELECT collection, namespace, key, lang FROM records WHERE lang = 'en' AND namespace = 'ns1' ORDER BY key LIMIT 10""", "records"))
def n6_filter_query(spark, sf_dir):
    """N6 without a vector: the first ten keys that match."""
    out = search.query(records(spark, sf_dir), top_k=10, namespace="ns1", where={"lang": "en"})
    return out.select("collection", "namespace", "key", "lang")


# With no line above the line limit every line is one sub-line, counted as a space before each of its words.
LINE_SQL = f"""
flat AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
worded AS (SELECT doc_id, pos, regexp_extract_all(raw, '{WORD_RE2}') AS ws FROM flat),
sublines AS (SELECT doc_id, pos, 0 AS sub, array_to_string(ws, ' ') AS line, CAST({_merged_bytes("(' ' || array_to_string(ws, ' '))")} AS INTEGER) AS n
             FROM worded WHERE len(ws) > 0)"""


@register("c2_bpe_chunks", "WITH RECURSIVE " + chunk_ctes(1, 900, 0).replace(sublines_sql(1, "", "documents"), LINE_SQL.strip()) + CHUNK_OUT)
def c2_bpe_chunks(spark, sf_dir):
    """Lines packed by BPE token counts; the line limit is above any line."""
    merges = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(MERGES)], "rank int, left string, right string")
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    ch = chunking.chunk_documents(docs, max_tokens_per_line=10**9, max_tokens_per_paragraph=900, mode="counter",
                                  word_counter=bpe.word_counter(bpe.broadcast_vocabulary(merges)))
    return ch.select(F.col("doc_id").cast("string").alias("document_id"), "part_no", F.col("n_tokens").cast("bigint").alias("n_tokens"),
                     F.col("n_lines").cast("bigint").alias("n_lines"), F.length("text").cast("bigint").alias("n_chars"), F.sha2("text", 256).alias("sha256"))
