"""Document import and partition artifacts.

The pipeline's file tree is a flat ``artifacts`` table, one row per file:

    document_id, file_id, artifact_id, parent_id, source_partition_id, name,
    size, mime_type, artifact_type, sha256, tags (map<string, array<string>>)

plus the payload columns a stage needs (``text``, ``url``). Ids are hashes of
their parents and positions instead of random GUIDs, so a rerun produces the
same ids and purging stale records (B5) is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memweave.functions.parallel import spread
from memweave.operators.chunking import chunk_documents, short_id

# --- fixed values: MIME types, artifact types and file names of the pipeline --
MIME_PLAIN_TEXT = "text/plain"
MIME_MARKDOWN = "text/markdown"
MIME_HTML = "text/html"
MIME_WEB_PAGE_URL = "text/x-uri"
MIME_EMBEDDING = "float[]"
TYPE_EXTRACTED_TEXT = "extracted_text"
TYPE_TEXT_PARTITION = "text_partition"
TYPE_SYNTHETIC_DATA = "synthetic_data"
TYPE_EMBEDDING = "text_embedding_vector"
TEXT_FILE_NAME = "content.txt"
WEB_FILE_NAME = "content.url"
EMBEDDING_EXTENSION = ".text_embedding"
# ---------------------------------------------------------------------------

PARTITIONABLE_MIME = (MIME_PLAIN_TEXT, MIME_MARKDOWN)


def user_tags(cols: Sequence[str]) -> Column:
    """Tags from columns: ``{col: [value]}`` for every non-null value."""
    if not cols:
        return F.create_map().cast("map<string,array<string>>")
    entries = F.array(*[F.struct(F.lit(c).alias("key"), F.array(F.col(c).cast("string")).alias("value")) for c in cols])
    return F.map_from_entries(F.filter(entries, lambda e: F.get(e["value"], 0).isNotNull()))


def import_text(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                tag_cols: Sequence[str] = ("lang", "source")) -> DataFrame:
    """Every document becomes a ``content.txt`` extracted-text artifact."""
    document_id = F.col(id_col).cast("string")
    file_id = short_id(document_id, F.lit(TEXT_FILE_NAME))
    return docs.select(
        document_id.alias("document_id"), file_id.alias("file_id"), file_id.alias("artifact_id"),
        F.lit(None).cast("string").alias("parent_id"), F.lit(None).cast("string").alias("source_partition_id"),
        F.lit(TEXT_FILE_NAME).alias("name"), F.length(text_col).cast("int").alias("size"),
        F.lit(MIME_PLAIN_TEXT).alias("mime_type"), F.lit(TYPE_EXTRACTED_TEXT).alias("artifact_type"),
        F.sha2(F.col(text_col), 256).alias("sha256"), user_tags(list(tag_cols)).alias("tags"),
        F.col(text_col).alias("text"), source_url(F.lit(MIME_PLAIN_TEXT), F.lit("")).alias("url"))


# Regular expressions for page text (valid in Java and RE2 alike).
_DROP_BLOCKS = (r"(?is)<script\b.*?</script>", r"(?is)<style\b.*?</style>", r"(?is)<nav\b.*?</nav>")
_TAG = r"(?s)<[^>]*>"
_SPACES = r"[ \t\n\r\f]+"
# --- fixed values: HTML entities decoded in page text (``&amp;`` last) -------
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def html_to_text(html: Column) -> Column:
    """Drop script/style/nav blocks and tags, decode basic entities, squeeze spaces."""
    t = html
    for pat in _DROP_BLOCKS:
        t = F.regexp_replace(t, pat, " ")
    t = F.regexp_replace(t, _TAG, " ")
    for ent, ch in _ENTITIES:
        t = F.replace(t, F.lit(ent), F.lit(ch))
    return F.trim(F.regexp_replace(t, _SPACES, " "))


def import_web_pages(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
                     html_col: str = "html") -> DataFrame:
    """A fetched page becomes a URL file plus its extracted text.

    Returns artifact rows of the extracted text; ``url`` carries the page URL
    because the uploaded file has the web-page MIME type.
    """
    document_id = F.col(id_col).cast("string")
    url_file = short_id(document_id, F.lit(WEB_FILE_NAME))
    text = html_to_text(F.col(html_col))
    return spread(pages, id_col).select(
        document_id.alias("document_id"), url_file.alias("file_id"),
        short_id(url_file, F.lit(TYPE_EXTRACTED_TEXT)).alias("artifact_id"),
        url_file.alias("parent_id"), F.lit(None).cast("string").alias("source_partition_id"),
        F.concat(F.lit(WEB_FILE_NAME), F.lit(".extract.txt")).alias("name"),
        F.length(text).cast("int").alias("size"), F.lit(MIME_PLAIN_TEXT).alias("mime_type"),
        F.lit(TYPE_EXTRACTED_TEXT).alias("artifact_type"), F.sha2(text, 256).alias("sha256"),
        F.create_map().cast("map<string,array<string>>").alias("tags"),
        text.alias("text"), source_url(F.lit(MIME_WEB_PAGE_URL), F.col(url_col)).alias("url"))


def source_url(upload_mime: Column, url: Column) -> Column:
    """The ``url`` payload: the page URL for web-page uploads, else ''."""
    return F.when(upload_mime == MIME_WEB_PAGE_URL, url).otherwise(F.lit(""))


def partition_gate(artifacts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Only extracted text in plain text or markdown is partitioned.

    Returns ``(accepted, rejected)``; a NULL MIME type is rejected, and other artifact types pass through neither.
    """
    extracted = artifacts.filter(F.col("artifact_type") == TYPE_EXTRACTED_TEXT)
    ok = F.col("mime_type").isin(*PARTITIONABLE_MIME)
    return extracted.filter(ok), extracted.filter(~F.coalesce(ok, F.lit(False)))


def partition_artifacts(files: DataFrame, *, max_tokens_per_line: int, max_tokens_per_paragraph: int,
                        overlap_tokens: int = 0, mode: str = "whitespace") -> DataFrame:
    """Partition accepted text files into chunk artifacts.

    ``files`` are artifact rows with ``text``; markdown files use the
    markdown rule. Each chunk row carries its text, token count and a
    descriptor: id from (file, index), name ``{file}.partition.{n}.txt``,
    size in characters, SHA-256 and the file's tags.
    """
    md = F.col("mime_type") == MIME_MARKDOWN
    chunks = chunk_documents(
        files.withColumnRenamed("artifact_id", "_src_id").withColumn("_md", md),
        max_tokens_per_line=max_tokens_per_line, max_tokens_per_paragraph=max_tokens_per_paragraph,
        overlap_tokens=overlap_tokens, mode=mode, markdown=F.col("_md"), id_col="_src_id", text_col="text",
        keep_cols=("document_id", "file_id", "name", "tags", "url", "mime_type"))
    part_id = short_id(F.col("file_id"), F.col("part_no").cast("string"))
    return chunks.select(
        "document_id", "file_id", part_id.alias("artifact_id"), F.col("file_id").alias("parent_id"),
        F.lit(None).cast("string").alias("source_partition_id"),
        F.concat(F.col("name"), F.lit(".partition."), F.col("part_no").cast("string"), F.lit(".txt")).alias("name"),
        F.length("text").cast("int").alias("size"), F.lit(MIME_PLAIN_TEXT).alias("mime_type"),
        F.lit(TYPE_TEXT_PARTITION).alias("artifact_type"), F.sha2("text", 256).alias("sha256"), "tags",
        "text", "url", F.col("mime_type").alias("upload_mime"), F.col("name").alias("file_name"),
        "part_no", "n_tokens", "n_lines")


def artifacts_of_type(artifacts: DataFrame, *types: str) -> DataFrame:
    """The generated files of the given artifact types."""
    return artifacts.filter(F.col("artifact_type").isin(*types))
