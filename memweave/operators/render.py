"""Element rows -> document text.

Office readers (``memweave.sources.office``) emit one row per element
(paragraph, slide text, cell); these operators aggregate them back into the
text the reference readers produce. Each aggregation level is bounded by one
document (a row, a slide, a sheet), and ordering inside a group is an
``array_sort`` of ``(position, text)`` structs, not a global sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memweave.functions.arrays import let
from memweave.operators.tokens import WS_CLASS

# --- fixed values: default templates of the readers -------------------------
SLIDE_NUMBER_TEMPLATE = "# Slide {number}"
END_OF_SLIDE_TEMPLATE = "# End of slide {number}"
SHEET_NUMBER_TEMPLATE = "\n# Worksheet {number}\n"
END_OF_SHEET_TEMPLATE = "\n# End of worksheet {number}"
ROW_PREFIX = ""
COLUMN_SEPARATOR = ", "
ROW_SUFFIX = ""
# ---------------------------------------------------------------------------

_TRIM = rf"^[{WS_CLASS}]+|[{WS_CLASS}]+$"


def trim_ws(text: Column) -> Column:
    """Trim Unicode whitespace at both ends (Spark's ``trim`` strips spaces only)."""
    return F.regexp_replace(text, _TRIM, "")


def _fill(template: str, number: Column) -> Column:
    return F.regexp_replace(F.lit(template), r"(?i)\{number\}", number.cast("string"))


def _ordered_join(pos: str, text: str, sep: str) -> Column:
    """Join ``text`` of a group in ``pos`` order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos), F.col(text)))),
                                    lambda x: x[text]), sep)


def paragraphs_to_text(paragraphs: DataFrame, *, doc_col: str = "doc", pos_col: str = "pos",
                       text_col: str = "text") -> DataFrame:
    """Every paragraph in order, one per line, whole result trimmed."""
    return (paragraphs.groupBy(doc_col).agg(_ordered_join(pos_col, text_col, "\n").alias("_t"))
            .select(doc_col, trim_ws(F.col("_t")).alias("text")))


def slides_to_text(slide_texts: DataFrame, *, with_slide_number: bool = True, with_end_marker: bool = False,
                   skip_hidden: bool = True, slide_template: str = SLIDE_NUMBER_TEMPLATE,
                   end_template: str = END_OF_SLIDE_TEMPLATE, doc_col: str = "doc") -> DataFrame:
    """Texts of a slide joined by one space; slides in order.

    ``slide_no`` counts every slide, hidden or empty ones included, so a
    skipped slide leaves a gap in the numbering.
    """
    per_slide = (slide_texts.groupBy(doc_col, "slide_no")
                 .agg(_ordered_join("pos", "text", " ").alias("content"),
                      F.max(F.col("hidden").cast("int")).alias("_hidden")))
    keep = F.length("content") >= 1
    if skip_hidden:
        keep = keep & (F.col("_hidden") == 0)
    block = F.concat(
        _fill(slide_template, F.col("slide_no")) if with_slide_number else F.lit(""),
        F.lit("\n") if with_slide_number else F.lit(""),
        F.col("content"), F.lit("\n"),
        F.concat(_fill(end_template, F.col("slide_no")), F.lit("\n")) if with_end_marker else F.lit(""))
    blocks = per_slide.filter(keep).select(doc_col, "slide_no", block.alias("block"))
    return (blocks.groupBy(doc_col).agg(_ordered_join("slide_no", "block", "").alias("_t"))
            .select(doc_col, trim_ws(F.col("_t")).alias("text")))


def cells_to_text(cells: DataFrame, *, with_sheet_number: bool = True, with_end_marker: bool = False,
                  with_quotes: bool = True, sheet_template: str = SHEET_NUMBER_TEMPLATE,
                  end_template: str = END_OF_SHEET_TEMPLATE, row_prefix: str = ROW_PREFIX,
                  column_separator: str = COLUMN_SEPARATOR, row_suffix: str = ROW_SUFFIX,
                  doc_col: str = "doc", sheets: DataFrame | None = None) -> DataFrame:
    """Sheets as delimited text.

    Only used cells count: a blank cell is dropped, so later cells of the row
    shift left. Text cells are quoted with ``"`` doubled inside. With
    ``sheets`` (doc, sheet_no) every listed sheet is rendered, an empty one as
    its header (and end marker) only.
    """
    used = cells.filter(F.col("value").isNotNull() & (F.col("value") != ""))
    quoted = F.concat(F.lit('"'), F.replace(F.col("value"), F.lit('"'), F.lit('""')), F.lit('"'))
    cell = F.when(F.col("is_text"), quoted).otherwise(F.col("value")) if with_quotes else F.col("value")
    rows = (used.withColumn("_cell", cell).groupBy(doc_col, "sheet_no", "row")
            .agg(_ordered_join("col", "_cell", column_separator).alias("_line"))
            .withColumn("_line", F.concat(F.lit(row_prefix), F.col("_line"), F.lit(row_suffix), F.lit("\n"))))
    filled = rows.groupBy(doc_col, "sheet_no").agg(_ordered_join("row", "_line", "").alias("_rows"))
    if sheets is not None:
        listed = sheets.select(doc_col, "sheet_no").distinct()
        filled = (listed.join(filled, [doc_col, "sheet_no"], "full")
                  .withColumn("_rows", F.coalesce(F.col("_rows"), F.lit(""))))
    header = F.concat(_fill(sheet_template, F.col("sheet_no")), F.lit("\n")) if with_sheet_number else F.lit("")
    footer = F.concat(_fill(end_template, F.col("sheet_no")), F.lit("\n")) if with_end_marker else F.lit("")
    rendered = filled.select(doc_col, "sheet_no", F.concat(header, F.col("_rows"), footer).alias("_sheet"))
    return (rendered.groupBy(doc_col).agg(_ordered_join("sheet_no", "_sheet", "").alias("_t"))
            .select(doc_col, trim_ws(F.col("_t")).alias("text")))


def paginate(docs: DataFrame, *, lines_per_page: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """T4: (doc, page_no, text) pages of ``lines_per_page`` lines, map-side on each document row."""
    if lines_per_page <= 0:
        raise ValueError("lines_per_page must be > 0")
    n = lines_per_page

    def pages(lines):
        n_pages = F.ceil(F.size(lines) / F.lit(n)).cast("int")
        return F.transform(F.sequence(F.lit(0), F.greatest(n_pages - 1, F.lit(0))),
                           lambda p: F.struct((p + 1).alias("page_no"),
                                              F.array_join(F.slice(lines, p * n + 1, F.lit(n)), "\n").alias("text")))

    arr = let(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1), pages)
    return docs.select(id_col, F.explode(arr).alias("p")).select(id_col, "p.page_no", "p.text")
