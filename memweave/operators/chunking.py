"""Token-budgeted chunking.

Contract (the original splitter is not available, so these rules are ours):

* C1 lines: the text is split on ``\\n``; each line's words (Unicode
  whitespace-separated) are packed greedily into sub-lines of at most
  ``max_tokens_per_line`` tokens, joined by one space. A word above the limit
  stays whole. Lines without words are dropped.
* C2 paragraphs: sub-lines are packed greedily: a sub-line that would push
  the running count above ``max_tokens_per_paragraph - overlap_tokens`` opens
  a new paragraph (an empty paragraph never closes).
* C3 overlap: paragraph p > 0 is prefixed with the longest run of whole
  trailing sub-lines of paragraph p - 1 whose token sum is at most
  ``overlap_tokens``. A finished chunk therefore stays within
  ``max_tokens_per_paragraph`` unless a single sub-line alone exceeds it.
* C4 markdown: a heading line (``#`` to ``######`` then a space) always starts
  a new paragraph, and a fenced code block is one unit that is never split.

Execution: one document is one row, and everything happens on that row with
Catalyst array functions (``transform``/``aggregate``/``slice``), so chunking is
a map-only stage: no shuffle and no Python. A document's sub-lines are packed
by one left fold (linear in sub-lines); chunks are built with ``slice``.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memweave.functions.arrays import empty, let, sum_ints
from memweave.functions.parallel import spread
from memweave.operators.tokens import PRETOKEN_PATTERN, words

CHUNK_MODES = ("whitespace", "pretoken", "counter")
HEADING_PATTERN = r"^#{1,6} "
FENCE_PATTERN = r"^\s*```"


def validate(max_tokens_per_line: int, max_tokens_per_paragraph: int, overlap_tokens: int) -> None:
    if max_tokens_per_line <= 0 or max_tokens_per_paragraph <= 0:
        raise ValueError("token limits must be > 0")
    if overlap_tokens < 0 or overlap_tokens >= max_tokens_per_paragraph:
        raise ValueError("overlap must be >= 0 and smaller than the paragraph limit")


def _empty(t: str) -> Column:
    return empty(t)


def greedy_starts(counts: Column, budget: int, breaks: Column | None = None) -> Column:
    """0-based start index of each group when packing ``counts`` greedily.

    An item opens a new group when the current group is non-empty and adding
    it would exceed ``budget``, or when ``breaks[i]`` is true. ``counts`` must
    be a lambda variable or a column (it is read once).
    """
    init = F.struct(F.lit(0).alias("cur"), F.lit(0).alias("i"), _empty("int").alias("starts"))
    items = counts if breaks is None else F.arrays_zip(counts.alias("n"), breaks.alias("b"))

    def step(acc, item):
        n = item if breaks is None else item["n"]
        brk = F.lit(False) if breaks is None else item["b"]
        opens = (acc["i"] == 0) | ((acc["cur"] > 0) & ((acc["cur"] + n > budget) | brk))
        return F.struct(F.when(opens, n).otherwise(acc["cur"] + n).alias("cur"),
                        (acc["i"] + 1).alias("i"),
                        F.when(opens, F.concat(acc["starts"], F.array(acc["i"]))).otherwise(acc["starts"]).alias("starts"))

    return F.aggregate(items, init, step, lambda acc: acc["starts"])


def _group_bounds(starts: Column, total: Column, g: Column) -> tuple[Column, Column]:
    """(start, length) of group g; ``starts`` and ``total`` must be cheap (lambda variables)."""
    start = F.get(starts, g)
    end = F.when(g + 1 < F.size(starts), F.get(starts, g + 1)).otherwise(total)
    return start, end - start


def _groups(starts: Column, fn) -> Column:
    return F.transform(F.sequence(F.lit(0), F.greatest(F.size(starts) - 1, F.lit(0))), fn)


PART_TYPE = "array<struct<pos:int,sub:int,line:string,n_tokens:int,heading:boolean>>"


def units_of(text: Column, markdown: bool = False) -> Column:
    """The lines of a text; with ``markdown`` each fenced block is one of them."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return _fence_units(lines) if markdown else lines


def sub_lines(text: Column, max_tokens_per_line: int, mode: str = "whitespace",
              markdown: bool = False, word_counts: Column | None = None) -> Column:
    """array<struct<pos:int, sub:int, line:string, n_tokens:int, heading:boolean>>.

    In mode ``counter`` the tokens of every word of every line (of
    ``units_of``) come from ``word_counts`` (array<array<int>>).
    """
    if mode not in CHUNK_MODES:
        raise ValueError(f"mode must be one of {CHUNK_MODES}")
    if (mode == "counter") != (word_counts is not None):
        raise ValueError("mode counter and word_counts go together")
    lines = units_of(text, markdown)
    L = max_tokens_per_line

    def per_line(line, pos):
        heading = F.lit(False) if not markdown else line.rlike(HEADING_PATTERN)
        fenced = F.lit(False) if not markdown else line.rlike(FENCE_PATTERN)

        def mk(text_c, ntok, sub):
            return F.struct(pos.cast("int").alias("pos"), sub.cast("int").alias("sub"), text_c.alias("line"),
                            ntok.cast("int").alias("n_tokens"), (heading & (sub == 0)).alias("heading"))

        def build(ws):
            n = F.size(ws)
            if mode == "whitespace":
                n_sub = F.ceil(n / F.lit(L)).cast("int")
                parts = F.transform(F.sequence(F.lit(0), F.greatest(n_sub - 1, F.lit(0))),
                                    lambda i: mk(F.array_join(F.slice(ws, i * L + 1, F.lit(L)), " "),
                                                 F.least(F.lit(L), n - i * L), i))
            else:
                def with_counts(wc):
                    def with_starts(st):
                        def one(g):
                            b0, bl = _group_bounds(st, n, g)
                            return mk(F.array_join(F.slice(ws, b0 + 1, bl), " "), sum_ints(F.slice(wc, b0 + 1, bl)), g)
                        return _groups(st, one)
                    return let(greedy_starts(wc, L), with_starts)
                counts = (F.get(word_counts, pos) if mode == "counter"
                          else F.transform(ws, lambda w: F.regexp_count(w, F.lit(PRETOKEN_PATTERN)).cast("int")))
                parts = let(counts, with_counts)
            if markdown:
                # A fenced block is one unit: kept verbatim, counted as a whole.
                whole = sum_ints(F.get(word_counts, pos)) if mode == "counter" else n
                parts = F.when(fenced, F.array(mk(line, whole, F.lit(0)))).otherwise(parts)
            return F.when(n > 0, parts).otherwise(F.array().cast(PART_TYPE))

        return let(words(line), build)

    return F.flatten(F.transform(lines, per_line))


def _fence_units(lines: Column) -> Column:
    """Merge each fenced code block (opening fence to closing fence) into one element.

    A line starts a new unit unless an odd number of fence lines precede it
    (then it lies inside an open block or closes it). Fence positions are
    found once, so the cost is lines x fences, not lines squared.
    """
    def with_lines(ls):
        n = F.size(ls)
        fence_pos = F.filter(F.transform(ls, lambda l, i: F.when(l.rlike(FENCE_PATTERN), i).otherwise(F.lit(-1))),
                             lambda x: x >= 0)

        def with_fences(fp):
            starts = F.filter(F.sequence(F.lit(0), n - 1),
                              lambda i: F.size(F.filter(fp, lambda p: p < i)) % 2 == 0)

            def with_starts(st):
                def unit(g):
                    b0, bl = _group_bounds(st, n, g)
                    return F.array_join(F.slice(ls, b0 + 1, bl), "\n")
                return _groups(st, unit)

            return let(starts, with_starts)

        return let(fence_pos, with_fences)

    return let(lines, with_lines)


CHUNK_TYPE = "array<struct<part_no:int,text:string,n_tokens:int,n_lines:int>>"


def _build_chunks(counts: Column, texts: Column, starts: Column, total: Column, overlap_tokens: int) -> Column:
    """Chunk structs from group starts; all arguments must be lambda variables (cheap)."""
    def overlap_len(g):
        prev_start, prev_len = _group_bounds(starts, total, g - 1)
        prev_counts = F.reverse(F.slice(counts, prev_start + 1, prev_len))
        init = F.struct(F.lit(0).alias("s"), F.lit(0).alias("n"), F.lit(False).alias("stop"))

        def step(acc, c):
            stop = acc["stop"] | (acc["s"] + c > overlap_tokens)
            return F.struct(F.when(stop, acc["s"]).otherwise(acc["s"] + c).alias("s"),
                            F.when(stop, acc["n"]).otherwise(acc["n"] + 1).alias("n"),
                            stop.alias("stop"))

        return F.when(g > 0, F.aggregate(prev_counts, init, step, lambda a: a["n"])).otherwise(F.lit(0))

    def chunk(g):
        start, length = _group_bounds(starts, total, g)

        def with_ov(ov):
            first = start - ov
            n_lines = length + ov
            return F.struct(g.cast("int").alias("part_no"),
                            F.array_join(F.slice(texts, first + 1, n_lines), "\n").alias("text"),
                            sum_ints(F.slice(counts, first + 1, n_lines)).alias("n_tokens"),
                            n_lines.alias("n_lines"))

        return with_ov(F.lit(0)) if overlap_tokens == 0 else let(overlap_len(g), with_ov)

    return _groups(starts, chunk)


def _columns_of(ps: Column) -> Column:
    return F.struct(F.transform(ps, lambda p: p["n_tokens"]).alias("counts"),
                    F.transform(ps, lambda p: p["line"]).alias("texts"),
                    F.transform(ps, lambda p: p["heading"]).alias("breaks"))


def paragraphs(parts: Column, max_tokens_per_paragraph: int, overlap_tokens: int,
               markdown: bool = False, starts: Column | None = None) -> Column:
    """C2 + C3: array<struct<part_no, text, n_tokens, n_lines>> from C1 sub-lines.

    Group starts come from the Catalyst fold, or from ``starts`` when given
    (the pandas-UDF packer).
    """
    budget = max_tokens_per_paragraph - overlap_tokens

    def with_both(b):
        ps = b["parts"]
        total = F.size(ps)

        def with_cols(cs):
            def with_starts(st):
                return _build_chunks(cs["counts"], cs["texts"], st, total, overlap_tokens)
            if starts is not None:
                return with_starts(b["starts"])
            return let(greedy_starts(cs["counts"], budget, cs["breaks"] if markdown else None), with_starts)

        return F.when(total > 0, let(_columns_of(ps), with_cols)).otherwise(F.array().cast(CHUNK_TYPE))

    bundle = F.struct(parts.alias("parts"), (starts if starts is not None else F.lit(None)).alias("starts"))
    return let(bundle, with_both)


def _greedy_udf(budget: int):
    """Greedy starts over int arrays in Python: linear in sub-lines, only ints cross the boundary."""
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def greedy(counts: pd.Series, breaks: pd.Series) -> pd.Series:
        out = []
        for cs, bs in zip(counts, breaks):
            starts, cur = [], 0
            if cs is not None:
                for i, (n, b) in enumerate(zip(cs, bs)):
                    if i == 0 or (cur > 0 and (cur + n > budget or b)):
                        starts.append(i)
                        cur = n
                    else:
                        cur += n
            out.append(starts)
        return pd.Series(out)

    return greedy


def split_lines(docs: DataFrame, *, max_tokens_per_line: int, mode: str = "whitespace",
                id_col: str = "doc_id", text_col: str = "text", markdown: bool = False) -> DataFrame:
    """C1 as rows: (id, pos, sub, line, n_tokens)."""
    if max_tokens_per_line <= 0:
        raise ValueError("max_tokens_per_line must be > 0")
    parts = sub_lines(F.col(text_col), max_tokens_per_line, mode, markdown)
    return (spread(docs, id_col).select(id_col, F.explode(parts).alias("p"))
            .select(id_col, "p.pos", "p.sub", "p.line", "p.n_tokens"))


PACKERS = ("fold", "udf")


def chunk_documents(docs: DataFrame, *, max_tokens_per_line: int, max_tokens_per_paragraph: int,
                    overlap_tokens: int = 0, mode: str = "whitespace", markdown: bool | Column = False,
                    id_col: str = "doc_id", text_col: str = "text", keep_cols=(), packer: str = "fold",
                    word_counter: Callable[[Column], Column] | None = None) -> DataFrame:
    """C1-C3 (+C4, C6): one row per chunk (id, part_no, text, n_tokens, n_lines).

    Documents with no words produce no chunks (C6). ``markdown`` may be a
    boolean column (e.g. from the MIME type) to pick the rule per document.
    ``packer='fold'`` keeps everything in Catalyst (cost grows with the square
    of a document's chunk count); ``packer='udf'`` sends only the sub-line
    token counts to a pandas UDF for the greedy pass (linear), for corpora
    with very long documents. Both give the same chunks.

    With ``mode='counter'`` budgets count what ``word_counter`` says: it maps
    the words of every line (array<array<string>>) to their token counts
    (array<array<int>>), as ``bpe.word_counter`` does with a merge table.
    """
    validate(max_tokens_per_line, max_tokens_per_paragraph, overlap_tokens)
    if packer not in PACKERS:
        raise ValueError(f"packer must be one of {PACKERS}")
    text = F.col(text_col)
    source, counts = spread(docs, id_col), None
    if mode == "counter":
        if word_counter is None or packer != "fold":
            raise ValueError("mode counter needs a word_counter and the fold packer")
        units = (F.when(markdown, units_of(text, True)).otherwise(units_of(text)) if isinstance(markdown, Column)
                 else units_of(text, bool(markdown)))
        source = source.withColumn("_word_counts", word_counter(F.transform(units, words)))
        counts = F.col("_word_counts")
    if packer == "udf":
        def parts_of(md: bool) -> Column:
            return sub_lines(text, max_tokens_per_line, mode, md, counts)
        parts = (F.when(markdown, parts_of(True)).otherwise(parts_of(False)) if isinstance(markdown, Column)
                 else parts_of(bool(markdown)))
        staged = source.select(id_col, *keep_cols, parts.alias("_parts"))
        staged = staged.withColumn("_starts", _greedy_udf(max_tokens_per_paragraph - overlap_tokens)(
            F.transform("_parts", lambda p: p["n_tokens"]), F.transform("_parts", lambda p: p["heading"])))
        chunks = paragraphs(F.col("_parts"), max_tokens_per_paragraph, overlap_tokens, starts=F.col("_starts"))
        return (staged.select(id_col, *keep_cols, F.explode(chunks).alias("c"))
                .select(id_col, *keep_cols, "c.part_no", "c.text", "c.n_tokens", "c.n_lines"))

    def build(md: bool) -> Column:
        return paragraphs(sub_lines(text, max_tokens_per_line, mode, md, counts), max_tokens_per_paragraph,
                          overlap_tokens, md)

    if isinstance(markdown, Column):
        chunks = F.when(markdown, build(True)).otherwise(build(False))
    else:
        chunks = build(bool(markdown))
    return (source.select(id_col, *keep_cols, F.explode(chunks).alias("c"))
            .select(id_col, *keep_cols, "c.part_no", "c.text", "c.n_tokens", "c.n_lines"))


def short_id(*parts: Column) -> Column:
    """Deterministic 32-hex id (replaces random GUIDs so reruns are idempotent)."""
    return F.substring(F.sha2(F.concat_ws("/", *parts), 256), 1, 32)
