r"""Line-first cleaning.

Every line of a text is held against three rules: punctuation, navigation and
boilerplate. Lines that fail are removed; a document that loses more than
``max_lost`` of its word characters is rejected. Whole-document base rules
(too few words, too many words in repeated five-word windows) come first.

Rules (all per line, words are ``[^\x20\x09-\x0D]+``):

* punctuation: a line of ``min_sentence_words`` words or more holds no
  sentence mark (``. ! ? ...`` and their kin in other scripts);
* navigation: at least two separator words (``|``, ``>``, ``»`` ...) and they
  make a fifth of its words or more;
* boilerplate: it holds a stock phrase, a tenth of its characters or more are
  symbols, or at least three quarters of its words carry shouting marks
  (``!!``) or it repeats an earlier line of the text.

Edge cases: a null or empty text has no words, fails the base rules and is not
kept; blank lines pass every rule; repeated rows are judged each for itself;
other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StringType, StructField

from memweave.llm.bytespans import counts_per_row
from memweave.llm.textview import IS_CONTINUATION, IS_SYMBOL, TextView, byte_set, map_texts

#: Marks that end a sentence, as ASCII characters and as UTF-8 sequences.
SENTENCE_MARKS = b".!?"
WIDE_MARKS = ("…", "。", "！", "？", "؟", "।")
#: Words that separate menu entries.
SEPARATORS = ("|", "||", ">", ">>", "<", "»", "›", "«", "•", "·", "/", "::", "→")
#: Stock phrases, lower case.
STOCK_PHRASES = (
    "all rights reserved", "terms of service", "terms of use", "privacy policy", "cookie policy", "accept cookies", "we use cookies",
    "subscribe to our newsletter", "sign up for our newsletter", "click here to", "skip to content", "enable javascript",
    "javascript is disabled", "licensed under the", "is licensed under", "copyright (c)", "copyright ©", "share on facebook",
    "follow us on", "powered by", "lorem ipsum",
)

MARK_BYTE = byte_set(SENTENCE_MARKS)


def _positions(data: np.ndarray, pattern: bytes) -> np.ndarray:
    """Start of every occurrence of a byte pattern."""
    if len(data) < len(pattern):
        return np.zeros(0, np.int64)
    at = np.flatnonzero(data[:len(data) - len(pattern) + 1] == pattern[0])
    for k, b in enumerate(pattern[1:], 1):
        at = at[data[at + k] == b]
    return at


def _phrase_lines(view: TextView) -> np.ndarray:
    text = view.data.tobytes().lower()
    hit = np.zeros(len(view.lines[0]), bool)
    for phrase in STOCK_PHRASES:
        raw, at = phrase.encode(), 0
        while (at := text.find(raw, at)) >= 0:
            k = np.searchsorted(view.lines[0], at, side="right") - 1
            hit[k] |= at + len(raw) <= view.lines[1][k]
            at += 1
    return hit


def failed_lines(view: TextView, min_sentence_words: int = 8) -> np.ndarray:
    """Mask of the lines of a slice that fail a rule."""
    start, end, row = view.lines
    words = view.line_words
    marks = MARK_BYTE[view.data]
    for mark in WIDE_MARKS:
        marks[_positions(view.data, mark.encode())] = True
    no_sentence = (words >= min_sentence_words) & (view.within(marks, start, end) == 0)

    length = view.end - view.start
    separator = np.zeros(len(view.start), bool)
    for sep in SEPARATORS:
        raw = sep.encode()
        at = np.flatnonzero(length == len(raw))
        for k, b in enumerate(raw):
            at = at[view.data[view.start[at] + k] == b]
        separator[at] = True
    n_sep = np.bincount(view.line_of_word[separator], minlength=len(start))
    navigation = (n_sep >= 2) & (5 * n_sep >= words)

    chars = view.within(~IS_CONTINUATION[view.data], start, end)
    symbols = view.within(IS_SYMBOL[view.data], start, end)
    shout = np.zeros(len(view.start), bool)
    long = np.flatnonzero(length >= 3)
    shout[long] = (view.data[view.end[long] - 1] == 33) & (view.data[view.end[long] - 2] == 33)
    n_shout = np.bincount(view.line_of_word[shout], minlength=len(start))
    used = np.flatnonzero(words > 0)
    again = np.zeros(len(start), bool)
    again[used] = view.later_copies(row[used], view.line_hash[used])
    boilerplate = ((symbols > 0) & (10 * symbols >= chars)) | ((n_shout > 0) & (4 * n_shout >= 3 * words)) | _phrase_lines(view) | again
    return no_sentence | navigation | boilerplate


def clean_lines(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, *, min_words: int = 10,
                max_repeat_percent: int = 20, max_lost: float = 0.5, min_sentence_words: int = 8,
                with_text: bool = False) -> DataFrame:
    """Columns ``keep`` (default: all) plus counts, ``base_failed``, ``kept`` and, on request, ``clean_text``.

    ``clean_text`` is the text without its failed lines (null for a document
    that is not kept).
    """
    keep = list(docs.columns) if keep is None else keep
    out = [StructField(n, LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    out += [StructField("base_failed", BooleanType()), StructField("kept", BooleanType()),
            StructField("n_lines", LongType()), StructField("n_failed_lines", LongType()), StructField("kept_chars", LongType())]
    if with_text:
        out.append(StructField("clean_text", StringType()))

    def work(view: TextView) -> list[pa.Array]:
        start, end, row = view.lines
        chars = view.word_bytes & ~IS_CONTINUATION[view.data]
        word_chars = view.total(chars)
        repeat = view.repeated_words(5)
        base = (view.n_words < min_words) | (100 * repeat > max_repeat_percent * view.n_words)
        bad = failed_lines(view, min_sentence_words)
        good_chars = np.bincount(row, weights=np.where(bad, 0, view.within(chars, start, end)), minlength=view.rows).astype(np.int64)
        kept = ~base & (good_chars >= (1 - max_lost) * word_chars) & (good_chars > 0)
        cols = [view.n_words, word_chars, view.total(IS_SYMBOL[view.data]), view.n_dup_lines, repeat]
        cols = [pa.array(c.astype(np.int64)) for c in cols] + [pa.array(base), pa.array(kept)]
        cols += [pa.array(c.astype(np.int64)) for c in (counts_per_row(row, view.rows), counts_per_row(row[bad], view.rows), good_chars)]
        if with_text:
            raw, texts = view.data.tobytes(), []
            first = np.searchsorted(row, np.arange(view.rows + 1))
            for r in range(view.rows):
                own = range(first[r], first[r + 1])
                texts.append(b"\n".join(raw[start[k]:end[k]] for k in own if not bad[k]).decode() if kept[r] else None)
            cols.append(pa.array(texts, pa.string()))
        return cols

    return map_texts(docs, text_col, keep, out, work)
