"""Words and lines of one slice of texts, with per-row counts (helper of the text operators)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from memweave.llm.bytespans import (BYTE_LOWER, Hasher, counts_per_row, mix, release_memory, row_of, slices, windows, word_spans, Sequences)

#: Characters counted as symbols.
SYMBOLS = b"#*$%&|<>"


def byte_set(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


IS_SYMBOL = byte_set(SYMBOLS)
IS_CONTINUATION = np.zeros(256, bool)
IS_CONTINUATION[0x80:0xC0] = True
#: ASCII punctuation: stripped from both ends of a word where a rule compares bare words.
IS_PUNCT = byte_set(bytes(b for b in range(33, 127) if not chr(b).isalnum()))
IS_UPPER = byte_set(bytes(range(65, 91)))
IS_LETTER = byte_set(bytes([*range(65, 91), *range(97, 123)])) | (np.arange(256) >= 0xC3)


def line_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r"""(start, end, row) of the lines of every row, split at ``\n``."""
    breaks = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([offs[:-1], breaks + 1]))
    end = np.sort(np.concatenate([breaks, offs[1:]]))
    row = np.repeat(np.arange(len(offs) - 1), 1 + counts_per_row(row_of(breaks, offs), len(offs) - 1))
    return start, end, row


class TextView:
    """Lazy arrays over the texts of one slice; ``rows`` is their number."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data, self.offs, self.rows = data, offs, len(offs) - 1
        self.start, self.end, self.row = word_spans(data, offs)

    def total(self, mask: np.ndarray) -> np.ndarray:
        """Number of set bytes in each row."""
        sums = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=sums[1:])
        return sums[self.offs[1:]] - sums[self.offs[:-1]]

    def within(self, mask: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of set bytes in each span."""
        sums = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=sums[1:])
        return sums[end] - sums[start]

    def per_row(self, values: np.ndarray, row: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(self.row if row is None else row, weights=values, minlength=self.rows)

    @cached_property
    def n_words(self) -> np.ndarray:
        return counts_per_row(self.row, self.rows)

    @cached_property
    def word_bytes(self) -> np.ndarray:
        """Mask of bytes that belong to words."""
        edge = np.zeros(len(self.data) + 1, np.int8)
        edge[self.start] += 1
        edge[self.end] -= 1
        return np.cumsum(edge[:-1], dtype=np.int8).astype(bool)

    @cached_property
    def word_hash(self) -> np.ndarray:
        return Hasher(self.data).spans(self.start, self.end)

    @cached_property
    def bare(self) -> tuple[np.ndarray, np.ndarray]:
        """Word spans without ASCII punctuation at both ends; a word of punctuation alone becomes empty."""
        punct = IS_PUNCT[self.data]
        pos = np.arange(len(self.data), dtype=np.int64)
        # nearest byte at or after a position, and at or before it, that is no punctuation
        after = np.minimum.accumulate(np.where(punct, len(self.data), pos)[::-1])[::-1]
        before = np.maximum.accumulate(np.where(punct, -1, pos))
        start = np.minimum(after[self.start], self.end) if len(self.start) else self.start
        end = np.maximum(before[self.end - 1] + 1, start) if len(self.start) else self.end
        return start, end

    @cached_property
    def bare_hash(self) -> np.ndarray:
        """Hash of the lower-cased (A-Z) word without punctuation at its ends."""
        return Hasher(self.data, BYTE_LOWER).spans(*self.bare)

    @cached_property
    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        r"""(start, end, row) of the lines of every row, split at ``\n``."""
        return line_spans(self.data, self.offs)

    @cached_property
    def line_of_word(self) -> np.ndarray:
        return np.searchsorted(self.lines[0], self.start, side="right") - 1

    @cached_property
    def line_words(self) -> np.ndarray:
        return np.bincount(self.line_of_word, minlength=len(self.lines[0]))

    @cached_property
    def line_hash(self) -> np.ndarray:
        return Hasher(self.data).spans(self.lines[0], self.lines[1])

    def later_copies(self, row: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Mask of items whose key occurred earlier in the same row."""
        both = mix(key + row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        order = np.argsort(both, kind="stable")
        out = np.zeros(len(both), bool)
        out[order[1:]] = both[order[1:]] == both[order[:-1]]
        return out

    @cached_property
    def n_dup_lines(self) -> np.ndarray:
        used = np.flatnonzero(self.line_words > 0)
        row = self.lines[2][used]
        return counts_per_row(row[self.later_copies(row, self.line_hash[used])], self.rows)

    def repeated_words(self, size: int = 5) -> np.ndarray:
        """Words that lie in a window of ``size`` words found twice or more in its row, the first one included."""
        at = windows(self.row, size)
        if not len(at):
            return np.zeros(self.rows, np.int64)
        row = self.row[at]
        key = mix(Sequences(self.word_hash).runs(at, at + size) + row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(at), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        edge = np.zeros(len(self.row) + 1, np.int64)
        edge[at[twice]] += 1
        edge[at[twice] + size] -= 1
        return counts_per_row(self.row[np.cumsum(edge[:-1]) > 0], self.rows)


def map_texts(df: DataFrame, text_col: str, keep: Sequence[str], out: Sequence[StructField],
              work: Callable[[TextView], list[pa.Array]]) -> DataFrame:
    """Columns ``keep`` of ``df`` followed by the columns that ``work`` makes of each slice of texts; no shuffle.

    A null text is handled as an empty one. ``keep`` columns pass through whatever their types; one that has the
    name of a new column gives way to it.
    """
    made = {f.name for f in out}
    keep = [c for c in keep if c not in made]
    kept = df.select(*[F.col(f"`{c}`") for c in keep])
    schema = StructType([*kept.schema.fields, *out])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.num_columns - 1)
            for first, end, data, offs in slices(texts):
                own = work(TextView(data, offs))
                yield pa.RecordBatch.from_arrays([c.slice(first, end - first) for c in b.columns[:-1]] + own, names=names)
        release_memory()

    return df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("_viewed_text")).mapInArrow(run, schema)
