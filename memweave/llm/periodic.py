r"""Runs of repeated word sequences, by longest common extensions over a difference-cover sample.

A run is a stretch of consecutive words ``[^\x20\x09-\x0D]+`` with smallest
period q (words q apart are identical), of ``max(min_words, 2 * q)`` words or
more, that no neighbouring word extends with period q.

* ``Extensions`` answers "how many words agree from i and j on". Only the
  positions whose number modulo 13 lies in a difference cover (4 of 13) are
  sorted as suffixes: blocks of 13 words get ranks, which doubling refines until
  all are distinct. For any i and j a shift of at most 12 words reaches two sampled
  positions at once, so a query compares those few words and then takes the
  smallest common prefix between two ranks from a sparse table.
* ``find`` visits the harmonic grid: for each period q the positions q apart.
  A run of period q holds a grid point i with i + q inside it too; the words that
  agree to the right of (i, i + q) and to the left give its borders. The
  first grid point of a run reports it, and of the periods that give one
  stretch the smallest counts. A text of n words has about n ln n grid points.

All texts of a slice of about 1 MB are worked on as one sequence with a symbol
of its own after each text, so no match crosses texts; there is no shuffle.
Memory grows with the longest single text (about 300 bytes a word).

Edge cases: null and empty texts have no words, no runs and an empty collapsed
text; repeated rows are judged each; other columns pass through under any name
but those of the new columns.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from memweave.llm.bytespans import counts_per_row, ranges
from memweave.llm.textview import TextView, map_texts

#: A perfect difference set, every difference modulo 13 occurs between two of its members.
MODULUS, COVER = 13, (0, 1, 3, 9)
#: Grid points looked at together; bounds the temporary arrays, changes no result.
GRID_CHUNK = 1 << 20

RUN = StructType([StructField("start", LongType()), StructField("length", LongType()), StructField("period", LongType())])


def _shifts() -> np.ndarray:
    """Smallest shift that takes residues a and b into the cover together."""
    inside = np.isin(np.arange(2 * MODULUS) % MODULUS, COVER)
    out = np.zeros((MODULUS, MODULUS), np.int64)
    for a in range(MODULUS):
        for b in range(MODULUS):
            out[a, b] = next(d for d in range(MODULUS) if inside[a + d] and inside[b + d])
    return out


SHIFT = _shifts()


class Extensions:
    """Longest common extensions to the right in a sequence of symbols 0, 1, 2, ...

    Texts in the sequence must be separated by symbols that occur once.
    """

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        top = int(symbols.max()) + 1 if n else 0
        self.symbols = np.concatenate([symbols, top + np.arange(MODULUS + 1)]).astype(np.int64)
        self.place = np.flatnonzero(np.isin(np.arange(n + 1) % MODULUS, COVER))
        self.number = np.full(n + 1, -1, np.int64)
        self.number[self.place] = np.arange(len(self.place))
        self.rank, levels = self._sort()
        self.table = self._minima(self._neighbours(levels))

    def _block_ranks(self) -> np.ndarray:
        """Rank of the 13 symbols that start at each sampled position; as many as fit a 64-bit key are compared at a time."""
        rank, at = np.zeros(len(self.place), np.int64), 0
        bits = max(1, int(self.symbols[-1]).bit_length())
        while at < MODULUS:
            take = min(MODULUS - at, max(1, (62 - int(rank.max()).bit_length()) // bits))
            for k in range(at, at + take):
                rank = rank << bits | self.symbols[self.place + k]
            rank = np.unique(rank, return_inverse=True)[1]
            at += take
        return rank

    def _sort(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Rank of every sampled suffix, and the ranks by its first 13, 26, 52, ... symbols.

        Equal ranks mean equal symbols; a block with a separator has no equal, so only separator-free blocks are refined.
        """
        m = len(self.place)
        _, group, size = np.unique(self._block_ranks(), return_inverse=True, return_counts=True)
        rank = (np.cumsum(size) - size)[group]
        levels, width = [rank], MODULUS
        tied = np.flatnonzero(size[group] > 1)
        while len(tied):
            key = rank[tied] * m + rank[self.number[self.place[tied] + width]]
            found, group, size = np.unique(key, return_inverse=True, return_counts=True)
            old, first = found // m, np.cumsum(size) - size
            opens = np.ones(len(old), bool)
            opens[1:] = old[1:] != old[:-1]
            opened = np.maximum.accumulate(np.where(opens, first, 0))
            rank = rank.copy()
            rank[tied] = (old + first - opened)[group]
            levels.append(rank)
            tied = tied[size[group] > 1]
            width *= 2
        return rank, levels

    def _neighbours(self, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefix of each sampled suffix and the next one in sorted order."""
        order = np.empty(len(self.place), np.int64)
        order[self.rank] = np.arange(len(order))
        a, b = self.place[order[:-1]], self.place[order[1:]]
        out = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 2, -1, -1):
            same = np.where(levels[k][self.number[a + out]] == levels[k][self.number[b + out]], MODULUS << k, 0)
            out += same
        live = np.arange(len(a))
        for _ in range(MODULUS):
            live = live[self.symbols[a[live] + out[live]] == self.symbols[b[live] + out[live]]]
            if not len(live):
                break
            out[live] += 1
        return out

    @staticmethod
    def _minima(values: np.ndarray) -> list[np.ndarray]:
        """Row k holds the minimum of every 2**k neighbouring values."""
        table, width = [values.astype(np.int32)], 1
        while 2 * width <= len(values):
            table.append(np.minimum(table[-1][:-width], table[-1][width:]))
            width *= 2
        return table

    def _common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Common prefix of sampled suffixes with ranks x != y."""
        low, high = np.minimum(x, y), np.maximum(x, y)
        row = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(x), np.int64)
        for k in np.unique(row):
            own = np.flatnonzero(row == k)
            out[own] = np.minimum(self.table[k][low[own]], self.table[k][high[own] - (1 << int(k))])
        return out

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of symbols that agree from positions i and j (i != j) on."""
        shift = SHIFT[i % MODULUS, j % MODULUS]
        out = np.zeros(len(i), np.int64)
        live = np.arange(len(i))
        for k in range(MODULUS):
            reached = shift[live] == k
            own = live[reached]
            if len(own):
                out[own] = k + self._common(self.rank[self.number[i[own] + k]], self.rank[self.number[j[own] + k]])
            live = live[~reached]
            live = live[self.symbols[i[live] + k] == self.symbols[j[live] + k]]
            out[live] = k + 1
            if not len(live):
                break
        return out


def find(symbols: np.ndarray, first: np.ndarray, size: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, by start, then period; text t is symbols[first[t]:first[t] + size[t]]."""
    texts = np.flatnonzero(size >= max(min_words, 2))
    half = size[texts] // 2
    text = np.repeat(texts, half)
    period = ranges(half) + 1
    points = (size[text] - 1) // period
    done = np.cumsum(points)
    right = left = None
    found = []
    at = 0
    while at < len(points):
        past = int(done[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(done, past + GRID_CHUNK, side="right")))
        own = points[at:end]
        q = np.repeat(period[at:end], own)
        i = np.repeat(first[text[at:end]], own) + ranges(own) * q
        hit = symbols[i] == symbols[i + q]
        head = np.repeat(first[text[at:end]], own)[hit]
        i, q = i[hit], q[hit]
        at = end
        if not len(i):
            continue
        if right is None:
            right, left = Extensions(symbols), Extensions(symbols[::-1])
        ahead = right(i, i + q)
        back = np.zeros(len(i), np.int64)
        inner = np.flatnonzero(i > head)
        back[inner] = left(len(symbols) - i[inner], len(symbols) - i[inner] - q[inner])
        keep = (back < q) & (ahead + back >= np.maximum(q, min_words - q))
        found.append(np.stack([i[keep] - back[keep], i[keep] + q[keep] + ahead[keep], q[keep]]))
    if not found:
        z = np.zeros(0, np.int64)
        return z, z, z
    start, end, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    smallest = np.ones(len(start), bool)
    smallest[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[smallest], end[smallest], period[smallest]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _symbols(view: TextView) -> np.ndarray:
    """Number of each word, the same for equal words of the slice."""
    sizes = np.zeros(len(view.start) + 1, np.int64)
    np.cumsum(view.end - view.start, out=sizes[1:])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(view.start),
                                             [None, pa.py_buffer(sizes), pa.py_buffer(view.data[view.word_bytes])])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def _joined(view: TextView, kept: np.ndarray) -> pa.Array:
    """Kept words of every text, joined by one space."""
    at = np.flatnonzero(kept)
    row, size = view.row[at], (view.end - view.start)[at]
    spaced = size.copy()
    spaced[:-1] += row[1:] == row[:-1]
    offs = np.zeros(view.rows + 1, np.int64)
    np.cumsum(np.bincount(row, weights=spaced, minlength=view.rows).astype(np.int64), out=offs[1:])
    out = np.full(int(spaced.sum()), 32, np.uint8)
    inside = ranges(size)
    out[np.repeat(np.cumsum(spaced) - spaced, size) + inside] = view.data[np.repeat(view.start[at], size) + inside]
    return pa.LargeStringArray.from_buffers(view.rows, pa.py_buffer(offs), pa.py_buffer(out)).cast(pa.string())


def runs_of_texts(view: TextView, min_words: int) -> list[pa.Array]:
    """(number of words, runs, collapsed text) of every text of a slice."""
    n = view.n_words
    # one separator after each text: word k of the slice sits at k + (its text's number)
    first_word = np.cumsum(n) - n
    first = first_word + np.arange(view.rows)
    words = _symbols(view)
    symbols = np.empty(len(words) + view.rows, np.int64)
    symbols[np.arange(len(words)) + view.row] = words
    symbols[first + n] = (words.max() + 1 if len(words) else 0) + np.arange(view.rows)
    start, end, period = find(symbols, first, n, min_words)
    text = np.searchsorted(first, start, side="right") - 1
    # a word goes if it lies in a run behind the run's first period
    edge = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, end, -1)
    kept = (np.cumsum(edge[:-1]) == 0)[np.arange(len(words)) + view.row]
    offs = np.concatenate([[0], np.cumsum(counts_per_row(text, view.rows))]).astype(np.int32)
    runs = pa.StructArray.from_arrays([pa.array(start - first[text], pa.int64()), pa.array(end - start, pa.int64()), pa.array(period, pa.int64())],
                                      names=RUN.names)
    return [pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(offs), runs), _joined(view, kept)]


def find_runs(df: DataFrame, text_col: str = "text", min_words: int = 12, keep: Sequence[str] | None = None, words: str = "n_words",
              runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """Columns ``keep`` (default: all) of ``df`` plus each text's number of words, its runs by (start, period), and its collapsed text.

    The collapsed text drops every word that any run contains after that run's first period, and joins the rest by one space.
    """
    made = [StructField(words, LongType()), StructField(runs, ArrayType(RUN)), StructField(collapsed, StringType())]
    return map_texts(df, text_col, df.columns if keep is None else keep, made, lambda view: runs_of_texts(view, min_words))
