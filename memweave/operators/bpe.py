"""Byte-level BPE (K2, K3, K4, K5 ``bpe`` mode) and merge-table loading.

Pre-tokens come from the JVM regex (K1). Each pre-token's UTF-8 bytes are
mapped to printable characters (K2) and merged pair by pair, lowest merge
rank first, until no ranked pair is left (K3). The merge table is a bounded
dictionary, broadcast once behind a size check; merging runs in an Arrow UDF
with a per-worker memo, so encoding a corpus is one map-only pass (no shuffle
of tokens). Of a batch only the different pre-tokens become Python objects; the
rest stays in flat buffers, a slice of the rows at a time.

Token ids (our contract, the original id file is not available): byte symbol
``b`` has id ``b``; the symbol made by the merge of rank ``r`` has id ``256 + r``.
"""

from __future__ import annotations

import hashlib
import heapq
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memweave.functions.ordering import dense_index
from memweave.operators.tokens import PRETOKEN_PATTERN, pretokens

MAX_MERGES = 2_000_000  # broadcast guard: a merge table is a dictionary, not data
MEMO = 300_000  # remembered pre-tokens of a generation: bounds memory, changes no result


def bytes_to_unicode() -> dict[int, str]:
    """K2: byte -> printable character.

    Fixed values: bytes in the printable ranges ``!``..``~``, ``¡``..``¬`` and ``®``..``ÿ``
    stand for themselves; every other byte, in increasing order, gets the
    next character from U+0100 on.
    """
    printable = set(range(ord("!"), ord("~") + 1)) | set(range(ord("¡"), ord("¬") + 1)) | set(range(ord("®"), ord("ÿ") + 1))
    table, extra = {}, 0
    for b in range(256):
        if b in printable:
            table[b] = chr(b)
        else:
            table[b] = chr(256 + extra)
            extra += 1
    return table


def load_merges(spark: SparkSession, path: str) -> DataFrame:
    """Merges file -> (rank, left, right).

    The first line is a header and is skipped, blank lines are dropped, each
    remaining line is ``left right``; rank = position among the kept lines.
    """
    # Ids grow with the file offset, so they keep the line order.
    lines = spark.read.text(path).withColumn("_mid", F.monotonically_increasing_id())
    numbered = dense_index(lines, [], ["_mid"], "_line_no")
    body = (numbered.filter((F.col("_line_no") > 0) & (F.trim("value") != ""))
            .select("_mid", F.split(F.trim("value"), " ").alias("_p")))
    ranked = dense_index(body, [], ["_mid"], "rank")
    return ranked.select(F.col("rank").cast("int").alias("rank"), F.get("_p", 0).alias("left"),
                         F.get("_p", 1).alias("right"))


def load_tokenizer_merges(spark: SparkSession, path: str) -> DataFrame:
    """S9 for a tokenizer file in JSON: its ``model.merges`` -> (rank, left, right)."""
    text = spark.read.text(path, wholetext=True)
    # a merge is written as a pair, or as one string with a space
    pairs = F.get(F.from_json("value", "model struct<merges: array<array<string>>>")["model"]["merges"], 0).isNotNull()
    as_pairs = F.from_json("value", "model struct<merges: array<array<string>>>")["model"]["merges"]
    as_lines = F.transform(F.from_json("value", "model struct<merges: array<string>>")["model"]["merges"], lambda m: F.split(m, " "))
    merges = text.select(F.posexplode(F.when(pairs, as_pairs).otherwise(as_lines)).alias("rank", "p"))
    return merges.select("rank", F.get("p", 0).alias("left"), F.get("p", 1).alias("right"))


def merged(symbols: list, rank_of: Callable, product: Callable) -> list:
    """K3: merge the lowest-ranked adjacent pair everywhere, repeatedly.

    The symbols form a linked list and a heap holds the ranked pairs by (rank,
    place); a pass takes all places of the lowest rank, left to right, and
    then adds the pairs that its products form. A pre-token of n symbols costs
    n log n, however long it is.
    """
    n = len(symbols)
    sym, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := rank_of((sym[i], sym[i + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        rank, made = heap[0][0], []
        while heap and heap[0][0] == rank:
            i = heapq.heappop(heap)[1]
            j = after[i]
            if sym[i] is None or j >= n or rank_of((sym[i], sym[j])) != rank:
                continue  # one of the two has been merged since
            sym[i], sym[j] = product((sym[i], sym[j])), None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            made.append(i)
        for i in made:
            for left in (before[i], i):
                if left >= 0 and after[left] < n and (r := rank_of((sym[left], sym[after[left]]))) is not None:
                    heapq.heappush(heap, (r, left))
    return [x for x in sym if x is not None]


def merge_pretoken(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """K3 over printable symbols."""
    return merged(symbols, ranks.get, "".join)


class Vocabulary:
    """Merge ranks and symbol ids built from (rank, left, right) rows; pairs are kept by their symbols' ids."""

    def __init__(self, merges: list[tuple[int, str, str]]):
        self.byte_char = bytes_to_unicode()
        self.ids: dict[str, int] = {c: b for b, c in self.byte_char.items()}
        ranks: dict[tuple[str, str], int] = {}
        for rank, left, right in sorted(merges):
            ranks.setdefault((left, right), rank)
            self.ids.setdefault(left + right, 256 + rank)
        # a pair with a symbol that nothing makes can never be met
        known = {p: r for p, r in ranks.items() if p[0] in self.ids and p[1] in self.ids}
        self._rank = {(self.ids[a], self.ids[b]): r for (a, b), r in known.items()}
        self._product = {(self.ids[a], self.ids[b]): self.ids[a + b] for a, b in known}
        self._young: dict[str, array] = {}
        self._old: dict[str, array] = {}

    def encode_pretoken(self, token: str) -> list[int]:
        """Ids of one pre-token; those met lately are remembered in two generations of ``MEMO``."""
        hit = self._young.get(token)
        if hit is None:
            hit = self._old.get(token)
            if hit is None:
                hit = array("i", merged(list(token.encode("utf-8")), self._rank.get, self._product.__getitem__))
            if len(token) < 64:
                if len(self._young) >= MEMO:
                    self._old, self._young = self._young, {}
                self._young[token] = hit
        return hit.tolist()


def broadcast_vocabulary(merges: DataFrame):
    """Collect the merge table (size-checked) and broadcast it."""
    n = merges.count()
    if n > MAX_MERGES:
        raise ValueError(f"merge table has {n} rows, above the broadcast guard {MAX_MERGES}")
    rows = [(int(r["rank"]), r["left"], r["right"]) for r in merges.select("rank", "left", "right").collect()]
    digest = hashlib.sha256(repr(sorted(rows)).encode("utf-8")).hexdigest()
    return merges.sparkSession.sparkContext.broadcast((digest, rows))


#: Vocabularies of a worker process by the digest of their merge table, the latest few.
_VOCABULARIES: dict[str, Vocabulary] = {}


def _vocab_from(bc) -> Vocabulary:
    """One Vocabulary (and memo) per worker process and merge table."""
    digest, rows = bc.value
    if digest not in _VOCABULARIES:
        while len(_VOCABULARIES) >= 4:
            del _VOCABULARIES[next(iter(_VOCABULARIES))]
        _VOCABULARIES[digest] = Vocabulary(rows)
    return _VOCABULARIES[digest]


#: Rows worked on at a time.
SLICE = 1024


def _by_slices(work: Callable[[pa.Array], pa.Array], column: pa.Array, dtype: pa.DataType) -> pa.Array:
    parts = [work(column.slice(lo, SLICE)) for lo in range(0, len(column), SLICE)]
    return pa.concat_arrays([p.cast(dtype) for p in parts]) if parts else pa.array([], dtype)


def _offsets(lists: pa.Array) -> np.ndarray:
    """Where each list begins and ends in ``flatten()`` (null: empty)."""
    return np.concatenate(([0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))).astype(np.int64)


def _coded(flat: pa.Array) -> tuple[list[str], np.ndarray]:
    """The different strings, and the place among them of each."""
    coded = flat.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)


def encode(text: Column | str, merges_bc) -> Column:
    """K4: text -> token ids (empty for NULL or empty text)."""
    text = F.col(text) if isinstance(text, str) else text

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def _encode(toks: pa.Array) -> pa.Array:
        vocab = _vocab_from(merges_bc)

        def work(some: pa.Array) -> pa.Array:
            distinct, at = _coded(some.flatten())
            found = [vocab.encode_pretoken(t) for t in distinct]
            size = np.array([len(x) for x in found], np.int64)
            ids = np.array([i for x in found for i in x], np.int32)
            starts, own = np.cumsum(size) - size, size[at]
            ends = np.concatenate(([0], np.cumsum(own)))
            place = np.repeat(starts[at] - ends[:-1], own) + np.arange(ends[-1])
            return pa.ListArray.from_arrays(pa.array(ends[_offsets(some)].astype(np.int32)), pa.array(ids[place]))

        return _by_slices(work, toks, pa.list_(pa.int32()))

    return _encode(pretokens(text))


def count_bpe_tokens(text: Column | str, merges_bc) -> Column:
    """K5 (bpe mode): number of BPE tokens of a text."""
    text = F.col(text) if isinstance(text, str) else text

    @F.arrow_udf(T.IntegerType())
    def _count(toks: pa.Array) -> pa.Array:
        vocab = _vocab_from(merges_bc)

        def work(some: pa.Array) -> pa.Array:
            distinct, at = _coded(some.flatten())
            size = np.array([len(vocab.encode_pretoken(t)) for t in distinct], np.int64)
            ends = np.concatenate(([0], np.cumsum(size[at])))[_offsets(some)]
            return pa.array(np.diff(ends).astype(np.int32))

        return _by_slices(work, toks, pa.int32())

    return _count(pretokens(text))


def word_counter(merges_bc):
    """Counter for ``chunking.chunk_documents(mode='counter')``: a word counts the BPE tokens of a space and the word."""
    pieces = regex.compile(PRETOKEN_PATTERN).findall

    @F.arrow_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
    def _count(lines: pa.Array) -> pa.Array:
        vocab = _vocab_from(merges_bc)

        def work(some: pa.Array) -> pa.Array:
            words = some.flatten()
            distinct, at = _coded(words.flatten())
            size = np.array([sum(len(vocab.encode_pretoken(t)) for t in pieces(" " + w)) for w in distinct], np.int32)
            inner = pa.ListArray.from_arrays(pa.array(_offsets(words).astype(np.int32)), pa.array(size[at]))
            return pa.ListArray.from_arrays(pa.array(_offsets(some).astype(np.int32)), inner)

        return _by_slices(work, lines, pa.list_(pa.list_(pa.int32())))

    return _count
