"""Token counts by heap-and-linked-list byte-pair merging.

A pre-token's symbols form a linked list; a heap holds the adjacent pairs by
(rank, position). The lowest pair is merged until none is left, so the count is
the number of initial symbols minus the number of merges. No token id is ever
looked up or emitted.

Edge cases: a null or empty text has 0 bytes and 0 tokens; special strings in a
text count one token each; repeated rows are counted each; other columns of the
input pass through untouched and may have any name.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

#: Fixed value: the published split pattern of byte-level BPE vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A task remembers the counts of at most this many distinct pre-tokens in each of two generations; this bounds memory and changes no result.
MEMO = 300_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {b: chr(b) for b in printable}
    spare = iter(range(256, 512))
    return [names.get(b) or chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Merge ranks over integer symbols and the special strings of a tokenizer file."""

    def __init__(self, content: str):
        spec = json.loads(content)
        ids: dict[str, int] = {s: b for b, s in enumerate(byte_symbols())}
        self.rank: dict[int, int] = {}
        self.made: list[int] = []  # by rank
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.made.append(ids.setdefault(left + right, len(ids)))
            self.rank.setdefault(ids[left] << 32 | ids[right], rank)
        special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.split = regex.compile(SPLIT).findall


def merged_length(symbols: bytes, vocabulary: Vocabulary) -> int:
    """Number of symbols left after all merges.

    A heap entry is rank * 2**32 + position. It is out of date if the pair now
    at that position has another rank.
    """
    n = len(symbols)
    get, made = vocabulary.rank.get, vocabulary.made
    sym = [*symbols, 0]
    heap = []
    left = sym[0]
    for i in range(1, n):
        right = sym[i]
        rank = get(left << 32 | right)
        if rank is not None:
            heap.append(rank << 32 | i - 1)
        left = right
    if not heap:
        return n
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    after = list(range(1, n + 1))
    before = list(range(-1, n))
    merges = 0
    while heap:
        top = pop(heap)
        i = top & 0xFFFFFFFF
        left, j = sym[i], after[i]
        if left < 0 or j >= n or get(left << 32 | sym[j]) != top >> 32:
            continue
        left = sym[i] = made[top >> 32]
        sym[j] = -1
        k = after[i] = after[j]
        merges += 1
        if k < n:
            before[k] = i
            rank = get(left << 32 | sym[k])
            if rank is not None:
                push(heap, rank << 32 | i)
        h = before[i]
        if h >= 0:
            rank = get(sym[h] << 32 | left)
            if rank is not None:
                push(heap, rank << 32 | h)
    return n - merges


class Counter(dict):
    """Token count of every pre-token seen lately.

    Counts live in two generations: a full young one becomes the old one, from
    which a pre-token met again comes back, so the common ones stay.
    """

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.old: dict[str, int] = {}

    def __missing__(self, piece: str) -> int:
        n = self.old.get(piece)
        if n is None:
            n = merged_length(piece.encode(), self.vocabulary)
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        if len(piece) < 64:
            self[piece] = n
        return n

    def plain(self, text: str) -> int:
        return sum(map(self.__getitem__, self.vocabulary.split(text)))

    def count(self, text: str) -> int:
        special = self.vocabulary.special
        if special is None or special.search(text) is None:
            return self.plain(text)
        parts = special.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))


@functools.cache
def counter_of(content: str) -> Counter:
    """One counter for each vocabulary in a Python worker, so later tasks find its counts."""
    return Counter(Vocabulary(content))


def read_vocabulary(path: str) -> str:
    """The tokenizer file's text; the file lies beside the driver's own software."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def count_tokens(docs: DataFrame, vocabulary_path: str, text_col: str = "text", limit: int = 512,
                 n_bytes: str = "n_bytes", n_tokens: str = "n_tokens", over_limit: str = "over_limit",
                 keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all) of ``docs`` plus byte and token counts of ``text_col``.

    The vocabulary (about 1.5 MB, bounded by the tokenizer file) is broadcast;
    the rows are never shuffled.
    """
    spark: SparkSession = docs.sparkSession
    keep = [c for c in docs.columns if c not in (n_bytes, n_tokens, over_limit)] if keep is None else keep
    content = spark.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(content.value)
        for b in batches:
            texts = b.column(b.num_columns - 1)
            size, tokens = [], []
            for t in texts:
                t = t.as_py() or ""
                size.append(len(t.encode()))
                tokens.append(counter.count(t))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(size, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([x > limit for x in tokens], pa.bool_())],
                names=[*keep, n_bytes, n_tokens, over_limit])

    kept = docs.select(*[F.col(f"`{c}`") for c in keep])
    schema = StructType([*kept.schema.fields, StructField(n_bytes, LongType()), StructField(n_tokens, LongType()),
                         StructField(over_limit, BooleanType())])
    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("_counted_text")).mapInArrow(run, schema)
