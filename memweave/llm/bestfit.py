"""Packing of token pieces into sequences of a fixed capacity: best-fit decreasing with certified bounds.

``pieces`` encodes texts and cuts only those longer than the capacity, into full
pieces behind a first one that may be shorter. ``pack`` deals the pieces that
are not full into groups of bounded size and packs each group by best-fit
decreasing. Dual feasible functions of a group's lengths (the threshold
functions and the rounding functions u^(k), also composed) give a lower
bound on its sequences; a group that meets its bound is certified and stays.
The groups that do not put the documents of their unfilled sequences into a
common pool, are dealt new ones from it and packed again, as long as that saves
sequences and the bound of the whole table is not met.

Scale: one row for each piece is written once; groups hold about ``group_items``
rows by a hash of a key that every piece gets, so equal ids or lengths do not
crowd a group. Only the histogram of lengths (capacity + 1 numbers) and counts
reach the driver.

Edge cases: a null text is an empty one, whose only token is the end token.
Rows with a null or repeated id are documents of their own. Pieces of length
null or 0 take no room; a length above the capacity is an error. Other columns
pass through under any name but those of the new columns.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from memweave.llm.bpecount import SPLIT, byte_symbols, read_vocabulary
from memweave.session import materialize

#: Items of a group on average; bounds a task's memory.
GROUP_ITEMS = 32768
#: Rounding functions tried, k = 1 .. ROUNDINGS.
ROUNDINGS = 100
#: Texts encoded between two output batches.
TEXTS = 256


def _byte_level(spec: dict) -> dict[bytes, int] | None:
    """Ranks of a plain byte-level vocabulary whose ids follow its merges; None for any other kind of file."""
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = (model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
             and not spec.get("normalizer") and not model.get("dropout") and not model.get("ignore_merges"))
    if not plain or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens", [])):
        return None
    vocab, special = model["vocab"], {t["content"] for t in spec.get("added_tokens", [])}
    made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if made != sorted(set(made)) or len(vocab) - len(special & set(vocab)) != len(made) + 256:
        return None
    byte_of = {s: b for b, s in enumerate(byte_symbols())}
    return {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if token not in special}


@functools.cache
def encoder(content: str) -> Callable[[str], np.ndarray]:
    """Ids of a text as the ``tokenizers`` library gives them for this file, without added begin or end tokens.

    A plain byte-level vocabulary is encoded by ``tiktoken`` over the file's own
    ranks, with equal ids and several times faster; any other file by the library itself.
    """
    spec = json.loads(content)
    ranks = _byte_level(spec)
    if ranks is None:
        from tokenizers import Tokenizer

        own = Tokenizer.from_str(content)
        own.no_truncation()
        own.no_padding()
        return lambda text: np.array(own.encode(text, add_special_tokens=False).ids, np.uint32)
    import tiktoken

    fast = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks,
                             special_tokens={t["content"]: t["id"] for t in spec.get("added_tokens", [])})
    return lambda text: fast.encode_to_numpy(text, allowed_special="all")


def pieces(docs: DataFrame, tokenizer_path: str, text_col: str = "text", capacity: int = 1024, end_id: int = 2,
           keep: Sequence[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all but the text) plus (piece, start, length, ids) for each piece of each document.

    ``ids`` holds the token ids as little-endian unsigned 32-bit numbers; the last piece of a document ends with ``end_id``.
    """
    made = [StructField("piece", IntegerType()), StructField("start", LongType()), StructField("length", LongType()), StructField("ids", BinaryType())]
    names = {f.name for f in made}
    keep = [c for c in (docs.columns if keep is None else keep) if c not in names and (keep is not None or c != text_col)]
    kept = docs.select(*[F.col(f"`{c}`") for c in keep])
    schema = StructType([*kept.schema.fields, *made])
    content = docs.sparkSession.sparkContext.broadcast(read_vocabulary(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(content.value)
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                b = whole.slice(at, TEXTS)
                of, number, start, length, ids = [], [], [], [], []
                for row, text in enumerate(b.column(b.num_columns - 1)):
                    tokens = np.append(encode(text.as_py() or ""), end_id).astype("<u4")
                    begin = 0
                    for k, stop in enumerate(range((len(tokens) - 1) % capacity + 1, len(tokens) + 1, capacity)):
                        of.append(row)
                        number.append(k)
                        start.append(begin)
                        length.append(stop - begin)
                        ids.append(tokens[begin:stop].tobytes())
                        begin = stop
                rows = pa.array(of, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[c.take(rows) for c in b.columns[:-1]], pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(ids, pa.binary())], names=schema.names)

    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("_piece_text")).mapInArrow(run, schema)


def lower_bound(counts: np.ndarray) -> int:
    """Sequences that any packing of ``counts[s]`` pieces of each length s needs; the capacity is ``len(counts) - 1``.

    With threshold t, pieces longer than capacity - t count as a whole sequence and
    those shorter than t as nothing; between them a piece counts by its length or by
    u^(k): s / capacity if (k + 1) s is a multiple of the capacity, else floor((k + 1) s / capacity) / k.
    """
    c = len(counts) - 1
    size = np.arange(c + 1, dtype=np.int64)
    above = np.concatenate([np.cumsum(counts[::-1])[::-1], [0]])  # above[s]: pieces of length s and more
    t = np.arange(0, c // 2 + 1)
    best = 0
    for k in range(ROUNDINGS + 1):
        # weights are in units of 1 / (unit) of a sequence
        unit = c * max(k, 1)
        weight = size if k == 0 else np.where((k + 1) * size % c == 0, k * size, (k + 1) * size // c * c)
        sums = np.concatenate([[0], np.cumsum(counts * weight)])
        whole = above[c - t + 1]
        middle = sums[c - t + 1] - sums[t]
        best = max(best, int((whole + -(-middle // unit)).max()))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(sequence, offset) of every piece, in the order given, and the number of sequences.

    Longest first, each into the fullest sequence that has room. Sequences lie in
    stacks by their room; a bit mask of the stacks in use finds the tightest one.
    """
    place, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    used = bins = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = used >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            own = stacks[room].pop()
            if not stacks[room]:
                used &= ~(1 << room)
        else:
            own, room, bins = bins, capacity, bins + 1
        place[i], offset[i] = own, capacity - room
        room -= size
        stacks[room].append(own)
        used |= 1 << room
    return place, offset, bins


@dataclass
class Packing:
    """Packed rows, their number of sequences, and the certified lower bound of any packing."""

    rows: DataFrame
    sequences: int
    bound: int


GROUPED = "_bf_key long, _bf_length long, _bf_group long, _bf_bin long, offset long, _bf_load long, _bf_gap long"


def _pack_groups(items: DataFrame, groups: int, capacity: int, salt: int) -> DataFrame:
    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("_bf_key")
        lengths = table["_bf_length"].to_numpy()
        place, offset, bins = best_fit_decreasing(lengths, capacity)
        gap = bins - lower_bound(np.bincount(lengths, minlength=capacity + 1))
        load = np.bincount(place, weights=lengths, minlength=bins).astype(np.int64)
        made = [place, offset, load[place], np.full(len(lengths), gap, np.int64)]
        return pa.Table.from_arrays([table["_bf_key"], table["_bf_length"], table["_bf_group"], *[pa.array(x, pa.int64()) for x in made]],
                                    names=["_bf_key", "_bf_length", "_bf_group", "_bf_bin", "offset", "_bf_load", "_bf_gap"])

    dealt = items.select("_bf_key", "_bf_length", F.pmod(F.xxhash64("_bf_key", F.lit(salt)), F.lit(groups).cast("long")).alias("_bf_group"))
    return materialize(dealt.groupBy("_bf_group").applyInArrow(work, GROUPED), "groups")


def _sequences(packed: DataFrame) -> int:
    """A sequence's first piece stands at offset 0; pieces without length may share that place, so pairs are counted."""
    return packed.filter("offset = 0").select("_bf_group", "_bf_bin").distinct().count()


def pack(rows: DataFrame, capacity: int = 1024, length_col: str = "length", group_items: int = GROUP_ITEMS, rounds: int = 8) -> Packing:
    """All columns of ``rows`` (one row a piece) plus sequence_id and offset; offsets fill each sequence without gaps."""
    kept = [c for c in rows.columns if c not in ("sequence_id", "offset")]
    room = F.coalesce(F.col(f"`{length_col}`").cast("long"), F.lit(0))
    fits = F.when((room >= 0) & (room <= capacity), room).otherwise(F.raise_error(F.lit(f"a piece is longer than the capacity {capacity}")))
    written = materialize(rows.select(*[F.col(f"`{c}`") for c in kept], fits.alias("_bf_length"), F.monotonically_increasing_id().alias("_bf_key")), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for r in written.groupBy("_bf_length").count().collect():  # at most capacity + 1 rows
        counts[r["_bf_length"]] = r["count"]
    whole, counts[capacity] = int(counts[capacity]), 0
    bound = lower_bound(counts)

    def dealt(n: int) -> int:
        return max(1, -(-n // group_items))

    settled = []
    pool = _pack_groups(written.filter(F.col("_bf_length") < capacity), dealt(int(counts.sum())), capacity, 0).withColumn("_bf_round", F.lit(0))
    total = _sequences(pool)
    for k in range(1, rounds + 1):
        if total == bound:
            break
        # sequences that are full, or of groups that meet their bound, stay; the rest is exchanged
        stays = (F.col("_bf_gap") == 0) | (F.col("_bf_load") == capacity)
        gaps = pool.filter(~stays)
        n, before = gaps.count(), _sequences(gaps)
        again = _pack_groups(gaps, dealt(n), capacity, k).withColumn("_bf_round", F.lit(k))
        after = _sequences(again) if n else 0
        if after >= before:
            break
        settled.append(pool.filter(stays))
        pool, total = again, total - before + after
    for done in settled:
        pool = pool.unionByName(done)
    own = F.shiftleft(F.col("_bf_round").cast("long"), 56) + F.shiftleft(F.col("_bf_group"), 16) + F.col("_bf_bin")
    placed = pool.select("_bf_key", own.alias("sequence_id"), "offset")
    full = written.filter(F.col("_bf_length") == capacity).withColumn("sequence_id", -1 - F.col("_bf_key")).withColumn("offset", F.lit(0).cast("long"))
    out = written.filter(F.col("_bf_length") < capacity).join(placed, "_bf_key").unionByName(full)
    return Packing(out.select(*[F.col(f"`{c}`") for c in kept], "sequence_id", "offset"), total + whole, bound + whole)
