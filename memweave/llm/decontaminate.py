r"""Benchmark decontamination by template canonicalisation.

Words ``[^\x20\x09-\x0D]+`` lose the ASCII punctuation at their ends and become
tokens: a number (digits, or a number word), a unit after a number, or a name
(a capitalised word) turns into a typed placeholder, any other word into its
lower-case form. Every window of ``size`` tokens gets a literal key, the hash of
its lower-case words, and a template key, the hash of its tokens, if at least
half of these are literal, so placeholders alone never match.

Benchmark windows and document windows meet in a hash join. Matches on one
diagonal (document position minus item position) form an alignment; its slots
(the words behind the placeholders) must map one to one, up to
``max_conflicts`` of them (else only its literal windows count), which catches re-parameterised questions and drops
chance template matches. A document is contaminated by an item when

* its consistent alignments cover ``min_share`` of the item's tokens, or of the
  tokens in windows that other values leave a key (a window with placeholders
  and too few literal tokens matches verbatim only), or
* one alignment holds a literal run of ``literal_run`` tokens, or
* for an item of ``size`` to ``2 * size - 1`` tokens, where one changed word can
  spoil every window: consistent alignments of windows of ``_part`` tokens on two
  neighbouring diagonals leave at most that many tokens of the item uncovered,
  which is what one replaced, inserted or left-out word leaves at most.

Edge cases: null and empty texts (and texts without a word that is more than
punctuation) have no windows on either side; an item shorter than ``size``
is one window of its own length; repeated items and documents are each
reported; rows that share an id, or have none, are judged together; an
empty benchmark contaminates nothing; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField

from memweave.llm.bytespans import BYTE_LOWER, Hasher, Sequences, mix, signed, windows
from memweave.llm.textview import IS_LETTER, IS_UPPER, TextView, byte_set, map_texts
from memweave.session import materialize

#: Number words and units, lower case.
NUMBER_WORDS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen",
                "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty", "thirty", "forty", "fifty", "sixty",
                "seventy", "eighty", "ninety", "hundred", "thousand", "million", "half", "twice", "dozen")
UNITS = ("mm", "cm", "m", "km", "meter", "meters", "metre", "metres", "kilometer", "kilometers", "inch", "inches", "foot", "feet", "ft",
         "yard", "yards", "mile", "miles", "mg", "g", "kg", "gram", "grams", "kilogram", "kilograms", "ounce", "ounces", "oz", "pound",
         "pounds", "lb", "lbs", "ton", "tons", "ml", "l", "liter", "liters", "litre", "litres", "gallon", "gallons", "second", "seconds",
         "sec", "minute", "minutes", "min", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "percent",
         "dollar", "dollars", "cent", "cents", "euro", "euros", "mph", "kmh", "degrees", "volts", "watts", "joules", "newtons")

SIZE = 8
#: Window keys of a benchmark are broadcast up to this many (8 bytes each); a larger benchmark is joined by shuffling all windows.
BROADCAST_KEYS = 1_000_000
LITERAL, NUMBER, UNIT, NAME = 0, 1, 2, 3
IS_DIGIT = byte_set(b"0123456789")


def _table(words: tuple[str, ...]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    return np.sort(Hasher(data, BYTE_LOWER).spans(end - [len(w) for w in words], end))


NUMBER_HASH, UNIT_HASH = _table(NUMBER_WORDS), _table(UNITS)


def _member(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(x), bool)
    return table[np.minimum(np.searchsorted(table, x), len(table) - 1)] == x


def tokens(view: TextView) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, kind, word hash) of the tokens: words with something left between their punctuation."""
    start, end = view.bare
    used = np.flatnonzero(end > start)
    start, end, row = start[used], end[used], view.row[used]
    word, data = view.bare_hash[used], view.data
    kind = np.zeros(len(used), np.int8)
    first = data[start] if len(start) else data[:0]
    second = data[np.minimum(start + 1, end - 1)] if len(start) else data[:0]
    # two-byte capitals of Latin-1 (C3 80..9E) count as capitals too
    wide = (first == 0xC3) & (second >= 0x80) & (second <= 0x9E)
    small = IS_LETTER[second] & ~IS_UPPER[second] | (second >= 0x80)
    kind[((IS_UPPER[first] & small) | wide) & (end - start > 1)] = NAME
    number = IS_DIGIT[first] | _member(word, NUMBER_HASH)
    kind[number] = NUMBER
    if len(used):
        after = np.zeros(len(used), bool)
        after[1:] = number[:-1] & (row[1:] == row[:-1])
        kind[after & ~number & _member(word, UNIT_HASH)] = UNIT
    return row, kind, word


def _part(n: int, size: int) -> int:
    """Tokens of the short windows of an item of ``n`` tokens; 0 if it has none."""
    return min(size // 2, (n - 1) // 2) if size <= n < 2 * size else 0


def template_windows(view: TextView, size: int, lengths=None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, tuple]:
    """(row, position in the row's tokens, literal key, template key, has a template key, matches verbatim only, parts for ``_slots``) of the windows of ``size`` tokens.

    The literal key names the lower-case words. A window has a template key if
    it holds a placeholder and at least half literal tokens. ``lengths``
    maps numbers of tokens to a mask of the rows to keep.
    """
    row, kind, word = tokens(view)
    at = windows(row, size)
    if lengths is not None and len(at):
        at = at[lengths(np.bincount(row, minlength=view.rows)[row[at]])]
    canonical = np.where(kind == LITERAL, word, mix(kind.astype(np.uint64) + np.uint64(77)))
    before = np.concatenate([[0], np.cumsum(kind == LITERAL)])
    literal = before[at + size] - before[at] if len(at) else at
    begin = np.searchsorted(row, row[at]) if len(at) else at
    return (row[at], at - begin, Sequences(word).runs(at, at + size), Sequences(canonical).runs(at, at + size),
            (literal < size) & (2 * literal >= size), 2 * literal < size, (kind, word, at))


def _slots(parts: tuple, pick: np.ndarray, size: int) -> np.ndarray:
    """Words behind the placeholders of the picked windows; 0 for a literal token."""
    kind, word, at = parts
    index = at[pick][:, None] + np.arange(size)
    return np.where(kind[index] == LITERAL, np.uint64(0), word[index] | np.uint64(1))


def _emit(view: TextView, sizes: list[int], lengths, select) -> list[pa.Array]:
    """Nested columns (pos, key, slots, len, dense) of the chosen windows of every row, over all window sizes; a literal window has no slots."""
    found = []
    for size in sizes:
        row, pos, literal, template, has, dense, parts = template_windows(view, size, lengths and lengths(size))
        pick = np.flatnonzero(select(literal)) if select is not None else np.arange(len(literal))
        found.append((row[pick], pos[pick], literal[pick], np.zeros(0, np.uint64), np.zeros(len(pick), np.int64), np.full(len(pick), size), dense[pick]))
        pick = np.flatnonzero(has)
        pick = pick[select(template[pick])] if select is not None else pick
        found.append((row[pick], pos[pick], template[pick], _slots(parts, pick, size).ravel(), np.full(len(pick), size, np.int64), np.full(len(pick), size), dense[pick]))
    row = np.concatenate([f[0] for f in found])
    order = np.argsort(row, kind="stable")
    outer = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=view.rows))]).astype(np.int32))
    lens = np.concatenate([f[4] for f in found])
    flat = np.concatenate([f[3] for f in found])
    slots = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)), signed(flat)).take(pa.array(order))
    cols = [pa.array(np.concatenate([f[1] for f in found])[order].astype(np.int32)), signed(np.concatenate([f[2] for f in found])[order]), slots,
            pa.array(np.concatenate([f[5] for f in found])[order].astype(np.int32)), pa.array(np.concatenate([f[6] for f in found])[order].astype(bool))]
    return [pa.ListArray.from_arrays(outer, c) for c in cols]


_COLS = [StructField("pos", ArrayType(IntegerType())), StructField("key", ArrayType(LongType())), StructField("slots", ArrayType(ArrayType(LongType()))),
         StructField("len", ArrayType(IntegerType())), StructField("dense", ArrayType(BooleanType()))]


def _exploded(df: DataFrame) -> DataFrame:
    return df.select("id", F.explode(F.arrays_zip("pos", "key", "slots", "len", "dense")).alias("x")).select("id", "x.*")


def _tokens_in(positions: Column, size: Column) -> Column:
    """Number of tokens in the windows of ``size`` tokens at the given places."""
    e = F.sort_array(positions)
    steps = F.zip_with(e, F.slice(e, 2, F.size(e) + 1), lambda a, b: F.least(size, F.coalesce(b - a, size)))
    return F.aggregate(steps, F.lit(0), lambda x, y: x + y)


def leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id", item_col: str = "item_id",
          item_text_col: str = "text", *, size: int = SIZE, min_share: float = 0.5, max_conflicts: float = 0.2,
          literal_run: int = 13) -> DataFrame:
    """(id, item, n_windows, item_windows): every contaminated (document, item), with the windows found and had (the larger of both sizes' counts)."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(f"`{item_col}`").alias("id"), F.col(f"`{item_text_col}`").alias("_text"))
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("_text"))

    def counted(view: TextView) -> list[pa.Array]:
        return [pa.array(np.bincount(tokens(view)[0], minlength=view.rows).astype(np.int64))]

    lengths = map_texts(items, "_text", [], [StructField("n", LongType())], counted).filter(f"n > 0 and n < {2 * size}").distinct()
    known_lengths = [r["n"] for r in lengths.collect()]  # at most 2 * size - 1 values
    sizes = sorted({size, *(_part(n, size) or min(n, size) for n in known_lengths)})
    parts = np.array([_part(n, size) for n in range(2 * size)])

    def item_lengths(window: int):
        # windows of the full size; a shorter item as a whole; short windows
        return lambda n: (n >= size if window == size else n == window) | (parts[np.minimum(n, 2 * size - 1)] * (n < 2 * size) == window)

    def item_windows(view: TextView) -> list[pa.Array]:
        return _emit(view, sizes, item_lengths, None)

    wanted = materialize(_exploded(map_texts(items, "_text", ["id"], _COLS, item_windows)), "items")
    keys = wanted.select("key").distinct()
    select = None
    if keys.count() <= BROADCAST_KEYS:
        own_keys = np.sort(np.array([r["key"] for r in keys.collect()], np.int64).view(np.uint64))
        known = spark.sparkContext.broadcast(own_keys)

        def select(key: np.ndarray) -> np.ndarray:
            table = known.value
            bits = max(16, int(np.ceil(np.log2(16 * len(table) + 1))))
            low = np.zeros(1 << bits, bool)
            mask = np.uint64((1 << bits) - 1)
            low[(table & mask).astype(np.int64)] = True
            out = low[(key & mask).astype(np.int64)]
            at = np.flatnonzero(out)
            out[at] = _member(key[at], table)
            return out

    def doc_windows(view: TextView) -> list[pa.Array]:
        return _emit(view, sizes, None, select)

    hits = _exploded(map_texts(own, "_text", ["id"], _COLS, doc_windows)).drop("len", "dense")
    if select is not None:
        hits = materialize(hits, "hits")  # only windows that the benchmark has too
    # a window shorter than ``size`` is a short item as a whole, or one of several short windows of a longer item
    tokens_of = wanted.groupBy("id").agg(F.max(F.col("pos") + F.col("len")).alias("n")).withColumnRenamed("id", "_id")
    wanted = materialize(wanted.join(tokens_of, F.col("id").eqNullSafe(F.col("_id"))).drop("_id").withColumn(
        "part", (F.col("len") < size) & (F.col("n") >= size)), "items")
    right = wanted.select(F.col("id").alias("item"), F.col("pos").alias("item_pos"), "key", F.col("slots").alias("item_slots"), "len", "dense", "part")
    pairs = F.filter(F.zip_with("item_slots", "slots", lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda x: x["a"] != 0)
    met = hits.join(right, "key").select("id", "item", (F.col("pos") - F.col("item_pos")).alias("diagonal"), "item_pos", pairs.alias("pairs"),
                                         (F.size("slots") == 0).alias("literal"), "len", "dense", "part")
    # an alignment has at most as many rows as its item has windows
    place = F.struct(F.col("item_pos").alias("p"), F.col("dense"))
    aligned = met.groupBy("id", "item", "part", "len", "diagonal").agg(
        F.collect_set(place).alias("all"), F.collect_set(F.when(F.col("literal"), place)).alias("exact"),
        F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("pairs"))
    n, a, b = F.size("pairs"), F.size(F.array_distinct(F.transform("pairs", lambda x: x["a"]))), F.size(F.array_distinct(F.transform("pairs", lambda x: x["b"])))
    consistent = n - F.least(a, b) <= F.lit(max_conflicts) * n
    more = max(literal_run - size, 0)
    e = F.sort_array(F.col("exact")["p"])
    ahead = F.zip_with(e, F.slice(e, more + 1, F.size(e) + 1), lambda x, y: y - x)
    run = ~F.col("part") & (F.col("len") == size) & F.coalesce(F.exists(ahead, lambda x: x == more), F.lit(False))
    # the run is told below the explode, else each of its rows would carry the array
    covered = aligned.select("id", "item", "part", "len", "diagonal", run.alias("run"),
                             F.when(consistent, F.col("all")).otherwise(F.col("exact")).alias("places"))
    covered = covered.select("id", "item", "part", "len", "diagonal", "run", F.explode("places").alias("x")).select("*", "x.*").drop("x")
    loose = F.collect_set(F.when(~F.col("dense"), F.col("p")))
    total = wanted.withColumn("p", F.col("pos")).groupBy(F.col("id").alias("_item"), F.col("part").alias("_part"), F.col("len").alias("_len")).agg(
        F.collect_set("p").alias("all"), loose.alias("loose")).select(
        "_item", "_part", "_len", F.size("all").alias("item_windows"), _tokens_in(F.col("all"), F.col("_len")).alias("item_tokens"),
        _tokens_in(F.col("loose"), F.col("_len")).alias("item_loose"))

    def measured(cover: DataFrame) -> DataFrame:
        cover = cover.withColumn("n_windows", F.size("all")).withColumn("tokens", _tokens_in(F.col("all"), F.col("len"))).withColumn(
            "loose", _tokens_in(F.col("loose"), F.col("len"))).drop("all")
        return cover.join(total, F.col("item").eqNullSafe(F.col("_item")) & (F.col("part") == F.col("_part")) & (F.col("len") == F.col("_len")))

    whole = measured(covered.filter("not part").groupBy("id", "item", "part", "len").agg(
        F.collect_set("p").alias("all"), loose.alias("loose"), F.max("run").alias("run")))
    share = F.lit(min_share)
    found = whole.filter(F.col("run") | (F.col("tokens") >= share * F.col("item_tokens")) |
                         ((F.col("item_loose") > 0) & (F.col("loose") >= share * F.col("item_loose"))))
    out = found.select("id", "item", "n_windows", "item_windows")
    if any(_part(k, size) for k in known_lengths):
        # an inserted or left-out word moves the diagonal by one
        near = covered.filter("part").withColumn("diagonal", F.explode(F.array(F.col("diagonal"), F.col("diagonal") - 1)))
        short = measured(near.groupBy("id", "item", "part", "len", "diagonal").agg(F.collect_set("p").alias("all"), loose.alias("loose")))
        out = out.union(short.filter(F.col("tokens") >= F.col("item_tokens") - F.col("len")).select("id", "item", "n_windows", "item_windows"))
        out = out.groupBy("id", "item").agg(F.max("n_windows").alias("n_windows"), F.max("item_windows").alias("item_windows"))
    return out


def row_key(text_col: str = "text", id_col: str = "doc_id") -> Column:
    """A key of id and text: rows with a null or a shared id are told apart by their texts."""
    return F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """(id_col, item_ids, contaminated): one row per row of ``docs``, judged by its own text; ``item_ids`` lists the leaked items in order."""
    keyed = docs.select(row_key(text_col, id_col).alias("_row"), F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("_text"))
    found = leaks(keyed, benchmark, "_text", "_row", **options)
    per_doc = found.groupBy(F.col("id").alias("_row")).agg(F.sort_array(F.collect_set("item")).alias("item_ids"))
    out = keyed.select("_row", F.col(f"`{id_col}`")).join(per_doc, "_row", "left").drop("_row")
    return out.withColumn("contaminated", F.col("item_ids").isNotNull())
