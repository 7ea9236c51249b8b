r"""Near-duplicate lines by a deletion-neighbourhood join.

A line (text between ``\n``) counts as its words ``[^\x20\x09-\x0D]+`` with
A-Z in lower case. Lines of fewer than ``min_words`` words are left alone; by
default that is only lines without a word, so equal short lines go too. Two
lines match if their words are equal, or, when both have ``near_words`` words
or more, if their edit distance over words (insert, delete, replace) is at most
``edit_percent`` percent of the words of the shorter one, and at least 1. A line is removed when an earlier line, by
(document id, line number), matches it.

1. Equal lines meet on their hash; the earliest one stands for them.
2. Lines whose bound with a shorter one can be 1 take part in the neighbourhood
   join, but only if they share their first or last half with another one: of
   two lines at distance 1, one half of the shorter is whole in the longer, so
   no match is lost here.
3. Those lines emit themselves and every variant with one word left out as
   hashed keys. Two lines match if their variants at one position are equal
   (a replaced word) or a variant of one is the other line (a missing word).
   Aggregates keep the earliest line of each key, so the members of a key are
   never paired with each other.
4. Each (line, earliest match) is verified by its edit distance.
   All pairs of an Arrow batch are compared at once, exactly, word by word.
5. For lines long enough for k = 2 edits or more the variants leave out more: the
   words fall into 2 k + 1 classes by their hash, and a variant keeps the words
   of one class. An edit touches two classes at most (the word that goes and
   the one that comes), so two lines within k edits have an equal variant of
   one class at least; a line of w words has about w / 10 variants. Classes
   without words are left out (step 6). A longer
   line also emits those of the smaller k that its shorter partners have. Lines
   are verified against all earlier lines of each key that 16 lines or fewer have,
   and against the earliest of each of 16 parts of a larger key; those that none of
   these matches are verified against all lines of their larger keys. Only pairs
   whose sketches differ in 2 k bits at most are verified: bit b tells whether
   the number of words that hash to b is odd, so an edit changes two bits at most.

6. Two lines that both have an empty class, those of few different words, also
   meet on marks: k edits leave a run of
   (w - k) / (k + 1) words or more whole, and the smallest hash of every few
   neighbouring word runs (winnowing) picks one mark at least inside it, in
   both lines, at places up to k apart. All marks of a line are looked up, but a
   line looks for others only by the marks of k + 1 disjoint stretches of it: the
   edits leave one of them whole. Stretches whose mark no other line has come
   first, then the rarest ones, so a phrase that many lines share is looked for
   only by lines that have too little else. Lines are verified against the
   earliest line of their marks first; those it does not match are verified against
   all earlier ones that have such a mark at such a place and are of such a length. A
   mark that a line repeats counts by its first and last place, so two lines that
   share it are one pair.

Edge cases: null and empty texts have no lines that count and come back as
they are; rows with a null id neither remove lines nor lose any; rows that
share an id count as one document: lines at one place of several texts do not
remove each other, and each text loses its own lines only; extra columns pass
through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from memweave.functions.sizing import broadcast_if_small
from memweave.llm.bytespans import BYTE_LOWER, Hasher, Sequences, mix, ranges, release_memory, signed, slices
from memweave.llm.textview import TextView
from memweave.session import materialize

#: Parts of a key whose earliest lines are tried before all of its lines, where it has more; changes no result.
PIVOTS = 16
#: Diagonals of all pairs that are compared at once (one pair may have more), and words of each that are compared in one step.
CELLS, STEP = 1 << 17, 16
#: Kinds of lines whose words are fetched, as bits: those of steps 2, 5 and 6.
HALVES, CLASSES, MARKS = 1, 2, 4
#: 64-bit numbers of a line's sketch.
SKETCH = 4
PARTS = [f"s{k}" for k in range(SKETCH)]
#: Ids are broadcast up to this many rows (a few bytes each); beyond it the join shuffles.
BROADCAST_IDS = 1_000_000


def _lines_of(text: str) -> Column:
    """The lines of each text of a column; null for a null text."""
    return F.split(F.col(text), "\n", -1)


def _picked(lines: Column, numbers: Column) -> Column:
    """Those of an array of ``lines`` that have the ``numbers`` (from 0), in their order."""
    # the one item of the outer array names the lines, so that a text is split once and not once a number
    return F.get(F.transform(F.array(lines), lambda x: F.transform(numbers, lambda k: F.get(x, k))), 0)


def _bound(words, edit_percent: int):
    """Edits allowed for a shorter line of so many words (numbers or a column)."""
    if isinstance(words, Column):
        return F.greatest(F.lit(1), F.floor(words * edit_percent / 100))
    return np.maximum(1, words * edit_percent // 100)


def _first_long(near_words: int, edit_percent: int) -> float:
    """Words of the shortest line whose bound is 2 edits; infinite if there is none."""
    return max(near_words, -(-200 // edit_percent)) if edit_percent > 0 else np.inf


def _mark_sizes(near_words: int, edit_percent: int) -> tuple[int, int, int] | None:
    """(words of the shortest line with two edits, words of a run, neighbouring runs of which one is a mark); None if all bounds are 1."""
    if edit_percent <= 0:
        return None
    long = max(near_words, -(-200 // edit_percent))
    whole = min(-(-(w - k) // (k + 1)) for w in range(long, long + 10_000) for k in [_bound(w, edit_percent)])
    if whole < 3:
        raise ValueError(f"edit_percent={edit_percent} leaves no run of 3 words whole")
    run = whole // 2
    return long, run, whole - run + 1


def _marks(seq: Sequences, at: np.ndarray, w: np.ndarray, sizes: tuple[int, int, int] | None,
           poor: np.ndarray) -> list[pa.Array]:
    """Keys, places and stretches (list columns) of the marks of the ``poor`` lines among those that start at word ``at`` and have ``w`` words.

    Stretch j of a line begins at word j * (run + near - 1); a mark that is not the pick of such a stretch has number -1.
    """
    line, key, place, stretch = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    use = np.flatnonzero(poor & (w >= sizes[0])) if sizes else line
    if len(use):
        _, run, near = sizes
        n = w[use] - run + 1
        line, place = np.repeat(use, n), ranges(n)
        start = at[line] + place
        key = seq.runs(start, start + run)
        first = np.flatnonzero(line[near - 1:] == line[:len(line) - near + 1])
        least, pick = key[first], first.copy()
        for k in range(1, near):
            less = key[first + k] < least
            least[less], pick[less] = key[first + k][less], (first + k)[less]
        number = np.full(len(line), -1, np.int64)
        head = place[first] % (run + near - 1) == 0
        number[pick[head]] = place[first[head]] // (run + near - 1)
        pick = np.unique(pick)
        line, key, place, stretch = line[pick], key[pick], place[pick], number[pick]
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(line, minlength=len(w)))]).astype(np.int32))
    return [pa.ListArray.from_arrays(offsets, c) for c in (signed(key), pa.array(place.astype(np.int32)), pa.array(stretch.astype(np.int32)))]


def _class_variants(seq: Sequences, at: np.ndarray, w: np.ndarray, long: float, edit_percent: int) -> tuple[pa.Array, np.ndarray]:
    """Keys (list column) of the one-class variants of the lines that start at word ``at`` and have ``w`` words, and a mask of the lines with an empty class.

    A class without words says nothing and has no key.
    """
    lines, keys, poor = [], [], np.zeros(len(w), bool)
    use = np.flatnonzero(w >= long)
    if len(use):
        most = _bound(w[use], edit_percent)
        # the least bound that a shorter line within reach can have
        least = np.maximum(_bound(-(-100 * w[use] // (100 + edit_percent)), edit_percent), 2)
        for back in range(int((most - least).max()) + 1):
            own = use[most - back >= least]
            classes = 2 * (most[most - back >= least] - back) + 1
            line = np.repeat(np.arange(len(own)), w[own])
            items = seq.items[np.repeat(at[own], w[own]) + ranges(w[own])]
            base = np.cumsum(classes) - classes
            group = base[line] + (items >> np.uint64(20)).astype(np.int64) % classes[line]
            total = int(classes.sum())
            order = np.argsort(group.astype(np.uint16) if total <= 1 << 16 else group, kind="stable")  # NumPy's radix sort takes 16 bits
            size = np.bincount(group, minlength=total)
            end = np.cumsum(size)
            runs = Sequences(items[order])
            tag = np.repeat(classes, classes) * 65_537 + ranges(classes)
            full = size > 0
            keys.append(mix(runs.runs(end - size, end) + tag.astype(np.uint64))[full])
            lines.append(np.repeat(own, classes)[full])
            poor[np.repeat(own, classes)[~full]] = True
    line = np.concatenate(lines) if lines else np.zeros(0, np.int64)
    key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    order = np.argsort(line, kind="stable")
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(line, minlength=len(w)))]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, signed(key[order])), poor


def _sketches(seq: Sequences, at: np.ndarray, w: np.ndarray, long: float) -> pa.Array:
    """Parities of the numbers of words for each of 256 hash values, as four numbers (list column) of every line with ``long`` words."""
    use = np.flatnonzero(w >= long)
    size = np.zeros(len(w), np.int64)
    size[use] = SKETCH
    bits = np.zeros((len(use), SKETCH), np.uint64)
    if len(use):
        items = seq.items[np.repeat(at[use], w[use]) + ranges(w[use])]
        one = np.uint64(1) << (items & np.uint64(63))
        part = (items >> np.uint64(6)).astype(np.int64) % SKETCH
        head = np.cumsum(w[use]) - w[use]
        for k in range(SKETCH):
            bits[:, k] = np.bitwise_xor.reduceat(np.where(part == k, one, np.uint64(0)), head)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), signed(bits.ravel()))


def _line_table(own: DataFrame, min_words: int, near_words: int, edit_percent: int) -> DataFrame:
    """(id, th, no, w, lh, halves, kept, marks, places, stretches, sketch): every line that counts.

    ``halves`` are the keys of step 2, ``kept`` those of step 5, ``marks`` those of step 6. Spark cuts the lines, so an Arrow
    batch holds so many lines and not so many whole texts.
    """
    long, sizes = _first_long(near_words, edit_percent), _mark_sizes(near_words, edit_percent)

    def work(view: TextView) -> tuple[np.ndarray, list[pa.Array]]:
        seq = Sequences(Hasher(view.data, BYTE_LOWER).spans(view.start, view.end))
        use = np.flatnonzero(view.n_words >= min_words)
        at, w = (np.cumsum(view.n_words) - view.n_words)[use], view.n_words[use]
        keys, line = [], []
        # the shorter line of a pair with bound 1 has long - 1 words at most
        near = np.flatnonzero((w >= near_words) & (w <= long))
        for back in (0, 1):
            own_near = near if back == 0 else near[w[near] % 2 == 0]  # an odd length has one half length only
            f = (w[own_near] - back) // 2
            a, z = at[own_near], at[own_near] + w[own_near]
            tag = f.astype(np.uint64) * np.uint64(2)
            keys += [mix(seq.runs(a, a + f) + tag), mix(seq.runs(z - f, z) + tag + np.uint64(1))]
            line += [own_near, own_near]
        line_all, key_all = np.concatenate(line), np.concatenate(keys)
        order = np.argsort(line_all, kind="stable")
        halves = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(line_all, minlength=len(use)))]).astype(np.int32)),
                                          signed(key_all[order]))
        kept, poor = _class_variants(seq, at, w, long, edit_percent)
        return use, [pa.array(w.astype(np.int32)), signed(seq.runs(at, at + w)), halves, kept, *_marks(seq, at, w, sizes, poor), _sketches(seq, at, w, long)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, _end, data, offs in slices(b.column(3)):
                row, made = work(TextView(data, offs))
                take = pa.array(row + start)
                yield pa.RecordBatch.from_arrays([*[b.column(k).take(take) for k in range(3)], *made], names=schema.names)
        release_memory()

    lists = {"halves": LongType(), "kept": LongType(), "marks": LongType(), "places": IntegerType(), "stretches": IntegerType(), "sketch": LongType()}
    schema = StructType([own.schema["id"], own.schema["th"], StructField("no", IntegerType()), StructField("w", IntegerType()), StructField("lh", LongType()),
                         *[StructField(c, ArrayType(t)) for c, t in lists.items()]])
    return own.select("id", "th", F.posexplode(_lines_of("_text")).alias("no", "line")).mapInArrow(run, schema)


def _candidate_words(own: DataFrame, wanted: DataFrame) -> DataFrame:
    """(lh, kind, words): the word hashes of the lines named in ``wanted`` (id, th, no, lh, kind: a written table), each line hash once.

    The rows of each kind lie in files of their own.
    """
    per_doc = wanted.groupBy("id", "th").agg(F.sort_array(F.collect_list(F.struct("no", "lh", "kind"))).alias("x"))
    per_doc = materialize(per_doc.select("id", "th", "x.no", "x.lh", "x.kind"), "wanted")
    n_wanted = wanted.count()
    docs = own.join(F.broadcast(per_doc) if n_wanted <= BROADCAST_IDS else per_doc, ["id", "th"])
    # Python gets the wanted lines alone, not the texts
    asked = docs.select(F.inline(F.arrays_zip("lh", "kind", _picked(_lines_of("_text"), F.col("no"))))).toDF("lh", "kind", "line")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, end, data, offs in slices(b.column(2)):
                view = TextView(data, offs)
                hashes = Hasher(view.data, BYTE_LOWER).spans(view.start, view.end)
                words = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(view.n_words)]).astype(np.int32)), signed(hashes))
                yield pa.RecordBatch.from_arrays([*[b.column(k).slice(start, end - start) for k in range(2)], words], names=["lh", "kind", "words"])
        release_memory()

    words = materialize(asked.mapInArrow(run, "lh long, kind int, words array<long>"), "words", partition_by=["kind"])
    # rows that repeat an id and a text bring their lines several times
    return materialize(words.dropDuplicates(["lh"]), "words", partition_by=["kind"]) if words.count() > n_wanted else words


def _variants(lines: DataFrame) -> DataFrame:
    """(at, lh, pos, key): the line itself (pos -1) and the line without the word at ``pos``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                part = b.slice(lo, 2000)
                words = part.column(2)
                flat = words.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                w = words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                start = np.cumsum(w) - w
                line, pos = np.repeat(np.arange(len(w)), w), ranges(w)
                seq = Sequences(flat)
                key = seq.without(start[line], (start + w)[line], start[line] + pos)
                line = np.concatenate([np.arange(len(w)), line])
                take = pa.array(line)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take),
                     pa.array(np.concatenate([np.full(len(w), -1), pos]).astype(np.int32)),
                     pa.array(np.concatenate([part.column(1).to_numpy(zero_copy_only=False), key.view(np.int64)]))],
                    names=["at", "lh", "pos", "key"])

    return lines.select("at", "lh", "words").mapInArrow(run, "at long, lh long, pos int, key long")


def within_edits(a: list, b: list, k: int) -> bool:
    """Edit distance over the items of two lists of whole numbers is at most ``k``."""
    n, m = len(a), len(b)
    return abs(n - m) <= k and bool(_block_within(np.array(a, np.int64), np.array(b, np.int64), np.array([n]), np.array([m]), np.array([k]))[0])


def _equal_run(a: np.ndarray, at_a: np.ndarray, b: np.ndarray, at_b: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Number of equal items of ``a`` from each place of ``at_a`` on and ``b`` from ``at_b`` on, at most ``room``."""
    run = np.zeros(len(room), np.int64)
    left = np.flatnonzero(room > 0)
    left = left[a[at_a[left]] == b[at_b[left]]]  # most diagonals end here
    step = np.arange(STEP)
    while len(left):
        ahead = run[left][:, None] + step
        same = ahead < room[left][:, None]
        ahead = np.where(same, ahead, 0)
        same &= a[at_a[left][:, None] + ahead] == b[at_b[left][:, None] + ahead]
        whole = same.all(axis=1)
        run[left] += np.where(whole, STEP, same.argmin(axis=1))
        left = left[whole]
    return run


def _block_within(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Mask of the pairs of lists within ``k`` edits: ``a`` and ``b`` hold their items one after another, ``n`` and ``m`` of them, at most ``k`` apart in number.

    Furthest place on every diagonal after each number of edits, for all pairs at once.
    """
    done = np.zeros(len(n), bool)
    from_a, from_b = np.cumsum(n) - n, np.cumsum(m) - m
    # with k edits in all, a path that ends on diagonal m - n leaves no more diagonals aside
    most = int(((k + np.abs(m - n)) // 2).max())
    diagonal = np.arange(-most, most + 1)
    never = -(1 << 30)
    far = np.full((len(n), 2 * most + 3), never, np.int64)
    pair = np.arange(len(n))
    for e in range(int(k.max()) + 1):
        own_n, own_m = n[pair][:, None], m[pair][:, None]
        at = np.maximum(np.maximum(far[:, 1:-1] + 1, far[:, :-2]), far[:, 2:] + 1)
        if e == 0:
            at[:, most] = 0
        at = np.minimum(at, np.minimum(own_n, own_m - diagonal))
        row, col = np.nonzero((at >= 0) & (at + diagonal >= 0))
        i = at[row, col]
        j, of = i + diagonal[col], pair[row]
        far[:, 1:-1] = never
        far[row, col + 1] = i + _equal_run(a, from_a[of] + i, b, from_b[of] + j, np.minimum(n[of] - i, m[of] - j))
        ended = far[np.arange(len(pair)), m[pair] - n[pair] + most + 1] >= n[pair]
        done[pair[ended]] = True
        keep = ~ended & (k[pair] > e)
        pair, far = pair[keep], far[keep]
        if not len(pair):
            break
    return done


def _pairs_within(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray], edit_percent: int) -> np.ndarray:
    """Mask of the pairs of lists, as (offsets, values), whose edit distance is within the bound of the shorter one."""
    (x_offs, x_items), (y_offs, y_items) = x, y
    n, m = np.diff(x_offs).astype(np.int64), np.diff(y_offs).astype(np.int64)
    k = _bound(np.minimum(n, m), edit_percent)
    right = np.zeros(len(n), bool)
    todo = np.flatnonzero(np.abs(n - m) <= k)
    todo = todo[np.argsort(k[todo], kind="stable")]  # pairs of like bounds share a block
    lo = 0
    while lo < len(todo):
        hi = lo + max(1, int(np.searchsorted((2 * k[todo[lo:]] + 3) * np.arange(1, len(todo) - lo + 1), CELLS, side="right")))
        p = todo[lo:hi]
        items = [values[np.repeat(offs[p].astype(np.int64), size[p]) + ranges(size[p])] for offs, values, size in ((x_offs, x_items, n), (y_offs, y_items, m))]
        right[p] = _block_within(*items, n[p], m[p], k[p])
        lo = hi
    return right


def _near(lines: DataFrame, words: DataFrame) -> DataFrame:
    """(lh) of the distinct ``lines`` (id, no, lh: first places), with ``words`` (lh, words), that match an earlier one at distance 1."""
    # places as one number each, in their order, so that the aggregates need no sort; lines of two texts at one place share it
    order = materialize(lines.select("id", "no").distinct().orderBy("id", "no").withColumn("at", F.monotonically_increasing_id()), "order")
    places = materialize(lines.select("id", "no", "lh").join(order, ["id", "no"]).select("lh", "at"), "places")
    variants = materialize(_variants(words.join(broadcast_if_small(places), "lh")), "variants")
    least = variants.groupBy("key", "pos").agg(F.min("at").alias("m"), F.count(F.lit(1)).alias("c"))
    least = materialize(least.filter("c > 1 or pos = -1").select("key", "pos", "m", "c").union(
        # earliest variant at any position, under position -2
        least.filter("pos >= 0").groupBy("key").agg(F.min("m").alias("m"), F.count(F.lit(1)).alias("c")).select("key", F.lit(-2).alias("pos"), "m", "c")), "least")
    replaced = variants.filter("pos >= 0").join(least.filter("c > 1 and pos >= 0").select("key", "pos", "m"), ["key", "pos"])
    shorter = variants.filter("pos >= 0").join(least.filter("pos = -1").select("key", "m"), "key")
    longer = variants.filter("pos = -1").join(least.filter("pos = -2").select("key", "m"), "key")
    found = reduce(DataFrame.union, [x.filter(F.col("at") > F.col("m")).select("lh", "m") for x in (replaced, shorter, longer)])
    pairs = found.distinct().join(broadcast_if_small(places.select(F.col("lh").alias("other"), F.col("at").alias("m"))), "m")
    return _verified(materialize(pairs.select("lh", "other"), "matches"), words, 0)


def _verified(pairs: DataFrame, words: DataFrame, edit_percent: int) -> DataFrame:
    """(lh) of the lines of ``pairs`` (lh, other) whose words are within the bound of the other's."""
    both = pairs.join(words.select("lh", "words"), "lh").join(words.select(F.col("lh").alias("other"), F.col("words").alias("others")), "other")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = ((c.offsets.to_numpy(), c.values.to_numpy(zero_copy_only=False)) for c in (b.column(1), b.column(2)))
            right = _pairs_within(x, y, edit_percent)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(right))], names=["lh"])
        release_memory()

    return both.select("lh", "words", "others").mapInArrow(verify, "lh long").distinct()


def _sketch_parts() -> list[Column]:
    return [F.get("sketch", k).alias(c) for k, c in enumerate(PARTS)]


def _may_match(other: str, edit_percent: int) -> Column:
    """Order, lengths and sketches of a pair allow a match; the earlier line has its columns under the prefix ``other``."""
    k = _bound(F.least(F.col("w"), F.col(f"{other}w")), edit_percent)
    bits = sum(F.bit_count(F.col(c).bitwiseXOR(F.col(f"{other}{c}"))) for c in PARTS)
    return (F.col("at") > F.col(f"{other}at")) & (F.abs(F.col("w") - F.col(f"{other}w")) <= k) & (bits <= 2 * k)


def _class_keys(first: DataFrame) -> DataFrame:
    """(key, n, lh, w, at, th, sketch parts): the lines by each one-class variant that two lines or more, ``n``, have (step 5)."""
    keys = first.filter(F.size("kept") > 0).select("lh", "w", F.struct("first.id", "first.no").alias("at"), F.col("first.th").alias("th"), *_sketch_parts(),
                                                   F.explode("kept").alias("key"))
    shared = materialize(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared")
    return materialize(keys.join(broadcast_if_small(shared), "key"), "met")


def _near_by_classes(met: DataFrame, words: DataFrame, near: DataFrame, edit_percent: int) -> DataFrame:
    """(lh) of the distinct lines of ``met``, besides ``near`` (lh), that match an earlier one by two edits or more (step 5)."""
    left = met.join(near, "lh", "left_anti")
    large = met.filter(F.col("n") > PIVOTS)
    own = ("at", "lh", "w", *PARTS)
    # lines with many partners meet one of some pivots, so that few of them are left for the search among all
    part = F.pmod(F.xxhash64("lh"), F.lit(PIVOTS)).alias("part")
    pivots = materialize(large.groupBy("key", part).agg(F.min(F.struct(*own)).alias("m")).select("key", "m.*"), "pivots")

    def pairs(left: DataFrame, others: DataFrame) -> DataFrame:
        earlier = others.select("key", *[F.col(c).alias(f"e_{c}") for c in own])
        both = left.join(earlier, "key").filter(_may_match("e_", edit_percent))
        return materialize(both.select("lh", F.col("e_lh").alias("other")).distinct(), "pairs")

    some = met.filter(F.col("n") <= PIVOTS).select("key", *own).unionByName(pivots)
    by_some = materialize(_verified(pairs(left, some), words, edit_percent), "by_some")
    rest = left.filter(F.col("n") > PIVOTS).join(by_some, "lh", "left_anti")
    return by_some.union(_verified(pairs(rest, large), words, edit_percent))


def _mark_size(x) -> Column:
    """Class of a length; a class reaches to 1.25 times its least length."""
    return F.floor(F.log(x) / math.log(1.25)).cast("int")


def _shared_marks(first: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lh, w, at, th, sketch parts) of the lines with marks; (mark, often, lh, w, place, stretch, size) of the marks that two different lines have (step 6)."""
    poor = first.filter(F.size("marks") > 0).select("lh", "w", F.struct("first.id", "first.no").alias("at"), F.col("first.th").alias("th"), *_sketch_parts(),
                                                    "marks", "places", "stretches")
    poor = materialize(poor, "poor")
    marks = poor.select("lh", "w", F.explode(F.arrays_zip("marks", "places", "stretches")).alias("x"))
    marks = materialize(marks.select("lh", "w", F.col("x.marks").alias("mark"), F.col("x.places").alias("place"), F.col("x.stretches").alias("stretch")), "all_marks")
    shared = marks.groupBy("mark").agg(F.min("lh").alias("a"), F.max("lh").alias("b"), F.count(F.lit(1)).alias("often")).filter("a <> b")
    shared = materialize(shared.select("mark", "often"), "shared_marks")
    marks = materialize(marks.join(broadcast_if_small(shared), "mark").withColumn("size", _mark_size(F.col("w").cast("double"))), "marks")
    return poor.select("lh", "w", "at", "th", *PARTS), marks


def _near_by_marks(poor: DataFrame, own_marks: DataFrame, words: DataFrame, near: DataFrame, edit_percent: int, span: int) -> DataFrame:
    """(lh) of the distinct lines, besides ``near`` (lh), that match an earlier one by two edits or more (step 6).

    ``poor`` and ``own_marks`` are from ``_shared_marks``; ``span`` is the number of words of a stretch.
    """
    size = _mark_size
    bound = _bound(F.col("w"), edit_percent)
    # an earlier line of w' words may be longer, and the smaller length sets the bound of a pair
    needed = bound + 1 - (F.floor(F.col("w") / span) - F.count(F.lit(1)).over(Window.partitionBy("lh")))
    rarest = F.row_number().over(Window.partitionBy("lh").orderBy("often", "mark", "place"))
    seeks = own_marks.filter("stretch >= 0").join(near, "lh", "left_anti").withColumn("needed", needed).withColumn("nth", rarest)
    # a mark that a line repeats is one row with its first and last place, so that two such lines are one pair
    spread = [F.min("place").alias("lo"), F.max("place").alias("hi")]
    more = poor.select("lh", "at", *PARTS)
    seeks = materialize(seeks.filter("nth <= needed").groupBy("lh", "w", "mark", "size").agg(*spread).join(broadcast_if_small(more), "lh"), "seeks")
    met = seeks.select("mark").distinct()
    own_marks = own_marks.join(met, "mark", "left_semi").groupBy("lh", "w", "mark", "size").agg(*spread)
    own_marks = materialize(own_marks.join(broadcast_if_small(more), "lh"), "met_marks")
    # lengths that a match may have, by class of length
    reach = F.lit(1 - edit_percent / 100)
    classes = F.array_distinct(F.array(size(F.col("w") * reach - 0.001), F.col("size"), size(F.col("w") / reach + 0.001)))
    seeks = seeks.withColumn("size", F.explode(classes))
    least = materialize(own_marks.groupBy("mark", "size").agg(F.min(F.struct("at", "lh", "w", *PARTS)).alias("m")), "least_marks")
    pairs = seeks.join(least, ["mark", "size"]).filter(_may_match("m.", edit_percent)).select("lh", F.col("m.lh").alias("other")).distinct()
    by_least = materialize(_verified(materialize(pairs, "pairs"), words, edit_percent), "by_least")
    # The place in steps of the largest bound in the class. A mark in one spot of a line lies in the step of its first place, and
    # a line left that has it in one spot looks in every step that its own bound reaches. Marks spread over a line meet all: -1 is
    # where the earlier line's mark is spread, -2 where only that of the line left is. So a pair is made once a mark.
    width = F.floor(F.pow(F.lit(1.25), F.col("size") + 1) * edit_percent / 100).cast("int") + 1
    cell = lambda x: F.floor(x / width).cast("int")
    spot = F.col("hi") - F.col("lo") < width
    k = _bound(F.col("w"), edit_percent)
    reached = F.sequence(F.greatest(cell(F.col("lo") - k - width + 1), F.lit(0)), cell(F.col("hi") + k))
    left = seeks.join(by_least, "lh", "left_anti").withColumn(
        "cell", F.explode(F.when(spot, F.concat(F.array(F.lit(-1)), reached)).otherwise(F.array(F.lit(-1), F.lit(-2)))))
    earlier = own_marks.withColumn("cell", F.explode(F.when(spot, F.array(cell(F.col("lo")), F.lit(-2))).otherwise(F.array(F.lit(-1)))))
    earlier = earlier.select("mark", "size", "cell", *[F.col(c).alias(f"e_{c}") for c in ("lh", "w", "at", "lo", "hi", *PARTS)])
    rest = left.join(earlier, ["mark", "size", "cell"]).filter(
        _may_match("e_", edit_percent) & (F.col("lo") - k <= F.col("e_hi")) & (F.col("e_lo") <= F.col("hi") + k))
    found = _verified(materialize(rest.select("lh", F.col("e_lh").alias("other")).distinct(), "pairs"), words, edit_percent)
    return by_least.union(found)


def removed_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", *, min_words: int = 1, near_words: int = 10,
                  edit_percent: int = 5) -> DataFrame:
    """(id, th, removed): sorted numbers (from 0) of the lines that match an earlier line, for each id and xxhash64 of a text."""
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{text_col}`").alias("th"), F.col(f"`{text_col}`").alias("_text")).filter("id is not null")
    lines = materialize(_line_table(own, min_words, near_words, edit_percent), "lines")
    first = materialize(lines.groupBy("lh").agg(F.min(F.struct("id", "no", "th")).alias("first"), F.count(F.lit(1)).alias("n"),
                                                F.any_value(F.struct("w", "halves", "kept", "marks", "places", "stretches", "sketch")).alias("x")).select("lh", "first", "n", "x.*"), "distinct")
    halves = first.select("lh", "first", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("half")
    shared = materialize(shared, "halves")  # written, so the rows of a hot half can be split in the join
    kinds = [halves.join(shared, "half", "left_semi").select("first.id", "first.th", "first.no", "lh", F.lit(HALVES).alias("kind"))]
    if edit_percent > 0:
        met = _class_keys(first)
        poor, marks = _shared_marks(first)
        kinds += [met.select("at.id", "th", "at.no", "lh", F.lit(CLASSES).alias("kind")),
                  poor.join(marks, "lh", "left_semi").select("at.id", "th", "at.no", "lh", F.lit(MARKS).alias("kind"))]
    # the texts are read once for the words of all these lines
    wanted = reduce(DataFrame.union, kinds).groupBy("id", "th", "no", "lh").agg(F.bit_or("kind").alias("kind"))
    wanted = materialize(wanted, "candidates")
    words = _candidate_words(own, wanted)
    of_kind = lambda kind, rows=words: rows.filter(F.col("kind").bitwiseAND(kind) > 0)
    near = _near(of_kind(HALVES, wanted), of_kind(HALVES))
    if edit_percent > 0:
        near = materialize(near, "near")
        near = materialize(near.union(_near_by_classes(met, of_kind(CLASSES), near, edit_percent)), "near")
        _, run, beside = _mark_sizes(near_words, edit_percent)
        near = near.union(_near_by_marks(poor, marks, of_kind(MARKS), near, edit_percent, run + beside - 1))
    near = near.select("lh", F.lit(True).alias("near"))
    told = materialize(first.select("lh", "first", "n").join(near, "lh", "left").filter("n > 1 or near")
                       .select("lh", F.struct("first.id", "first.no").alias("first"), F.coalesce("near", F.lit(False)).alias("near")), "told")
    gone = lines.select("lh", "id", "th", "no").join(broadcast_if_small(told), "lh").filter(F.col("near") | (F.struct("id", "no") > F.col("first")))
    return gone.groupBy("id", "th").agg(F.sort_array(F.collect_set("no")).alias("removed"))


def drop_repeated_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", *, min_words: int = 1, near_words: int = 10,
                        edit_percent: int = 5, n_lines: str = "n_lines", n_removed: str = "n_removed") -> DataFrame:
    """All columns of ``docs`` with ``text_col`` free of its repeated lines, plus the line counts before and removed."""
    gone = materialize(removed_lines(docs, text_col, id_col, min_words=min_words, near_words=near_words, edit_percent=edit_percent), "gone")
    names = [c for c in docs.columns if c not in (n_lines, n_removed)]
    kept = docs.select(*[F.col(f"`{c}`") for c in names])
    # line numbers only, broadcast while their files are small: then the texts are not shuffled
    numbers = broadcast_if_small(gone.select(F.col("id").alias("_gone_id"), F.col("th").alias("_gone_th"), F.col("removed").alias("_removed")))
    marked = kept.join(numbers, (F.col(f"`{id_col}`") == F.col("_gone_id")) & (F.xxhash64(f"`{text_col}`") == F.col("_gone_th")), "left")
    # row by row in the scan: Arrow batches of so many whole texts, there and back, took most of an executor's memory
    text, out = F.col(f"`{text_col}`"), F.col("_removed")
    total = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    left = F.array_join(_picked(_lines_of(f"`{text_col}`"), F.array_except(F.sequence(F.lit(0), total - 1), out)), "\n")
    return marked.select(*[F.when(out.isNotNull() & text.isNotNull(), left).otherwise(text).alias(c) if c == text_col else F.col(f"`{c}`") for c in names],
                         F.when(text.isNull(), 0).otherwise(total).cast("long").alias(n_lines),
                         F.when(out.isNull(), 0).otherwise(F.size(out)).cast("long").alias(n_removed))
