r"""Near-duplicate documents by SuperMinHash.

* Words are ``[^\x20\x09-\x0D]+`` of the text with A-Z in lower case; a
  document's set holds its distinct five-word shingles (fewer words: the whole
  sequence as one; none: the empty set, linked with nothing).
* SuperMinHash: every shingle draws a random permutation of the signature's
  slots by Fisher-Yates; at step j it offers slot ``permutation[j]`` the value
  j + random. A slot keeps its least offer. Since offers of step j+1 are above
  j+1, a document is done as soon as each slot holds less than that: most
  shingles make one step only.
* Documents with equal sets form one class at once. Class representatives are
  banded; the members of a bucket are verified, on their full sets, against
  two pivots: the member that meets most others in its buckets, and one drawn
  at random. Verified links are grouped by union-find.
* Remainder: in buckets that still hold several components, any further link
  must join two of them. Those documents meet again on the rarest shingles of
  their sets (a prefix long enough that sets of the wanted similarity share
  one of them), and the pairs from different components are verified. So no
  bucket is ever expanded into all its pairs and no link is lost there.

With 28 bands of 5 slots a pair at similarity 0.85 misses every bucket with a
probability below 1e-7.

Edge cases: a null text has the empty set; a row with a null id is never
linked, has a null component and is kept; rows with one id are one document: it
is linked with what any of its texts is like, all its rows have one component,
and each row's ``n_shingles`` is that of its own text; other columns pass through where the caller asks for them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField

from memweave.llm.bytespans import BYTE_LOWER, Hasher, Sequences, mix, signed, windows
from memweave.llm.components import connected_components
from memweave.llm.textview import TextView, map_texts
from memweave.session import materialize

WORDS, BANDS, ROWS = 5, 28, 5
#: Shingles that a row of the remainder's join carries; a longer head only prunes more.
HEAD = 96
#: Ids are broadcast up to this many (8 bytes each); beyond it the join shuffles.
BROADCAST_IDS = 2_000_000


def shingles(view: TextView, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of every row."""
    words = Hasher(view.data, BYTE_LOWER).spans(view.start, view.end)
    seq, at = Sequences(words), windows(view.row, size)
    rows, keys = [view.row[at]], [seq.runs(at, at + size)]
    short = np.flatnonzero((view.n_words > 0) & (view.n_words < size))
    if len(short):
        first = np.searchsorted(view.row, short)
        rows.append(short)
        keys.append(seq.runs(first, first + view.n_words[short]))
    row, key = np.concatenate(rows), np.concatenate(keys)
    once = ~view.later_copies(row, key)
    row, key = row[once], key[once]
    order = np.argsort(row, kind="stable")
    return row[order], key[order]


def super_minhash(row: np.ndarray, key: np.ndarray, rows: int, slots: int) -> np.ndarray:
    """Signatures (rows x slots, uint64: step in the top bits, random value below); rows without elements stay at the maximum."""
    best = np.full(rows * slots, np.iinfo(np.uint64).max, np.uint64)
    swapped = None  # permutation state of the elements still at work, from step 1 on
    for step in range(slots):
        if not len(row):
            break
        draw = mix(key + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        pick = step + ((draw & np.uint64(0xFFFF)) * np.uint64(slots - step) >> np.uint64(16)).astype(np.int64)
        if step == 0:
            slot = pick
        else:
            lane = np.arange(len(row))
            slot = swapped[lane, pick].astype(np.int64)
            swapped[lane, pick] = swapped[:, step]
        np.minimum.at(best, row * slots + slot, np.uint64(step << 48) | draw >> np.uint64(16))
        open_rows = best.reshape(rows, slots).max(1) >= np.uint64((step + 1) << 48)
        stay = open_rows[row]
        if step == 0:
            row, key, pick = row[stay], key[stay], pick[stay]
            swapped = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(row), 1))
            swapped[np.arange(len(row)), pick] = 0
        elif not stay.all():
            row, key, swapped = row[stay], key[stay], swapped[stay]
    return best.reshape(rows, slots)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(documents x bands) keys; the band's number is part of the key."""
    out = np.empty((len(signature), bands), np.uint64)
    for b in range(bands):
        acc = np.full(len(signature), b * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF, np.uint64)
        for x in signature[:, b * rows:(b + 1) * rows].T:
            acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + x)
        out[:, b] = acc
    return out


def _sums(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    edge = np.searchsorted(row, np.arange(rows + 1))
    return sums[edge[1:]] - sums[edge[:-1]]


def signatures(docs: DataFrame, text_col: str, id_col: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, n, s1, s2, bands): set size, a 128-bit name of the set, and the band keys (null for the empty set)."""
    out = [StructField(c, LongType()) for c in ("n", "s1", "s2")] + [StructField("bands", ArrayType(LongType()))]

    def work(view: TextView) -> list[pa.Array]:
        row, key = shingles(view)
        n = np.bincount(row, minlength=view.rows)
        names = [_sums(mix(key ^ np.uint64(salt)), row, view.rows) for salt in (0x1234567, 0x7654321FEDCBA)]
        keys = band_keys(super_minhash(row, key, view.rows, bands * rows), bands, rows)
        ends = np.cumsum(np.where(n > 0, bands, 0))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), signed(keys[n > 0].ravel()))
        return [pa.array(n.astype(np.int64)), *map(signed, names), lists]

    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("_text"))
    return map_texts(own, "_text", ["id"], out, work)


def shingle_sets(docs: DataFrame, text_col: str, id_col: str, ids: DataFrame) -> DataFrame:
    """(id, n, name, items): the full sets of the documents named in ``ids`` (id); one row per id and set."""
    def work(view: TextView) -> list[pa.Array]:
        row, key = shingles(view)
        n = np.bincount(row, minlength=view.rows)
        return [pa.array(n.astype(np.int64)), signed(_sums(mix(key), row, view.rows)),
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), signed(key))]

    small = ids.count() <= BROADCAST_IDS
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("_text"))
    own = own.join(F.broadcast(ids) if small else ids, "id", "left_semi")
    out = [StructField("n", LongType()), StructField("name", LongType()), StructField("items", ArrayType(LongType()))]
    return materialize(map_texts(own, "_text", ["id"], out, work).dropDuplicates(["id", "n", "name"]), "sets")


def _similar(shared: Column, n1: Column, n2: Column, percent: int) -> Column:
    return 100 * shared >= percent * (n1 + n2 - shared)


def _may_match(n1: Column, n2: Column, percent: int) -> Column:
    return 100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) of which some full sets reach the similarity (an id may have several)."""
    a = sets.select(F.col("id").alias("u"), F.col("items").alias("a"))
    b = sets.select(F.col("id").alias("v"), F.col("items").alias("b"))
    both = pairs.join(a, "u").join(b, "v")
    shared = F.size(F.array_intersect("a", "b"))
    return both.filter(_similar(shared, F.size("a"), F.size("b"), percent)).select("u", "v")


def _remainder(members: DataFrame, sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs from different components that may be similar, among the documents of buckets that hold several components.

    Only shingles met in two components or more can be shared by such a pair,
    so a document with ``c`` of them shares ``c`` at most. A set's prefix has
    n - ceil(percent/100 * n) + 1 of its shingles, those of the fewest
    components first; two sets of the wanted similarity share a shingle of
    their prefixes, and a pair is listed at the first one they share. Each row
    carries the first HEAD of its shareable shingles to bound the overlap.
    """
    named = members.join(groups, members["id"] == groups["node"], "left").select("key", "id", F.coalesce("component", "id").alias("g"))
    mixed = materialize(named.groupBy("key").agg(F.min("g").alias("low"), F.max("g").alias("high")).filter("low <> high").select("key"), "mixed")
    ids = materialize(named.join(mixed, "key", "left_semi").select("id", "g").distinct(), "rest")
    items = materialize(sets.join(ids, "id").select("id", "g", "n", "name", F.explode("items").alias("item")), "rest")
    often = materialize(items.select("item", "g").distinct().groupBy("item").agg(F.count(F.lit(1)).alias("df")), "often")
    ranked = items.join(often, "item").groupBy("id", "g", "n", "name").agg(F.sort_array(F.collect_list(F.struct("df", "item"))).alias("all"))
    length = F.col("n") - F.ceil(F.col("n") * F.lit(percent) / 100) + 1
    shared_items = F.transform(F.filter("all", lambda x: x["df"] > 1), lambda x: x["item"])
    prefix = F.transform(F.filter(F.slice("all", F.lit(1), length.cast("int")), lambda x: x["df"] > 1), lambda x: x["item"])
    ranked = ranked.select("id", "g", "n", shared_items.alias("common"), prefix.alias("prefix"))
    ranked = ranked.select("id", "g", "n", F.size("common").alias("c"), F.slice("common", 1, HEAD).alias("head"), "prefix")
    ranked = materialize(ranked.filter(_similar(F.col("c"), F.col("n"), F.col("c"), percent)), "prefix")
    listed = ranked.select(F.explode("prefix").alias("item"), "id", "g", "n", "c", "head")
    a, b = (listed.select(F.col("item").alias(f"item_{side}"), *[F.col(x).alias(f"{x}_{side}") for x in ("id", "g", "n", "c", "head")])
            for side in "ab")
    both = F.array_intersect("head_a", "head_b")
    # what is shared lies in both heads or, at most, in all of the longer rest behind them
    rest = F.greatest(F.col("c_a") - F.size("head_a"), F.col("c_b") - F.size("head_b"))
    most = F.least("c_a", "c_b", F.size(both) + rest)
    pairs = a.join(b, (F.col("item_a") == F.col("item_b")) & (F.col("id_a") > F.col("id_b")) & (F.col("g_a") != F.col("g_b"))
                   & F.coalesce(F.get(both, 0) == F.col("item_a"), F.lit(True)) & _similar(most, F.col("n_a"), F.col("n_b"), percent))
    return pairs.select(F.col("id_a").alias("u"), F.col("id_b").alias("v")).distinct()


def _one_id(linked: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes in which one id stands with several texts."""
    several = linked.groupBy("id").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("s1", "s2") for f in (F.min, F.max)])
    several = materialize(several.filter("min_s1 <> max_s1 or min_s2 <> max_s2").select("id"), "several")
    named = classes.select("s1", "s2", "n", F.col("id").alias("u"))
    held = materialize(linked.select("id", "s1", "s2", "n").join(several, "id", "left_semi").join(named, ["s1", "s2", "n"]).select("id", "u").distinct(), "held")
    first = held.groupBy("id").agg(F.min("u").alias("v"))
    return held.join(first, "id").filter("u <> v").select("u", "v").distinct()


def group_near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", *, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component): one row per input row; rows of one id with different texts are one document with several sets.

    ``percent`` is the least Jaccard similarity of a link; it should not lie
    far below 80, where the banding's misses would no longer be negligible.
    """
    sig = materialize(signatures(docs, text_col, id_col), "signatures")
    linked = sig.filter("id is not null and n > 0")
    # equal sets: one class, named by its smallest id; its members have equal bands too
    classes = materialize(linked.groupBy("s1", "s2", "n").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("size"),
                                                             F.any_value("bands").alias("bands")), "classes")
    members = classes.select("id", "n", F.explode("bands").alias("key"))
    # written aggregates: both sides of the joins with them are shuffled, so a hot key's rows can be split
    often = materialize(members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "sizes")
    shared = materialize(members.join(often, "key"), "buckets")
    # a bucket's pivots: the member that meets the most others over all its buckets, and one drawn by a hash
    degree = shared.groupBy("id").agg(F.sum("size").alias("degree"))
    ranked = shared.join(degree, "id").groupBy("key").agg(F.max(F.struct("degree", "id", "n")).alias("p"),
                                                          F.min(F.struct(F.xxhash64("id", "key").alias("h"), "id", "n")).alias("q"))
    pivots = ranked.select("key", F.explode(F.array(F.struct("p.id", "p.n"), F.struct("q.id", "q.n"))).alias("x"))
    pivots = materialize(pivots.select("key", F.col("x.id").alias("pivot"), F.col("x.n").alias("pn")), "pivots")
    pairs = (shared.join(pivots, "key").filter((F.col("id") != F.col("pivot")) & _may_match(F.col("n"), F.col("pn"), percent))
             .select(F.greatest("id", "pivot").alias("u"), F.least("id", "pivot").alias("v")).distinct())
    pairs = materialize(pairs, "pairs")
    ids = materialize(shared.select("id").distinct(), "ids")
    sets = shingle_sets(docs, text_col, id_col, ids)
    links = materialize(_verified(pairs, sets, percent).union(_one_id(linked, classes)), "links")
    groups = materialize(connected_components(links), "groups")
    more = materialize(_verified(_remainder(shared.select("key", "id"), sets, groups, percent), sets, percent), "links")
    if more.limit(1).count():
        groups = materialize(connected_components(links.union(more)), "groups")
    named = classes.join(groups, classes["id"] == groups["node"], "left").select("s1", "s2", "n", "size", F.coalesce("component", "id").alias("component"),
                                                                                "id")
    named = materialize(named.filter("size > 1 or component <> id").select("s1", "s2", "n", "component"), "named")
    out = sig.join(named, ["s1", "s2", "n"], "left")
    return out.select("id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component"))
