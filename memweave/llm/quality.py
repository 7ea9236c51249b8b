"""Quality classifier from weak labels.

1. Labellers: overlapping heuristics look at every document and vote bad, good
   or abstain, for two targets: ``junk`` (form) and ``toxic`` (words). Where a
   table of human labels is given, the annotators are one more labeller, which
   abstains on the documents it does not cover.
2. Expectation-maximisation over the counts of all vote patterns estimates how
   often each labeller gives each vote on either class, and from that the
   posterior of every pattern. Counts cover all documents; the number of
   patterns depends on the labellers, not on the input's size.
3. A hashed linear scorer (logistic loss, sparse weights over words, word
   beginnings and steps of the measures) learns the posteriors on a bounded
   sample of documents: the first ``train_rows`` by a hash of those the
   annotators cover, or, if these are few, of all others too. It scores every
   whole text.

``kept`` is true when both scores are below ``threshold``.

Edge cases: a null or empty text, or one without words, scores 1 for junk and
is not kept; repeated texts get equal scores; rows with a null id are scored
like others but meet no annotator; several labels of one document count as bad
if any is bad; other columns pass through. Without any document that has words,
every row falls under the first rule.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StructField

from memweave.llm.bytespans import BYTE_LOWER, Hasher, mix
from memweave.llm.sampling import first_by_hash
from memweave.llm.textview import IS_CONTINUATION, IS_LETTER, IS_SYMBOL, IS_UPPER, TextView, byte_set, map_texts

#: Words of abuse, lower case (two overlapping lists for two labellers).
INSULTS = ("idiot", "idiots", "moron", "morons", "stupid", "dumb", "loser", "losers", "clown", "scum", "trash", "jerk", "imbecile",
           "retard", "bastard", "coward")
ABUSE = ("disgusting", "pathetic", "worthless", "garbage", "trash", "scum", "filthy", "useless", "loser", "moron", "fuck", "fucking",
         "bitch", "asshole")

BAD, GOOD, ABSTAIN = 1, 0, 2
BITS = 19
N_FEATURES = 1 << BITS
SENTENCE = byte_set(b".!?")
SEPARATOR = byte_set(b"|")


def _hashes(words: tuple[str, ...]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    start = end - [len(w) for w in words]
    return np.sort(Hasher(data, BYTE_LOWER).spans(start, end))


INSULT_HASH, ABUSE_HASH = _hashes(INSULTS), _hashes(ABUSE)


def _is_in(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(table, x), len(table) - 1)
    return table[at] == x


def measures(view: TextView) -> dict[str, np.ndarray]:
    """Shares of each row that the labellers and the scorer read; 0 where a row has no words."""
    n = np.maximum(view.n_words, 1)
    data = view.data
    letters = IS_LETTER[data]
    chars = np.maximum(view.total(view.word_bytes & ~IS_CONTINUATION[data]), 1)
    last = data[view.end - 1] if len(view.end) else data[:0]
    bare_start, bare_end = view.bare
    same = np.zeros(len(view.row), bool)
    same[1:] = (view.row[1:] == view.row[:-1]) & (view.word_hash[1:] == view.word_hash[:-1])
    lines = np.maximum(np.bincount(view.lines[2][view.line_words > 0], minlength=view.rows), 1)
    long_line = view.line_words >= 12
    unmarked = long_line & (view.within(SENTENCE[data], view.lines[0], view.lines[1]) == 0)
    unmarked_words = np.bincount(view.lines[2][unmarked], weights=view.line_words[unmarked], minlength=view.rows)
    return {
        "symbol": view.total(IS_SYMBOL[data]) / chars,
        "symbol_end": view.per_row(IS_SYMBOL[last]) / n,
        "bare_less": view.per_row(bare_end == bare_start) / n,
        "upper": view.total(IS_UPPER[data]) / np.maximum(view.total(letters), 1),
        "shout": view.per_row(last == 33) / n,
        "bar": view.per_row(SEPARATOR[last]) / n,
        "twin": view.per_row(same) / n,
        "copied": view.n_dup_lines / lines,
        "repeat": view.repeated_words(5) / n,
        "unmarked": unmarked_words / n,
        "letters": view.total(letters & ~IS_CONTINUATION[data]) / chars,
    }


def junk_votes(view: TextView, m: dict[str, np.ndarray]) -> np.ndarray:
    """One row per labeller. A labeller votes bad above its upper bound, good below its lower one, else abstains."""
    bounds = [("symbol", 0.005, 0.08), ("symbol_end", 0.01, 0.25), ("bare_less", 0.02, 0.15), ("bar", 0.01, 0.15), ("upper", 0.25, 0.6),
              ("shout", 0.1, 0.5), ("twin", 0.03, 0.15), ("repeat", 0.1, 0.45), ("copied", 0.2, 0.5), ("unmarked", 0.2, 0.6)]
    votes = [np.where(m[k] > high, BAD, np.where(m[k] <= low, GOOD, ABSTAIN)) for k, low, high in bounds]
    votes.append(np.where(m["letters"] < 0.6, BAD, np.where(m["letters"] > 0.75, GOOD, ABSTAIN)))
    return np.stack(votes)


def toxic_votes(view: TextView) -> np.ndarray:
    insult = view.per_row(_is_in(view.bare_hash, INSULT_HASH))
    abuse = view.per_row(_is_in(view.bare_hash, ABUSE_HASH))
    both = insult + abuse
    share = both / np.maximum(view.n_words, 1)
    return np.stack([np.where(insult > 0, BAD, ABSTAIN), np.where(abuse > 0, BAD, ABSTAIN),
                     np.where(both > 1, BAD, np.where(both == 0, GOOD, ABSTAIN)), np.where(share > 0.002, BAD, ABSTAIN)])


def pack_votes(votes: np.ndarray) -> np.ndarray:
    code = np.zeros(votes.shape[1], np.int64)
    for v in votes:
        code = code * 3 + v
    return code


def unpack_votes(codes: np.ndarray, labellers: int) -> np.ndarray:
    return np.stack([codes // 3 ** (labellers - 1 - k) % 3 for k in range(labellers)])


def fit_labellers(votes: np.ndarray, counts: np.ndarray, rounds: int = 60, need: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """EM for two classes: (posterior of bad for each pattern, probability [class, labeller, vote good or bad]).

    ``votes`` is labellers x patterns. A pattern with ``need`` bad votes or
    more starts as bad. An abstention says nothing about the class. A bad vote
    is never taken as evidence for good: its rate on bad documents is held at
    or above that on good ones.
    """
    posterior = np.where((votes == BAD).sum(0) >= need, 0.9, 0.1)
    onehot = np.stack([votes == v for v in (GOOD, BAD)], axis=1).astype(float)  # labeller, vote, pattern
    for _ in range(rounds):
        weight = np.stack([counts * (1 - posterior), counts * posterior])  # class, pattern
        table = np.einsum("lvp,cp->clv", onehot, weight) + 0.5
        table /= table.sum(2, keepdims=True)
        table[1, :, 1] = np.maximum(table[1, :, 1], table[0, :, 1])
        table[1, :, 0] = 1 - table[1, :, 1]
        prior = (weight.sum(1) + 1) / (counts.sum() + 2)
        score = np.log(prior)[:, None] + np.einsum("lvp,clv->cp", onehot, np.log(np.maximum(table, 1e-9)))
        posterior = 1 / (1 + np.exp(np.clip(score[0] - score[1], -40, 40)))
    return posterior, table


#: Row measures enter the scorer as indicators "share above this step".
STEPS = (0.005, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75)


#: Lengths in bytes of the word beginnings that are features beside the whole words.
BEGINNINGS = (4, 5, 6)


def features(view: TextView, m: dict[str, np.ndarray], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature index), each pair once: bare words, their beginnings, and the steps that the measures pass.

    ``wanted`` masks the features that count; the others are left out early.
    """
    start, end = view.bare
    hashes = Hasher(view.data, BYTE_LOWER)
    rows, index = [], []

    def add(row: np.ndarray, idx: np.ndarray) -> None:
        if wanted is not None:
            chosen = wanted[idx]
            row, idx = row[chosen], idx[chosen]
        rows.append(row)
        index.append(idx)

    shift = np.uint64(64 - BITS)
    add(view.row, (mix(view.bare_hash) >> shift).astype(np.int64))
    for n in BEGINNINGS:
        long = np.flatnonzero(end - start > n)
        code = mix(hashes.spans(start[long], start[long] + n) + np.uint64(n)) >> shift
        add(view.row[long], code.astype(np.int64))
    for k, name in enumerate(sorted(m)):
        for s, step in enumerate(STEPS):
            r = np.flatnonzero(m[name] > step)
            add(r, np.full(len(r), N_FEATURES + k * len(STEPS) + s, np.int64))
    seen = np.unique(np.concatenate(rows).astype(np.int64) * N_WEIGHTS + np.concatenate(index))
    return seen // N_WEIGHTS, seen % N_WEIGHTS


N_WEIGHTS = N_FEATURES + 11 * len(STEPS)
#: Features met in fewer training rows get no weight.
LEAST_ROWS = 4
#: Documents above this length are no training documents, so that the sample's features stay small on the driver.
TRAIN_CHARS = 200_000
#: With fewer annotated training rows the others' weak labels are learned from as well.
ENOUGH = 1000


def fit_scorer(row: np.ndarray, index: np.ndarray, target: np.ndarray, weight: np.ndarray, *, rounds: int = 80,
               penalty: float = 0.03) -> tuple[np.ndarray, float]:
    """Sparse logistic regression by proximal gradient steps with a rate for each weight: (weights, bias).

    The penalty shrinks with the root of the sample's size.
    """
    w, bias = np.zeros(N_WEIGHTS, np.float32), 0.0
    if not len(target):
        return w, bias
    penalty /= np.sqrt(len(target))
    used, inverse = np.unique(index, return_inverse=True)
    own, square = np.zeros(len(used)), np.full(len(used), 1e-10)
    bias_square, total = 1e-10, max(weight.sum(), 1e-9)
    for _ in range(rounds):
        z = bias + np.bincount(row, weights=own[inverse], minlength=len(target))
        error = weight * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - target) / total
        grad = np.bincount(inverse, weights=error[row], minlength=len(used))
        square += grad ** 2
        rate = 0.5 / np.sqrt(square)
        own -= rate * grad
        own = np.sign(own) * np.maximum(np.abs(own) - rate * penalty, 0)
        bias_square += error.sum() ** 2
        bias -= 0.5 * error.sum() / np.sqrt(bias_square)
    w[used] = own
    return w, float(bias)


def _vote(view: TextView) -> list[pa.Array]:
    return [pa.array(pack_votes(junk_votes(view, measures(view)))), pa.array(pack_votes(toxic_votes(view))), pa.array(view.n_words > 0)]


_VOTE_COLS = [StructField("junk_votes", LongType()), StructField("toxic_votes", LongType()), StructField("has_words", BooleanType())]


def _annotated(votes: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Append the annotators' vote to both packed vote codes."""
    if labels is None:
        junk = toxic = F.lit(ABSTAIN)
    else:
        own = labels.groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_quality"), F.max("toxic").alias("_toxic"))
        votes = votes.join(own, "_id", "left")
        junk = F.when(F.col("_quality") == 0, BAD).when(F.col("_quality") == 1, GOOD).otherwise(ABSTAIN)
        toxic = F.when(F.col("_toxic") == 1, BAD).when(F.col("_toxic") == 0, GOOD).otherwise(ABSTAIN)
    return votes.withColumn("junk_votes", F.col("junk_votes") * 3 + junk).withColumn("toxic_votes", F.col("toxic_votes") * 3 + toxic)


#: Name of the packed votes and the number of labellers, annotators included.
TARGETS = (("junk_votes", 12), ("toxic_votes", 5))


def classify(docs: DataFrame, labels: DataFrame | None = None, text_col: str = "text", id_col: str = "doc_id",
             keep: list[str] | None = None, *, train_rows: int = 6000, threshold: float = 0.5) -> DataFrame:
    """Columns ``keep`` (default: all) plus ``junk_score``, ``toxic_score`` and ``kept``.

    ``labels`` (doc_id, quality 0/1, toxic 0/1) may cover any part of the
    documents. ``train_rows`` bounds the sample that the scorer is fitted on;
    the labellers' accuracies come from the votes of all documents.
    """
    keep = list(docs.columns) if keep is None else keep
    spark = docs.sparkSession
    own = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    votes = map_texts(own, "_text", ["_id"], _VOTE_COLS, _vote).filter("has_words")
    # one row for each pattern of votes: a few hundred, whatever the number of documents
    patterns = _annotated(votes, labels).groupBy("junk_votes", "toxic_votes").agg(F.count(F.lit(1)).alias("n")).toPandas()
    weights = []
    if len(patterns):
        posteriors = {}
        for name, labellers in TARGETS:
            per = patterns.groupby(name)["n"].sum()
            posterior, _ = fit_labellers(unpack_votes(per.index.to_numpy(), labellers), per.to_numpy().astype(float))
            posteriors[name] = dict(zip(per.index.to_numpy().tolist(), posterior.tolist()))
        weights = [spark.sparkContext.broadcast(x) for x in _fit(own, labels, train_rows, posteriors)]
    out = [StructField("junk_score", DoubleType()), StructField("toxic_score", DoubleType()), StructField("kept", BooleanType())]

    def score(view: TextView) -> list[pa.Array]:
        if not weights:
            scores = [np.ones(view.rows), np.zeros(view.rows)]
        else:
            wanted = np.zeros(N_WEIGHTS, bool)
            for known in weights:
                wanted |= known.value[0] != 0
            row, index = features(view, measures(view), wanted)
            scores = []
            for k, known in enumerate(weights):
                w, bias = known.value
                z = bias + np.bincount(row, weights=w[index], minlength=view.rows)
                scores.append(np.where(view.n_words > 0, 1 / (1 + np.exp(-np.clip(z, -40, 40))), 1.0 if k == 0 else 0.0))
        return [pa.array(scores[0]), pa.array(scores[1]), pa.array((scores[0] < threshold) & (scores[1] < threshold))]

    return map_texts(docs, text_col, keep, out, score)


def _fit(own: DataFrame, labels: DataFrame | None, train_rows: int, posteriors: dict) -> list[tuple[np.ndarray, float]]:
    """Weights of both scorers, from samples of at most ``train_rows`` annotated and as many other documents."""
    cols = [*_VOTE_COLS, StructField("features", ArrayType(IntegerType()))]

    def both(view: TextView) -> list[pa.Array]:
        row, index = features(view, measures(view))
        ends = np.cumsum(np.bincount(row, minlength=view.rows))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(index.astype(np.int32)))
        return [*_vote(view), lists]

    def read(df: DataFrame) -> pa.Table:
        return _annotated(map_texts(df, "_text", ["_id"], cols, both).filter("has_words"), labels).drop("_id").limit(train_rows).toArrow()

    parts, fit_for = [], own.filter(F.length("_text") <= TRAIN_CHARS)
    if labels is not None:
        known = labels.select(F.col("doc_id").alias("_id")).filter("_id is not null").distinct().orderBy(F.xxhash64("_id"), "_id").limit(train_rows)
        parts.append(read(fit_for.join(F.broadcast(known), "_id", "left_semi")))  # train_rows ids at most
    if not parts or parts[0].num_rows < ENOUGH:
        parts.append(read(first_by_hash(fit_for, F.col("_text"), train_rows)))
    rows = pa.concat_tables(parts)
    lists = rows["features"].combine_chunks()
    index = lists.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(rows.num_rows, dtype=np.int32), lists.value_lengths().to_numpy(zero_copy_only=False))
    # most features are words met once or twice; they go before anything else is made of them
    often = np.bincount(index, minlength=N_WEIGHTS)[index] >= LEAST_ROWS
    row, index = row[often], index[often]
    found = []
    for name, _ in TARGETS:
        target = np.array([posteriors[name].get(c, 0.0) for c in rows[name].to_pylist()])
        # bad documents, the smaller class, weigh as much as the others, up to eight times each
        weight = np.where(target > 0.5, min(8.0, (target <= 0.5).sum() / max((target > 0.5).sum(), 1)), 1.0)
        found.append(fit_scorer(row, index, target, weight))
    return found
