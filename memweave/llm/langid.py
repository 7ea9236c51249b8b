"""Language identification by a byte convolutional network.

Texts are cut into consecutive windows of ``WINDOW`` bytes that cover the
whole text. The network embeds the (folded) bytes, applies filters of 2, 3 and
4 bytes, keeps each filter's maximum over the window, and ends in a softmax
over the languages seen in training. A text's probabilities are the mean over
its windows, weighted by their bytes. Training (Adam, plain NumPy) runs on a
bounded sample of labelled rows: the first ``train_rows`` by a hash of the id,
with at most ``WINDOWS_PER_ROW`` windows spread evenly over each text.

For prediction the filters become two tables over byte pairs, so a position
costs two row look-ups and an addition.

Edge cases: a null text and a text without any letter is ``und`` with score 0;
so is every text if there is nothing to learn from. Rows without a language
are never learned from. Equal texts get equal results; other columns pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, StringType, StructField

from memweave.llm.sampling import first_by_hash
from memweave.llm.textview import TextView, map_texts

WINDOW, WINDOWS_PER_ROW = 256, 6
EMBED, FILTERS, WIDTHS = 6, 12, (2, 3, 4)
REACH = max(WIDTHS)
OUT = FILTERS * len(WIDTHS)

#: Bytes as the network sees them: A-Z lowered, digits alike, ASCII punctuation and white space alike; 0 pads.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[:128] = 32
FOLD[48:58] = 48
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)


def cut(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the windows of every row; an empty row has none."""
    n = -(-np.diff(offs) // WINDOW)
    row = np.repeat(np.arange(len(n)), n)
    start = offs[row] + (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * WINDOW
    return row, start, np.minimum(start + WINDOW, offs[row + 1])


def grid(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Folded windows as rows of WINDOW bytes, padded with 0."""
    if not len(start):
        return np.zeros((0, WINDOW), np.uint8)
    at = start[:, None] + np.arange(WINDOW)
    return np.where(at < end[:, None], FOLD[data[np.minimum(at, len(data) - 1)]], np.uint8(0))


def letters(view: TextView) -> np.ndarray:
    """Rows with at least one letter of any script."""
    fold = FOLD[view.data]
    ascii_letter = view.total((fold >= 97) & (fold <= 122)) > 0
    for r in np.flatnonzero(~ascii_letter & (view.total(view.data >= 0x80) > 0)):
        text = view.data[view.offs[r]:view.offs[r + 1]].tobytes().decode("utf-8", "replace")
        ascii_letter[r] = any(c.isalpha() for c in text)
    return ascii_letter


def _patches(x: np.ndarray, emb: np.ndarray) -> np.ndarray:
    """(windows, positions, REACH * EMBED) embedded byte runs."""
    e = emb[x]
    return np.concatenate([e[:, k:WINDOW - REACH + 1 + k] for k in range(REACH)], axis=2)


def _mask() -> np.ndarray:
    """1 where a filter of its width reaches, for the (REACH * EMBED, OUT) filter matrix."""
    out = np.zeros((REACH * EMBED, OUT), np.float32)
    for k, w in enumerate(WIDTHS):
        out[:w * EMBED, k * FILTERS:(k + 1) * FILTERS] = 1
    return out


def train(x: np.ndarray, y: np.ndarray, classes: int, *, epochs: int = 10, batch: int = 64, rate: float = 0.01, seed: int = 7) -> dict:
    """Parameters of the network fitted to windows ``x`` with class numbers ``y``."""
    rng = np.random.default_rng(seed)
    mask = _mask()
    p = {"emb": rng.normal(0, 0.5, (256, EMBED)), "conv": rng.normal(0, 0.3, (REACH * EMBED, OUT)) * mask, "bias": np.zeros(OUT),
         "top": rng.normal(0, 0.2, (OUT, classes)), "last": np.zeros(classes)}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    first, second, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    share = np.maximum(np.bincount(y, minlength=classes), 1) / len(y)
    weight = (1 / (classes * share))[y].astype(np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), batch):
            pick = order[lo:lo + batch]
            xb, n = x[pick], len(pick)
            patch = _patches(xb, p["emb"])
            conv = patch @ p["conv"]
            best = conv.argmax(1)  # window, filter -> position
            lane = np.arange(n)[:, None]
            peak = conv[lane, best, np.arange(OUT)] + p["bias"]
            hidden = np.maximum(peak, 0)
            z = hidden @ p["top"] + p["last"]
            z = np.exp(z - z.max(1, keepdims=True))
            error = z / z.sum(1, keepdims=True)
            error[np.arange(n), y[pick]] -= 1
            error *= (weight[pick] / n)[:, None]
            back = (error @ p["top"].T) * (peak > 0)
            grad = {"top": hidden.T @ error, "last": error.sum(0), "bias": back.sum(0)}
            at_peak = patch[lane, best]  # window, filter, patch
            grad["conv"] = np.einsum("nf,nfp->pf", back, at_peak) * mask
            emb = np.zeros_like(p["emb"])
            for k in range(REACH):
                part = p["conv"][k * EMBED:(k + 1) * EMBED].T  # filter, embed
                np.add.at(emb, xb[lane, best + k], back[:, :, None] * part)
            grad["emb"] = emb
            step += 1
            for key, g in grad.items():
                first[key] = 0.9 * first[key] + 0.1 * g
                second[key] = 0.999 * second[key] + 0.001 * g * g
                p[key] -= rate * (first[key] / (1 - 0.9 ** step)) / (np.sqrt(second[key] / (1 - 0.999 ** step)) + 1e-8)
    return p


def pair_tables(p: dict) -> list[np.ndarray]:
    """Filter responses of every byte pair at offsets 0-1 and at offsets 2-3."""
    single = [p["emb"] @ p["conv"][k * EMBED:(k + 1) * EMBED] for k in range(REACH)]
    return [(single[k][:, None] + single[k + 1][None]).reshape(65536, OUT).astype(np.float32) for k in (0, 2)]


def probabilities(p: dict, tables: list[np.ndarray], x: np.ndarray, block: int = 64) -> np.ndarray:
    """Softmax of every window."""
    out = np.empty((len(x), len(p["last"])))
    for lo in range(0, len(x), block):
        part = x[lo:lo + block].astype(np.uint16)
        pair = part[:, :-1] << np.uint16(8) | part[:, 1:]
        conv = tables[0].take(pair[:, :WINDOW - REACH + 1], axis=0)
        conv += tables[1].take(pair[:, 2:WINDOW - REACH + 3], axis=0)
        z = np.maximum(conv.max(1) + p["bias"], 0) @ p["top"] + p["last"]
        z = np.exp(z - z.max(1, keepdims=True))
        out[lo:lo + block] = z / z.sum(1, keepdims=True)
    return out


def learn(rows: DataFrame, train_rows: int) -> tuple[list[str], dict] | None:
    """(languages, parameters) from rows (id, lang, _text); None if there is nothing to learn from."""
    sample = first_by_hash(rows.filter("lang is not null and _text is not null"), F.col("id"), train_rows)

    def spread(view: TextView) -> list[pa.Array]:
        row, start, end = cut(view.data, view.offs)
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        total = np.bincount(row, minlength=view.rows)[row]
        pick = np.flatnonzero((nth * WINDOWS_PER_ROW // np.maximum(total, 1)) != ((nth - 1) * WINDOWS_PER_ROW // np.maximum(total, 1)))
        ok = letters(view)
        pick = pick[ok[row[pick]]]
        lists = [[] for _ in range(view.rows)]
        for r, w in zip(row[pick], grid(view.data, start[pick], end[pick])):
            lists[r].append(w.tobytes())
        return [pa.array(lists, pa.list_(pa.binary()))]

    got = map_texts(sample, "_text", ["lang"], [StructField("windows", ArrayType(BinaryType()))], spread).limit(train_rows).toPandas()
    pairs = [(lang, bytes(w)) for lang, ws in zip(got["lang"], got["windows"]) for w in ws]
    if not pairs:
        return None
    pairs.sort()  # the order of the tasks must not matter
    names = sorted({lang for lang, _ in pairs})
    number = {n: k for k, n in enumerate(names)}
    x = np.frombuffer(b"".join(w for _, w in pairs), np.uint8).reshape(-1, WINDOW)
    return names, train(x, np.array([number[lang] for lang, _ in pairs]), len(names))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", lang_col: str = "lang", keep: list[str] | None = None, *,
             train_rows: int = 2500, train_filter: Column | None = None) -> DataFrame:
    """Columns ``keep`` (default: all) plus ``lang_pred`` and ``score``. ``train_filter`` limits the rows to learn from."""
    keep = list(docs.columns) if keep is None else keep
    labelled = docs if train_filter is None else docs.filter(train_filter)
    known = learn(labelled.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("_text")), train_rows)
    model = docs.sparkSession.sparkContext.broadcast(known)
    cache: dict = {}

    def predict(view: TextView) -> list[pa.Array]:
        has = letters(view)
        if model.value is None:
            return [pa.array(["und"] * view.rows, pa.string()), pa.array(np.zeros(view.rows))]
        names, p = model.value
        if "tables" not in cache:
            cache["tables"] = pair_tables(p)
        row, start, end = cut(view.data, view.offs)
        used = has[row]
        row, start, end = row[used], start[used], end[used]
        total = np.zeros((view.rows, len(names)))
        for lo in range(0, len(row), 1024):
            part = slice(lo, lo + 1024)
            probability = probabilities(p, cache["tables"], grid(view.data, start[part], end[part]))
            np.add.at(total, row[part], probability * (end[part] - start[part])[:, None])
        total /= np.maximum(total.sum(1, keepdims=True), 1e-12)
        best = total.argmax(1)
        return [pa.array([names[k] if ok else "und" for k, ok in zip(best, has)], pa.string()),
                pa.array(np.where(has, np.minimum(total[np.arange(view.rows), best], 1.0), 0.0))]

    return map_texts(docs, text_col, keep, [StructField("lang_pred", StringType()), StructField("score", DoubleType())], predict)
