"""Toxicity by compression distance: two zstandard dictionaries, one of toxic and one of ordinary text.

Each text is cut into short windows of whole words. A window is compressed with the ordinary dictionary, and again with
the toxic one before it; the bytes that the toxic one saves are the window's evidence. What a text scores is read off a
curve over counts of windows that reach certain savings. It was calibrated on labelled texts which the dictionaries
haven't seen.

Both dictionaries come from zstandard's trainer. The ordinary one is trained on all windows of ordinary texts. Nearly all
of a toxic text is ordinary too, so the trainer gets of a toxic text only what is found, by compression, to be of use:
windows that are shorter with a first dictionary trained on the windows of other toxic texts, cut to the words without
which less is saved. Such a word has to come up in several toxic texts, and far more often than in ordinary ones
that are searched in the same way.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .near_dup import shingles
from .shared import holds, map_rows, text_or_empty

#: Labelled rows of each class that are wanted for training, and the longest text (in bytes) among them.
TRAIN_ROWS, TRAIN_BYTES = 3000, 8_192
#: Bytes of the ordinary dictionary, the first toxic one and the toxic one; and of a window.
ORDINARY, FIRST, TOXIC = 1 << 16, 1 << 14, 1 << 13
WINDOW = 64
#: Bytes that a first dictionary has to save on a window; toxic texts in which a word has to come up, and how many times as often as in ordinary ones.
LEAST_SAVED, LEAST_TEXTS, LEAST_RATIO = 3, 3, 10
#: For windows of a few bytes: matches from six bytes on, so that they are of whole words rather than of syllables, and all of both dictionaries within reach.
PARAMETERS = {"window_log": 18, "hash_log": 17, "chain_log": 17, "search_log": 5, "min_match": 6, "target_length": 16, "strategy": zstandard.STRATEGY_LAZY2, "write_content_size": False, "write_dict_id": False}

_word = re.compile(r"[^\W_]+")


def windows(text: str) -> list[bytes]:
    """The words of the text in lower case, in windows of about WINDOW bytes; a longer word is a window by itself. Every word is in one window."""
    out, line, size = [], [], 0
    for word in _word.findall(text.lower()):
        if size and size + len(word) > WINDOW:
            out.append(f" {' '.join(line)} ".encode("utf-8", "replace"))
            line, size = [], 0
        line.append(word)
        size += len(word) + 1
    return [*out, f" {' '.join(line)} ".encode("utf-8", "replace")] if line else out


@dataclass(frozen=True)
class Model:
    """ordinary, toxic: the dictionaries; weights: of the curve."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]


@lru_cache(maxsize=8)
def _squeeze(dictionary: bytes):
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=zstandard.ZstdCompressionParameters(**PARAMETERS)).compress


holds("toxicity", _squeeze.cache_clear)


def saved(ordinary: bytes, toxic: bytes, parts: list[bytes]) -> np.ndarray:
    """For each window, the bytes that the toxic dictionary saves."""
    one, both = _squeeze(ordinary), _squeeze(ordinary + toxic)  # the end of a dictionary is the cheapest to refer to
    return np.array([len(one(x)) - len(both(x)) for x in parts], np.float64)


def trained(parts: list[bytes], size: int, segment: int) -> bytes:
    """The dictionary that zstandard's trainer makes of the windows."""
    try:
        return zstandard.train_dictionary(size, parts, k=segment, d=8, steps=1, split_point=1.0, level=3).as_bytes()
    except zstandard.ZstdError:  # too little to choose from: all of it
        return b"".join(parts)[-size:]


def _sources(ordinary: bytes, toxic: bytes, part: bytes, saving: float) -> list[bytes]:
    """The words of a window without which the toxic dictionary saves clearly less."""
    words = part.split()
    if len(words) == 1:
        return [part]
    rest = saved(ordinary, toxic, [b" " + b" ".join(words[:i] + words[i + 1 :]) + b" " for i in range(len(words))])
    return [b" " + w + b" " for w, left in zip(words, rest.tolist(), strict=True) if saving - left >= 3]


def dictionaries(rows: list[tuple[list[bytes], int]]) -> tuple[bytes, bytes, list[bytes]]:
    """The ordinary and the toxic dictionary of rows (windows, label), and the parts of toxic texts that the latter is trained on."""
    split = [[w for w, label in rows if label == wanted] for wanted in (0, 1)]
    ordinary = trained([x for w in split[0] for x in w], ORDINARY, 24)
    firsts = [trained([x for i, w in enumerate(split[1]) if i % 3 != third for x in w], FIRST, 24) for third in range(3)]
    texts = [Counter(), Counter()]
    for label in (0, 1):
        for i, parts in enumerate(split[label]):
            first = firsts[i % 3]
            savings = saved(ordinary, first, parts).tolist()
            texts[label].update({x for part, saving in zip(parts, savings, strict=True) if saving >= LEAST_SAVED for x in _sources(ordinary, first, part, saving)})
    often = LEAST_RATIO * len(split[1]) / max(1, len(split[0]))
    chosen = sorted(x for x, n in texts[1].items() if n >= LEAST_TEXTS and n > often * texts[0][x])
    return ordinary, trained(chosen, TOXIC, 64) if chosen else b"", chosen


#: Bytes saved on a window from which on it counts; the curve weighs the counts.
THRESHOLDS = (1, 2, 3, 4, 6)


def features(gain: np.ndarray) -> list[float]:
    """Of the bytes that the toxic dictionary saves on each window of a text: the most, and how many windows reach each threshold, beside how many there are."""
    counts = (gain[:, None] >= np.array(THRESHOLDS)).sum(0) if len(gain) else np.zeros(len(THRESHOLDS))
    return [float(gain.max(initial=0)), *np.log1p(counts).tolist(), float(np.log1p(len(gain)))]


def distinct(rows: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """The rows without near copies of the same label, so that what one text says doesn't look like evidence of many. Two texts are near copies if four fifths of their five-word shingles are common; candidates share one of their sixteen least hashes."""
    kept, by_hash = [], {}
    for text, label in sorted(set(rows)):
        h = np.unique(shingles(text))
        least = [(label, x) for x in h[:16].tolist()]
        others = {k for x in least for k in by_hash.get(x, ())}
        if any(4 * (len(h) + len(o)) <= 9 * len(np.intersect1d(h, o, assume_unique=True)) for o in (kept[k][2] for k in sorted(others))):
            continue
        for x in least:
            by_hash.setdefault(x, []).append(len(kept))
        kept.append((text, label, h))
    return [(text, label) for text, label, _ in kept]


def train(rows: list[tuple[str, int]], prior: float | None = None) -> Model:
    """rows: texts and labels. Each third of them is measured by dictionaries of the other two, for the curve; the dictionaries of the model are made of all rows. Of near copies one counts. Without rows of both classes the score is the share of toxic rows. prior: the share of toxic texts where the model is used, if the rows have another one."""
    rows = distinct(rows)
    texts = [(windows(t), y) for t, y in rows]
    share = sum(y for _, y in rows) / len(rows) if rows else 0.0
    parts = [[x for i, x in enumerate(texts) if i % 3 != third] for third in range(3)]
    if any(len({y for _, y in part}) < 2 for part in parts):
        return Model(b"", b"", (float(np.log((share + 1e-3) / (1 - share + 1e-3))),))
    known, labels = [], []
    for third, part in enumerate(parts):
        ordinary, toxic, _ = dictionaries(part)
        for w, y in texts[third::3]:
            known.append(features(saved(ordinary, toxic, w)))
            labels.append(y)
    weights = _curve(np.array(known), np.array(labels, float))
    if prior and 0 < prior < 1:
        weights = (weights[0] + float(np.log(prior / (1 - prior)) - np.log(share / (1 - share))), *weights[1:])
    ordinary, toxic, _ = dictionaries(texts)
    return Model(ordinary, toxic, weights)


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton's method, lightly held back; weights refer to the features as they are."""
    if not len(x):
        return (0.0,)
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w, hold = np.zeros(z.shape[1]), np.diag([1e-6, *[0.05] * x.shape[1]]) * 1.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        move = np.linalg.solve(z.T @ (z * (p * (1 - p) + 1e-6)[:, None]) + hold, z.T @ (y - p) - hold @ w)
        w += move
        if np.abs(move).max() < 1e-8:
            break
    return (float(w[0] - (w[1:] * mean / scale).sum()), *map(float, w[1:] / scale))


def _logistic(weights: tuple[float, ...], gain: np.ndarray) -> float:
    x = [1.0, *features(gain)] if len(weights) > 1 else [1.0]
    return float(1 / (1 + np.exp(-np.clip(np.dot(weights, x), -30, 30))))


def score(model: Model, text: str) -> float:
    return _logistic(model.weights, saved(model.ordinary, model.toxic, windows(text)) if len(model.weights) > 1 else np.zeros(0))


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_rows: int = TRAIN_ROWS, train_bytes: int = TRAIN_BYTES) -> Model:
    """Learns from labelled documents for which `allowed`, a condition on id_col, holds.

    About train_rows labelled ids of each class are drawn by the hash of the id, and those whose text has at most
    train_bytes bytes are used, so the driver gets 2 * train_rows * train_bytes bytes at the very most. Null labels and
    null texts are left out; an id with several labels is toxic if any of them says so; of several texts of an id, the
    first in the order of strings is used. The share of toxic labels is counted over all labels.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & allowed).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).where("toxic IN (0, 1)").collect()}
    keep = F.lit(False)
    for label, n in counts.items():
        keep = keep | ((F.col("toxic") == label) & (F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, train_rows / n))))
    chosen = known.where(keep).groupBy("id").agg(F.max("toxic").alias("toxic"))  # about 2 * train_rows small rows, whatever the table's size
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(F.octet_length("text") <= train_bytes)
    rows = texts.join(F.broadcast(chosen), "id").groupBy("id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic").toArrow()
    total = sum(counts.values())
    return train(list(zip(rows["text"].to_pylist(), rows["toxic"].to_pylist(), strict=True)), counts.get(1, 0) / total if total else None)


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Scores every whole text. Returns id_col, the columns in `keep`, `score` double from 0 to 1 and `windows` int: how many windows save bytes with the toxic dictionary from the middle threshold on.

    A null text counts as empty; a text without words scores what the curve says of no windows. Rows that repeat are
    scored each. No shuffle. An empty table gives an empty table. A column in `keep` that has the name of a result is
    left out.
    """
    keep = tuple(c for c in keep if c not in (id_col, "score", "windows"))
    kept = docs.select(F.col(id_col), text_or_empty(text_col).alias("__text"), *[F.col(c) for c in keep])
    middle = THRESHOLDS[len(THRESHOLDS) // 2]

    def rows(batch: pa.RecordBatch) -> list[pa.Array]:
        scores, hits = [], []
        for text in batch.column(1).to_pylist():
            gain = saved(model.ordinary, model.toxic, windows(text)) if len(model.weights) > 1 else np.zeros(0)
            scores.append(_logistic(model.weights, gain))
            hits.append(int((gain >= middle).sum()))
        return [batch.column(0), *batch.columns[2:], pa.array(scores, pa.float64()), pa.array(hits, pa.int32())]

    names = [id_col, *keep, "score", "windows"]
    schema = docs.select(F.col(id_col), *[F.col(c) for c in keep], F.lit(0.0).alias("score"), F.lit(0).alias("windows")).schema
    return map_rows(kept, rows, schema, names, owner="toxicity")
