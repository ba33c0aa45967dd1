"""Language identification as inference of a mixture.

A text's letter trigrams are taken as draws from a mixture of language models. Expectation-maximisation estimates each
text's proportions of the languages from the trigrams' likelihoods; the set of languages is then chosen by penalised
likelihood, since more languages always fit a little better.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import claim, holds, map_rows, pieces, text_or_empty

#: Labelled rows of each language that are wanted for training.
TRAIN_ROWS = 3000
#: Trigrams are counted by a hash of so many values, so a model has this many numbers for each language.
BUCKETS = 1 << 16
#: What one more language has to gain, in nats: a fixed part and a part of each trigram. Neighbouring trigrams overlap, so they aren't three independent draws.
PENALTY, PENALTY_SHARE = 20.0, 0.1

_CHUNK = 1 << 20
_HELD = 64  # languages whose counts a task holds at a time


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Of each code point, is it a letter?"""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


holds("language_id", _letters.cache_clear)


def letters_of(text: str) -> np.ndarray:
    """The text in lower case as code points: its letters, with one blank for each run of other characters and at both ends. Empty without letters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    is_letter = _letters()[codes]
    if not is_letter.any():
        return np.zeros(0, np.uint32)
    codes = np.where(is_letter, codes, np.uint32(32))
    padded = np.concatenate([np.array([32], np.uint32), codes, np.array([32], np.uint32)])
    return padded[np.concatenate([[True], (padded[1:] != 32) | (padded[:-1] != 32)])]


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the text's trigrams and how often each is meant. Long texts are counted in chunks, so their memory is bounded by the number of hashes."""
    c = letters_of(text)
    hashes = lambda c: ((c[:-2] * np.uint32(2654435761)) ^ (c[1:-1] * np.uint32(2246822519)) ^ (c[2:] * np.uint32(3266489917)) * np.uint32(668265263)) >> np.uint32(16)
    if len(c) < 3:
        return np.zeros(0, np.uint32), np.zeros(0, np.float32)
    if len(c) <= BUCKETS:
        h = hashes(c)
        return h, np.ones(len(h), np.float32)
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(c) - 2, _CHUNK):
        counts += np.bincount(hashes(c[at : at + _CHUNK + 2]), minlength=BUCKETS)
    h = np.flatnonzero(counts).astype(np.uint32)
    return h, counts[h].astype(np.float32)


@dataclass(frozen=True)
class Model:
    """languages; chances: for each hash (and one row more) and language, a trigram's probability; seen: of each hash, did training have it?"""

    languages: tuple[str, ...]
    chances: np.ndarray
    seen: np.ndarray


def fit(docs: DataFrame, allowed: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", train_rows: int = TRAIN_ROWS) -> Model:
    """Learns from rows with a language for which `allowed`, a condition on id_col, holds.

    About train_rows rows of each language are drawn by the hash of the id (all, if there are fewer); their whole texts
    are counted on the executors. The driver gets at most BUCKETS numbers for each language, and the model takes 256 KB a
    language; there is no limit to how many there are. Rows with a null language, text or id teach nothing.
    """
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull() & allowed).select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    languages = tuple(sorted(r["lang"] for r in counts.select("lang").collect()))
    share = counts.select("lang", F.least(F.lit(1.0), F.lit(float(train_rows)) / F.col("n")).alias("share"))  # a row for each language, as the model has
    chosen = known.join(F.broadcast(share), "lang").where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 30)) < F.col("share") * (1 << 30))

    def count(batches):
        claim("language_id")
        totals: dict[str, np.ndarray] = {}
        for batch in (x for b in batches for x in pieces(b, 1 << 20)):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if lang not in totals and len(totals) == _HELD:
                    yield from map(_counts, totals.items())
                    totals = {}
                h, n = trigrams(text)
                totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
                np.add.at(totals[lang], h, n.astype(np.int64))
        yield from map(_counts, totals.items())

    table = np.zeros((BUCKETS, len(languages)), np.float32)
    found = chosen.select("lang", "text").mapInArrow(count, "lang string, hash int, n long").groupBy("lang", "hash").agg(F.sum("n").alias("n")).toArrow()
    column = {x: i for i, x in enumerate(languages)}
    for part in found.to_batches(max_chunksize=1 << 16):
        table[part.column(1).to_numpy(), [column[x] for x in part.column(0).to_pylist()]] = part.column(2).to_numpy()
    seen, sums = table.any(axis=1), table.sum(0, dtype=np.float64)
    table += np.float32(0.1)
    table /= (sums + 0.1 * BUCKETS).astype(np.float32)
    return Model(languages, table, seen)


def _counts(item: tuple[str, np.ndarray]) -> pa.RecordBatch:
    lang, n = item
    h = np.flatnonzero(n)
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(h), pa.string()), pa.array(h, pa.int32()), pa.array(n[h], pa.int64())], names=["lang", "hash", "n"])


def mixtures(chances: np.ndarray, counts: np.ndarray, sizes: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of every text. chances: of each trigram under each language, text after text; sizes: trigrams of each text, none 0.

    A text whose proportions move by less than 0.002 in two rounds is done, and takes no part in later rounds.
    """
    texts, languages = len(sizes), chances.shape[1]
    weights = np.full((texts, languages), 1 / languages, np.float32)
    likelihood = np.zeros(texts)
    active = np.arange(texts)
    for i in range(rounds):
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        share = chances * np.repeat(weights[active], sizes, axis=0)
        total = share.sum(1)
        share *= (counts / total)[:, None]
        new = np.add.reduceat(share, starts, axis=0)
        new /= new.sum(1, keepdims=True)
        likelihood[active] = np.add.reduceat(np.log(total) * counts, starts)
        moved = np.abs(new - weights[active]).max(1) >= 0.001
        weights[active] = new
        if not moved.any():
            break
        if i % 2 and not moved.all():
            which = np.repeat(moved, sizes)
            chances, counts, sizes, active = chances[which], counts[which], sizes[moved], active[moved]
    return weights, likelihood


def choose(chances: np.ndarray, counts: np.ndarray, weights: np.ndarray, whole: float) -> list[int]:
    """The set of languages of one text: more are added, by falling proportion, as long as the likelihood gains more than the penalty. whole: that of all languages together, which no set exceeds."""
    alone = (np.log(chances) * counts[:, None]).sum(0)
    best = [int(alone.argmax())]
    now, cost = float(alone.max()), PENALTY + PENALTY_SHARE * float(counts.sum())
    for k in np.argsort(-weights, kind="stable").tolist():
        if whole - now <= cost or k in best:
            continue
        _, gain = mixtures(chances[:, [*best, k]], counts, np.array([len(counts)]))
        if gain[0] - now > cost:
            best, now = [*best, k], float(gain[0])
    return best


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The languages of every whole text.

    Returns id_col, the columns in `keep`, `lang_pred` string: the language with the largest proportion in the chosen
    set, `score` double: its proportion among all languages, `languages` array<string>: the chosen set, `known` double:
    the share of trigrams that training has seen in any language. A null text, one without letters, and every text
    where the model has no language, is `und` with score 0, no languages and known 0. Of equal proportions the first
    language in the order of strings wins. Repeated rows are judged each. No shuffle. An empty table gives an empty
    table. A column in `keep` that has the name of a result is left out.
    """
    keep = tuple(c for c in keep if c not in (id_col, "lang_pred", "score", "languages", "known"))
    kept = docs.select(F.col(id_col), text_or_empty(text_col).alias("__text"), *[F.col(c) for c in keep])
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.chances, model.seen))  # 256 KB a language

    def rows(batch: pa.RecordBatch) -> list[pa.Array]:
        languages, table, seen = shared.value
        n = batch.num_rows
        pred, score, sets, known = ["und"] * n, np.zeros(n), [[] for _ in range(n)], np.zeros(n)
        found = [(i, *trigrams(x)) for i, x in enumerate(batch.column(1).to_pylist())]
        found = [x for x in found if len(x[1])] if languages else []
        if found:
            hashes, counts, sizes = np.concatenate([x[1] for x in found]), np.concatenate([x[2] for x in found]), np.array([len(x[1]) for x in found])
            chances = table[hashes]
            weights, likelihood = mixtures(chances, counts, sizes)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            alone = np.add.reduceat(np.log(chances) * counts[:, None], starts, axis=0)
            total = np.add.reduceat(counts, starts)
            new = np.add.reduceat(seen[hashes] * counts, starts) / total
            for j, (i, *_rest) in enumerate(found):
                chosen = [int(alone[j].argmax())]
                if likelihood[j] - alone[j].max() > PENALTY + PENALTY_SHARE * total[j]:
                    span = slice(starts[j], starts[j] + sizes[j])
                    chosen = choose(chances[span], counts[span], weights[j], float(likelihood[j]))
                top = max(sorted(chosen), key=lambda k: weights[j, k])
                pred[i], score[i], sets[i], known[i] = languages[top], float(weights[j, top]), [languages[k] for k in chosen], float(new[j])
        return [batch.column(0), *batch.columns[2:], pa.array(pred, pa.string()), pa.array(score.clip(0, 1)), pa.array(sets, pa.list_(pa.string())), pa.array(known)]

    names = [id_col, *keep, "lang_pred", "score", "languages", "known"]
    schema = docs.select(F.col(id_col), *[F.col(c) for c in keep], F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.array().cast("array<string>").alias("languages"), F.lit(0.0).alias("known")).schema
    most = max(1 << 12, (2 << 20) // max(4, len(model.languages)))  # a trigram takes some numbers for each language
    return map_rows(kept, rows, schema, names, most_bytes=most, owner="language_id")
