"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

1. Document frequencies of five-word shingles are counted over all documents, in a table of fixed size: a shingle's
   count is that of its cell. What cells share is about a thousandth of the documents, at any size of the corpus, so
   shingles that are more frequent than that stand out and all others count as rare.
2. Every text is sampled. A sample names one shingle and a level of its weight, and two texts have it in common with the
   probability of their weighted Jaccard similarity. Four samples make a band.
3. Texts that share a band are neighbours: sorted by band, each is paired with the first and with the previous one of its
   band. Pairs grow in proportion to the texts, however large a band is.
4. Pairs are verified by their exact weighted Jaccard similarity, and connected components of those that pass are the
   classes. Copies of a text go through all this once.
5. A band whose texts aren't in one class by then is open. All its pairs of texts in two classes are verified too, within
   tasks: a band's texts are dealt to blocks, every two blocks that can hold a pair meet in one task, and what leaves it
   are links between classes. So texts of a similarity of THRESHOLD that share a band are always in one class.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import components
from .shared import claim, cut, heavy_keys, holds, join_spread, map_rows, pieces, text_or_empty, written

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 16, 4
CELL_BITS = 19
CELLS = 1 << CELL_BITS
#: A shingle's weight lies between LEAST_WEIGHT (in every document) and 1 (in almost none). Were frequent ones worth next to nothing, a large group of copies would look less alike than a small one with the same edits.
LEAST_WEIGHT = 0.75

#: Texts, and bytes of elements, that a block of an open band holds, about.
TEXTS, TEXT_BYTES = 256, 2 << 20
#: Columns of the matrix by which a task compares many texts at once.
COLUMNS = 512

_BLOCK = 1 << 14
_FAN = 64
_TABLE = 1 << 15
def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


_CHUNK = 1 << 20
_space = re.compile(r"\s")


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Of each code point: 2 for letters and numbers, 1 for white space, 0 for marks."""
    return np.fromiter((2 * chr(c).isalnum() + chr(c).isspace() for c in range(0x110000)), np.uint8, 0x110000)


@lru_cache(maxsize=1)
def _powers() -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(1 << 16, 0x9E3779B97F4A7C15, np.uint64))


def _words(text: str) -> np.ndarray:
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    kind = _kinds()[codes]
    kept = np.flatnonzero(kind == 2)
    if not len(kept):
        return np.zeros(0, np.uint64)
    word = np.cumsum(kind == 1, dtype=np.int32)[kept]
    starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    place = np.arange(len(kept)) - np.repeat(starts, np.diff(np.append(starts, len(kept))))
    letters = codes[kept].astype(np.uint64) + np.uint64(1)
    letters *= np.uint64(0xD6E8FEB86659FD93)
    letters ^= letters >> np.uint64(32)
    letters *= _powers()[place & 0xFFFF]
    return _mix(np.add.reduceat(letters, starts))


def words(text: str) -> np.ndarray:
    """A 64-bit hash for each word: what is between white space, without case and marks; what is marks only is none. Long texts go chunk by chunk."""
    if len(text) <= _CHUNK:
        return _words(text)
    out, at = [], 0
    while at < len(text):
        end = m.start() if (m := _space.search(text, at + _CHUNK)) else len(text)
        out.append(_words(text[at:end]))
        at = end
    return np.concatenate(out)


def shingles(text: str) -> np.ndarray:
    """A 64-bit hash for each shingle of WORDS words in order; a shorter text is one shingle, one without words has none. Case and marks don't count."""
    w = words(text)
    n = min(len(w), WORDS)
    if not n:
        return w
    out = np.zeros(len(w) - n + 1, np.uint64)
    for i in range(n):
        out = _mix(out + w[i : len(w) - n + 1 + i])
    return out


def elements(text: str) -> np.ndarray:
    """The text's shingles as a sorted set of 32-bit numbers: the cell of each, and bits of the shingle and of its occurrence, so that one that stands there twice is two elements."""
    h = np.sort(shingles(text))
    if not len(h):
        return np.zeros(0, np.uint32)
    first = np.concatenate([[True], h[1:] != h[:-1]])
    start = np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))
    nth = (np.arange(len(h)) - start).astype(np.uint64)
    return np.unique(((h & np.uint64(CELLS - 1)) | (_mix(h + nth) >> np.uint64(32 + CELL_BITS) << np.uint64(CELL_BITS))).astype(np.uint32))


def similarity(a: np.ndarray, b: np.ndarray, weights: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sets of elements: sums of term frequency times weight, least over most."""
    both = np.intersect1d(a, b, assume_unique=True)
    cell = np.uint32(CELLS - 1)
    common = float(weights[both & cell].sum(dtype=np.float64))
    total = float(weights[a & cell].sum(dtype=np.float64)) + float(weights[b & cell].sum(dtype=np.float64)) - common
    return common / total if total else 1.0


@lru_cache(maxsize=1)
def _random_tables(samples: int, seed: int) -> tuple[np.ndarray, ...]:
    """r, 1 / r, c and beta, made once for each worker (32 MB)."""
    rng = np.random.default_rng(seed)
    r = rng.gamma(2, 1, (_TABLE, samples)).astype(np.float32)
    c = (np.log(rng.gamma(2, 1, (_TABLE, samples))) - r).astype(np.float32)
    return r, 1 / r, c, rng.random((_TABLE, samples), np.float32)


def _release() -> None:
    for x in (_kinds, _powers, _random_tables):
        x.cache_clear()


holds("near_dup", _release)


class Sampler:
    """Consistent weighted samples. The random numbers of a shingle are a row of a table that its hash picks."""

    def __init__(self, weights: np.ndarray, samples: int = BANDS * ROWS, seed: int = 5):
        self.weights, self.tables = weights, _random_tables(samples, seed)

    def samples(self, text: str) -> np.ndarray | None:
        """One 64-bit number for each sample: the shingle with the least draw, and its level. None for a text without words."""
        h, tf = np.unique(shingles(text), return_counts=True)
        if not len(h):
            return None
        r, parts, c, beta = self.tables
        log = np.log(tf * self.weights[h & np.uint64(CELLS - 1)]).astype(np.float32)[:, None]
        rows = (h >> np.uint64(40)).astype(np.int64) & (_TABLE - 1)
        best = level = which = None
        for at in range(0, len(h), 512):
            row = rows[at : at + 512]
            b = beta[row]
            t = parts[row]
            t *= log[at : at + 512]
            t += b
            np.floor(t, out=t)
            b -= t
            b *= r[row]
            b += c[row]  # the draw: c - r (t - beta)
            least = b.argmin(0)
            column = np.arange(b.shape[1])
            found = b[least, column], t[least, column], h[at : at + 512][least]
            if best is None:
                best, level, which = found
            else:
                better = found[0] < best
                best, level, which = (np.where(better, x, y) for x, y in zip(found, (best, level, which), strict=True))
        return _mix(which + _mix(level.astype(np.int64).astype(np.uint64)))

    def bands(self, text: str) -> list[int] | None:
        s = self.samples(text)
        if s is None:
            return None
        s, out = s.reshape(BANDS, ROWS), np.arange(BANDS, dtype=np.uint64)
        for i in range(ROWS):
            out = _mix(out + s[:, i])
        return out.view(np.int64).tolist()


def weights_of(counts: np.ndarray, documents: int) -> np.ndarray:
    """Each cell's weight from its document frequency."""
    idf = np.log((documents + 1) / (np.minimum(counts, documents) + 1)) / np.log(documents + 2)
    return (LEAST_WEIGHT + (1 - LEAST_WEIGHT) * idf).astype(np.float32)


def frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """How many documents (`text`) each cell's shingles are in, and how many documents there are.

    Every task counts into a table of its own. Tables are added up in blocks of cells, at most _FAN tables at a time, so
    no task's memory depends on the number of tasks; the driver gets one table.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        claim("near_dup")
        table, n = np.zeros(CELLS, np.int64), 0
        for batch in (x for b in batches for x in pieces(b, 2 << 20)):
            for text in batch.column(0).to_pylist():
                table[np.unique(shingles(text) & np.uint64(CELLS - 1)).astype(np.int64)] += 1
                n += 1
        part = TaskContext.get().partitionId()
        blocks = [zlib.compress(table[at : at + _BLOCK].tobytes(), 1) for at in range(0, CELLS, _BLOCK)] if n else []
        yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array([part] * len(blocks), pa.int32()), pa.array([n] * len(blocks), pa.int64()), pa.array(blocks, pa.binary())], names=["block", "part", "n", "counts"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(x), np.int64) for x in group["counts"])
        return pd.DataFrame({"block": group["block"].iloc[:1], "part": group["part"].iloc[:1] // _FAN, "n": [int(group["n"].sum())], "counts": [zlib.compress(total.tobytes(), 1)]})

    schema, parts = "block int, part int, n long, counts binary", docs.rdd.getNumPartitions()
    found = docs.mapInArrow(count, schema)
    while True:
        found = found.groupBy("block", F.expr(f"part div {_FAN}")).applyInPandas(add, schema)
        parts = -(-parts // _FAN)
        if parts <= 1:
            break
    table, n = np.zeros(CELLS, np.int64), 0
    for r in found.collect():  # one row for each of CELLS / _BLOCK blocks
        table[r["block"] * _BLOCK : (r["block"] + 1) * _BLOCK] += np.frombuffer(zlib.decompress(r["counts"]), np.int64)
        n += r["n"] * (r["block"] == 0)
    return table, n


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (band, node): pairs with the first and the previous row of the band; and the first rows of this task's first and last band, which may go on in other tasks."""
    band = first = last = None
    emit = lambda a, b, k: pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(k, pa.int64())], names=["a", "b", "band"])
    for batch in batches:
        k, v = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        if not len(k):
            continue
        if band is None:
            yield emit(v[:1], [None], k[:1])
            band, first, last = k[0] - 1 if k[0] > -(1 << 62) else k[0] + 1, v[0], v[0]
        new = np.concatenate([[k[0] != band], k[1:] != k[:-1]])
        start = np.maximum.accumulate(np.where(new, np.arange(len(k)), -1))
        head = np.where(start >= 0, v[start], first)
        before = np.concatenate([[last], v[:-1]])
        a = np.concatenate([head[~new], before[~new]])
        b = np.concatenate([v[~new], v[~new]])
        distinct = np.unique(np.column_stack([a, b])[a != b], axis=0)
        yield emit(distinct[:, 0], distinct[:, 1], [None] * len(distinct))
        band, first, last = k[-1], head[-1], v[-1]
    if band is not None:
        yield emit([first], [None], [band])


def text_key(column: str) -> Column:
    """What stands for a text in joins."""
    return F.md5(text_or_empty(column).cast("binary"))


def _first(own: list[list[int]], band: int) -> np.ndarray:
    """For every two texts, given by their open bands: is `band` the least one that they share? All of them have it."""
    owner = np.repeat(np.arange(len(own)), [len(x) for x in own])
    bands = np.fromiter((x for one in own for x in one), np.int64, len(owner))
    values, column, count = np.unique(bands, return_inverse=True, return_counts=True)
    kept = (count > 1) & (values < band)
    place = np.cumsum(kept) - 1
    owner, column = owner[kept[column]], place[column[kept[column]]]
    out = np.ones((len(own), len(own)), bool)
    for at in range(0, int(kept.sum()), COLUMNS):
        here = (column >= at) & (column < at + COLUMNS)
        held = np.zeros((len(own), COLUMNS), np.float32)
        held[owner[here], column[here] - at] = 1
        out &= held @ held.T == 0
    return out


def _common(sets: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """For every two sets of elements the weight of what they have in common."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    kept = count > 1  # the others are in no two sets
    place = np.cumsum(kept) - 1
    owner, column = owner[kept[column]], place[column[kept[column]]]
    w = weights[values[kept] & np.uint32(CELLS - 1)].astype(np.float64)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(sets), len(sets)))
    for at in range(0, len(w), COLUMNS):
        low, high = np.searchsorted(column, (at, at + COLUMNS))
        x = np.zeros((len(sets), min(COLUMNS, len(w) - at)))
        x[owner[low:high], column[low:high] - at] = 1
        out += (x * w[at : at + COLUMNS]) @ x.T
    return out


def links_within(band: int, rows: list[tuple], weights: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Links between classes of an open band's texts. rows: (side, class, open bands, total weight, elements as bytes); texts of sides 0 and 1 meet those of the other side, and texts of side 2 meet all.

    All pairs of two classes count for which this band is the first that both have, and whose total weights don't rule the
    threshold out. The links tie the classes as all pairs that are alike would, without naming each.
    """
    side, label, total = (np.array([r[i] for r in rows]) for i in (0, 1, 3))
    able = np.triu(label[:, None] != label, 1) & ((side[:, None] != side) | (side == 2))
    able &= np.minimum(total[:, None], total) >= (threshold - 1e-9) * np.maximum(total[:, None], total)
    if able.any():
        able &= _first([r[2] for r in rows], band)
    a, b = np.nonzero(able)
    if not len(a):
        return []
    sets = {i: np.frombuffer(rows[i][4], np.uint32) for i in np.union1d(a, b).tolist()}
    if len(a) > 2 * len(sets):
        place = {i: n for n, i in enumerate(sets)}
        x, y = (np.array([place[i] for i in v.tolist()]) for v in (a, b))
        both = _common(list(sets.values()), weights)[x, y]
        alike = both / (total[a] + total[b] - both)
        maybe = alike >= threshold - 1e-9
        a, b, sure = a[maybe], b[maybe], alike[maybe] > threshold + 1e-9
    else:
        sure = np.zeros(len(a), bool)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    out = []
    for i, j, known in zip(a.tolist(), b.tolist(), sure.tolist(), strict=True):
        x, y = root(int(label[i])), root(int(label[j]))
        if x != y and (known or similarity(sets[i], sets[j], weights) >= threshold):
            parent[max(x, y)] = min(x, y)
            out.append((int(label[i]), int(label[j])))
    return out


def _rest(texts: DataFrame, banded: DataFrame, tested: DataFrame, labels: DataFrame, sets: DataFrame, weights, threshold: float) -> DataFrame | None:
    """Links (a, b) between classes that `tested` pairs (a, b, ok) with their classes `labels` have left out; None if there are none.

    Only bands that hold a pair which failed and whose texts are in two classes can be open. One of up to TEXTS texts is
    the work of one task. The texts of a larger one are dealt to cells by the logarithm of their total weight, so that
    texts of the similarity are in the same or in neighbouring cells, and those of a cell to blocks by their hash. Every
    two blocks that can hold a pair of two classes are the work of one task, so no task holds more than two blocks, and a
    text's elements go to as many tasks as there are blocks in its cell and the two beside it.
    """
    where = lambda df, node, to: df.join(labels.select(F.col("node").alias(node), F.col("component").alias(to)), node, "left").withColumn(to, F.coalesce(to, node))
    failed = written(where(where(tested.where("NOT ok").select("a", "b"), "a", "ca"), "b", "cb").where("ca <> cb").select("a", "b"))
    if not failed.limit(1).count():
        return None
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    of = lambda x: texts.where("node IS NOT NULL").select(F.col("node").alias(x), F.col("bands").alias(f"{x}_bands"))
    bands = failed.join(of("a"), "a").join(of("b"), "b").select(F.explode(F.array_intersect("a_bands", "b_bands")).alias("band")).distinct()
    step = -1.001 * math.log(threshold) if 0.01 < threshold < 1 else 1e-6 if threshold >= 1 else math.inf
    own = F.collect_set("band").over(Window.partitionBy("node"))  # BANDS at most
    members = where(banded.join(bands, "band", "left_semi").distinct(), "node", "class")
    members = written(members.join(sets.select(F.col("id").alias("node"), "weight", F.octet_length("elements").alias("size")), "node").select("band", "node", "class", own.alias("own"), "weight", "size", F.floor(F.ln("weight") / F.lit(step)).cast("int").alias("cell")))
    blocks = lambda: F.greatest(F.ceil(F.count(F.lit(1)) / TEXTS), F.ceil(F.sum("size") / TEXT_BYTES)).cast("int")
    large = written(members.groupBy("band").agg(blocks().alias("n")).where("n > 1").select("band"))  # few, so no band's texts meet in one task
    cells = members.join(large, "band", "left_semi").groupBy("band", "cell").agg(blocks().alias("n"), F.min("class").alias("low"), F.max("class").alias("high"))
    cells = written(cells.groupBy("band").agg(F.map_from_entries(F.collect_list(F.struct("cell", F.struct("n", "low", "high")))).alias("cells")))  # some sixty of them at most
    mine, lower, upper = (F.try_element_at("cells", F.col("cell") + i) for i in (0, -1, 1))
    block = F.pmod(F.xxhash64("node", "band"), mine["n"]).cast("int")
    unit = lambda cell, kind, i, j, side: F.struct(F.concat_ws(" ", cell, F.lit(kind), i, j).alias("unit"), side.cast("int").alias("side"))
    each = lambda n, f: F.transform(F.sequence(F.lit(0), n - 1), f)
    two = lambda other: other.isNotNull() & (F.least(mine["low"], other["low"]) < F.greatest(mine["high"], other["high"]))
    none = F.array().cast("array<struct<unit:string,side:int>>")
    at = F.col("cell")
    met = F.concat(
        F.when(mine["low"] < mine["high"], each(mine["n"], lambda j: unit(at, "in", F.least(block, j), F.greatest(block, j), F.when(block == j, 2).when(block < j, 0).otherwise(1)))).otherwise(none),
        F.when(two(upper), each(upper["n"], lambda j: unit(at, "up", block, j, F.lit(0)))).otherwise(none),
        F.when(two(lower), each(lower["n"], lambda j: unit(at - 1, "up", j, block, F.lit(1)))).otherwise(none),
    )
    dealt = members.join(cells, "band", "left").withColumn("u", F.explode(F.when(F.col("cells").isNull(), F.array(F.struct(F.lit("").alias("unit"), F.lit(2).alias("side")))).otherwise(met)))
    dealt = dealt.select("band", "u.unit", "u.side", "node", "class", "own", "weight").join(sets.select(F.col("id").alias("node"), "elements"), "node")
    dealt = dealt.select("band", "unit", "side", "class", "own", "weight", "elements").repartition(partitions, "band", "unit").sortWithinPartitions("band", "unit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("near_dup")
        emit = lambda found: pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])
        last, rows = None, []
        for batch in (x for b in batches for x in pieces(b, 2 << 20)):
            for band, unit, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (band, unit) != last:
                    if len(rows) > 1 and (found := links_within(last[0], rows, weights.value, threshold)):
                        yield emit(found)
                    last, rows = (band, unit), []
                rows.append(row)
        if len(rows) > 1 and (found := links_within(last[0], rows, weights.value, threshold)):
            yield emit(found)

    return written(dealt.mapInArrow(run, "a long, b long").distinct())


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The class of every document: documents linked, directly or through others, by a similarity of at least `threshold`.

    Returns id_col, `copy_of` long: the least id of a document with the same text, and `class_id` long: the least id of
    its class. Ids are whole numbers. Equal texts are in one class whatever they hold, so null and empty texts are one
    class; a text without words is like no other text. Rows that share an id are one document, and link the classes of
    their texts. A null id gets the class of its text, and links nothing; its class is null if no other row has the text.
    Other columns are not read. An empty table gives an empty table.

    Shuffles: a row of 16 bands for each document and text; the texts once, to pick those in pairs; for each pair one
    text's elements (4 bytes a word). Open bands (see _rest) move the elements of their texts once more for each of them.
    """
    named = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    spark = docs.sparkSession
    counts, n = frequencies(named.select("text"))
    weights = spark.sparkContext.broadcast(weights_of(counts, n))  # 2 MB
    samplers: dict = {}

    def sample(batch: pa.RecordBatch) -> list[pa.Array]:
        sampler = samplers.get(0) or samplers.setdefault(0, Sampler(weights.value))
        return [batch.column(0), batch.column(1), pa.array([sampler.bands(x) for x in batch.column(2).to_pylist()], pa.list_(pa.int64()))]

    sampled = map_rows(named.select("id", text_key("text").alias("key"), "text"), sample, "id long, key string, bands array<bigint>", ["id", "key", "bands"], most_bytes=2 << 20, owner="near_dup")
    texts = cut(sampled.groupBy("key").agg(F.min("id").alias("node"), F.first("bands").alias("bands"), F.count(F.lit(1)).alias("copies")))

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    banded = texts.where("node IS NOT NULL").select(F.explode("bands").alias("band"), "node")
    found = cut(banded.repartitionByRange(partitions, "band", "node").sortWithinPartitions("band", "node").mapInArrow(_pairs, "a long, b long, band long"))
    heads = found.where("b IS NULL").select("band", "a")  # two for each task
    bridges = heads.join(heads.groupBy("band").agg(F.min("a").alias("m")), "band").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    pairs = written(found.where("b IS NOT NULL").select("a", "b").union(bridges).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

    def to_elements(batch: pa.RecordBatch) -> list[pa.Array]:
        w, found = weights.value, [elements(x) for x in batch.column(1).to_pylist()]
        return [batch.column(0), pa.array([x.tobytes() for x in found], pa.binary()), pa.array([float(w[x & np.uint32(CELLS - 1)].sum(dtype=np.float64)) for x in found], pa.float64())]

    nodes = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    wanted = texts.select(F.col("node").alias("id"), "key").join(nodes, "id", "left_semi")
    chosen = named.select("id", text_key("text").alias("key"), "text").join(wanted, ["id", "key"], "left_semi")
    sets = cut(map_rows(chosen.select("id", "text"), to_elements, "id long, elements binary, weight double", ["id", "elements", "weight"], most_bytes=2 << 20, owner="near_dup"))

    def verify(pairs: DataFrame) -> DataFrame:
        """The pairs, with a column `ok`."""
        names = pairs.columns

        def similar(batch: pa.RecordBatch) -> list[pa.Array]:
            w, cell = weights.value, lambda x: np.frombuffer(x, np.uint32)
            ok = [similarity(cell(x), cell(y), w) >= threshold for x, y in zip(batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist(), strict=True)]
            return [*batch.columns[: len(names)], pa.array(ok, pa.bool_())]

        ends = pairs.select(F.explode(F.array(F.struct(F.lit("a").alias("end"), F.col("a").alias("id")), F.struct(F.lit("b").alias("end"), F.col("b").alias("id")))).alias("e")).groupBy("e.end", "e.id").agg(F.count(F.lit(1)).alias("n"))
        heavy = heavy_keys(ends, pairs.count())
        of = lambda end: [(x, parts) for e, x, parts in heavy if e == end]
        with_a = join_spread(pairs, sets.select(F.col("id").alias("a"), F.col("elements").alias("x")), "a", of("a"))
        with_b = join_spread(with_a, sets.select(F.col("id").alias("b"), F.col("elements").alias("y")), "b", of("b")).select(*names, "x", "y")
        return map_rows(with_b, similar, "".join(f"{x} long, " for x in names) + "ok boolean", [*names, "ok"], owner="near_dup")

    tested = written(verify(pairs))
    links = tested.where("ok").select("a", "b")

    keyed = named.select("id", text_key("text").alias("key"))
    heavy = heavy_keys(texts.select("key", F.col("copies").alias("n")), n)
    ties = links
    shared = keyed.where("id IS NOT NULL").groupBy("id").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low <> high").select("id")
    if shared.limit(1).count():
        several = join_spread(keyed.join(shared, "id", "left_semi"), texts.select("key", "node"), "key", heavy).where("id <> node")
        ties = ties.union(several.select(F.col("node").alias("b"), F.col("id").alias("a")))
    labels = components(ties)
    if (more := _rest(texts, banded, tested, labels, sets, weights, threshold)) is not None:
        labels = components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    named_texts = texts.select("key", F.col("node").alias("copy_of")).join(labels, F.col("copy_of") == F.col("node"), "left").select("key", "copy_of", F.coalesce("component", "copy_of").alias("class_id"))
    return join_spread(keyed, named_texts, "key", heavy).select(F.col("id").alias(id_col), "copy_of", "class_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` without near duplicates: of each class the document with the least id stays, with all its columns. Of rows that repeat an id, one stays. Rows with a null id stay, unless another row has their text."""
    found = cut(classes(docs, id_col, text_col, threshold))
    most, nulls = found.groupBy(id_col).count().agg(F.max(F.when(F.col(id_col).isNotNull(), F.col("count"))), F.count_if(F.col(id_col).isNull())).head()
    gone = found.where(f"`{id_col}` <> class_id").select(F.col(id_col)).distinct()
    rows = docs.join(gone, id_col, "left_anti")
    if nulls:
        copied = rows.where(F.col(id_col).isNotNull()).select(text_key(text_col).alias("__key")).distinct()
        lone = docs.where(F.col(id_col).isNull()).withColumn("__key", text_key(text_col)).join(copied, "__key", "left_anti").dropDuplicates(["__key"]).select(*docs.columns)
        rows = rows.where(F.col(id_col).isNotNull()).unionByName(lone)
    if (most or 0) > 1:
        rows = rows.where(F.col(id_col).isNotNull()).dropDuplicates([id_col]).unionByName(rows.where(F.col(id_col).isNull()))
    return rows
