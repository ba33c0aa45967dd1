"""Exact top-k search by inner product with Fagin's threshold algorithm.

Candidates are dealt into blocks. Each block is turned to its principal axes, which leaves inner products as they are and
gathers most of a vector in few components, and holds one sorted list for each axis. A query walks the lists from the end
that its own component favours, always those whose bound falls most; it scores every candidate, exactly and in whole
numbers, the first time it is seen, and stops when the best score that an unseen candidate could have is below its kth
result. Blocks and query groups meet in tasks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 16_384
QUERY_ROWS = 16_384
_WALKED = 8  # lists that are walked at a time


class Lists:
    """The sorted lists of one block. vectors: whole numbers, one row for each candidate."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.repeated = len(ids) > 1 and bool((self.ids[1:] == self.ids[:-1]).any())
        self.axes = np.linalg.eigh(self.vectors.T @ self.vectors)[1][:, ::-1] if vectors.dtype == np.float64 and vectors.size else None
        turned = self.vectors @ self.axes if self.axes is not None else self.vectors
        self.order = np.argsort(-turned, axis=0, kind="stable").T.copy()  # for each axis, rows by falling component
        self.sorted = np.take_along_axis(turned, self.order.T, axis=0).T.copy()
        if self.axes is not None:
            squares = turned**2
            self.rest = np.sqrt(squares[:, ::-1].cumsum(axis=1)[:, ::-1].max(axis=0, initial=0))  # the greatest length that the components from each axis on have
            self.length = float(np.sqrt(squares.sum(axis=1)).max(initial=0))
        self.seen = 0

    def search(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """The k best (score, id) for a query, ties to the smaller id, without the candidate whose id is `own`. Of rows that share an id, the best counts once. `seen` is then the number of candidates that were scored."""
        n = len(self.ids)
        turned = query if self.axes is None else query @ self.axes
        margin = 0 if self.axes is None else 1e-9 * (1 + float(np.linalg.norm(query)) * self.length)  # far above what turning rounds
        lists = np.flatnonzero(turned)
        if not len(lists):  # all scores are 0
            self.seen = n
            return [(0, i) for i in dict.fromkeys(self.ids[self.ids != own].tolist())][:k]
        weight, up = turned[lists], turned[lists] > 0
        depth, step = np.zeros(len(lists), np.int64), np.full(len(lists), 16)
        at = lambda d: weight * self.sorted[lists, np.where(up, d, n - 1 - d)]  # noqa: E731  the most that a list adds from a depth on
        seen = np.zeros(n, bool)
        best: list[tuple[int, int]] = []
        while True:
            ahead = np.minimum(depth + step, n - 1)
            fall = np.where(depth < n, at(np.minimum(depth, n - 1)) - at(ahead), -1)
            mark = np.zeros(n, bool)
            for j in np.argsort(-fall / step, kind="stable")[:_WALKED].tolist():
                low, high = int(depth[j]), min(n, int(depth[j] + step[j]))
                mark[self.order[lists[j], low:high] if up[j] else self.order[lists[j], n - high : n - low]] = True
                depth[j], step[j] = high, 2 * step[j]
            new = np.flatnonzero(mark & ~seen)
            seen |= mark
            best = self._better(best, new, query, own, k)
            self.seen = int(seen.sum())
            if self.seen == n or (depth >= n).any():
                return best
            if len(best) == k:
                bounds = at(depth)
                bound = bounds.sum()
                if self.axes is not None:  # lists that haven't been walked, from some axis on, by length
                    last = int(lists[depth > 0].max()) + 1
                    if last < len(turned):
                        bound = min(bound, bounds[lists < last].sum() + float(np.linalg.norm(turned[last:])) * self.rest[last])
                if bound + margin < best[-1][0]:
                    return best

    def _better(self, best: list[tuple[int, int]], new: np.ndarray, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """The k best of those so far and the rows `new`."""
        if not len(new):
            return best
        scores = self.vectors[new] @ query
        if len(best) == k:
            good = scores >= best[-1][0]
            new, scores = new[good], scores[good]
        found = self.ids[new]
        if self.repeated and len(new):
            order = np.lexsort((-scores, found))
            order = order[np.concatenate([[True], found[order][1:] != found[order][:-1]])]
            found, scores = found[order], scores[order]
        if len(found) > 2 * k + 2:
            cut = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]  # one more, as the query's own may be among them
            good = scores >= cut
            found, scores = found[good], scores[good]
        most = dict(zip((i for _, i in best), (s for s, _ in best), strict=True))
        for s, i in zip(map(int, scores), found.tolist(), strict=True):
            if i != own and (i not in most or s > most[i]):
                most[i] = s
        return sorted(((s, i) for i, s in most.items()), key=lambda x: (-x[0], x[1]))[:k]


def _matrix(vectors: pd.Series) -> np.ndarray:
    """Rows of whole numbers, shorter ones filled with zeros. Sums stay exact: as doubles while they are under 2^53, else as Python's integers."""
    width = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), width), np.int64)
    for i, x in enumerate(vectors):
        out[i, : len(x)] = x
    return out


def _comparable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, width)
    kind = np.float64 if most < 2**53 else object
    return a.astype(kind), b.astype(kind)


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "vector", block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """Each query's k highest inner products over all candidates but the one of its own id; ties go to the smaller id.

    Both inputs have a whole-number id and a vector of whole numbers (array<bigint>); null ids and null vectors take no
    part, missing components count as 0. Returns `query_id`, `rank` int from 1, id_col, `score` long. Of candidates that
    share an id, the best counts once; queries that share an id are one query that gets the best of both. Other columns
    are not read. No queries or no candidates give an empty table. Scores must fit in a long.

    Every task gets about block_rows candidates and query_rows queries, whatever the tables' sizes. Vectors are copied
    once for each group of queries, queries once for each block.
    """
    clean = lambda df: df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    candidates, queries = clean(candidates), clean(queries)
    n, m = candidates.count(), queries.count()
    blocks, groups = max(1, -(-n // block_rows)), max(1, -(-m // query_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    left = candidates.select("*", dealt(blocks).alias("block")).select("*", every(groups).alias("group"))
    right = queries.select("*", dealt(groups).alias("group")).select("*", every(blocks).alias("block"))

    def search(mine: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(mine) and len(asked):
            vectors, wanted = _comparable(_matrix(mine["vector"]), _matrix(asked["vector"]))
            lists = Lists(mine["id"].to_numpy(np.int64), vectors)
            for own, query in zip(asked["id"].tolist(), wanted, strict=True):
                out += [(own, i, s) for s, i in lists.search(query, own, k)]
        return pd.DataFrame(out, columns=["query_id", "id", "score"]).astype("int64")

    found = left.groupBy("block", "group").cogroup(right.groupBy("block", "group")).applyInPandas(search, "query_id long, id long, score long")
    best = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, as doubles; null if the vector, or a component, is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(False)), F.transform(vector, lambda x: F.floor(x.cast("double") * float(scale)).cast("long")))
