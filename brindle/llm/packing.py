"""Mixture-controlled packing by deficit round-robin over one queue for each source.

Documents of each source are dealt in turn to partitions. Every partition serves its queues in rounds: in each round a
queue's credit grows by its share of one window, and it sends what its credit covers: whole documents, or stretches of a
window of longer ones. What it could not send stays as its deficit for the next window. The stream is cut at every
multiple of the window, so all windows but the very last are full.

Credits and positions carry across partitions without running them one after the other. A queue's credit before a
partition is its share of all tokens before that partition, less those it has sent itself, and both follow from the
token totals of each partition and queue.

With target proportions there are two phases. The first holds of each source what the targets allow before the scarcest
source runs out, so its windows have the targets' proportions throughout; the second holds the surplus of the others, in
its own proportions, and all its windows follow those of the first.
"""

from __future__ import annotations

import zlib
from collections import Counter, deque
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import bpe
from .shared import claim, cut, pieces, text_or_empty

#: So many totals of a partition and source are sent to every task; if there are more, the ids are shuffled once more to meet theirs.
MOST_TOTALS = 1 << 20
#: Bytes of ids that a task's queues hold at most.
BLOCK_BYTES = 32 << 20


def pack(docs: DataFrame, vocabulary: str, window: int = 4096, end_id: int = 2, targets: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block_bytes: int = BLOCK_BYTES, most_totals: int = MOST_TOTALS) -> DataFrame:
    """Packs the tokens of all documents, each followed by end_id, into windows.

    Returns one row for each piece: id_col, `source`, `start` long (tokens of its document before it), `length` long,
    `ids` binary (little-endian unsigned 32-bit integers), `doc_tokens` long, `sequence_id` long, `offset` long.
    Windows are filled without gaps; only the last one may be short. A document goes on in the next window where one
    ends; one longer than a window is sent in stretches of a window, so that other sources come between them.

    targets: the share of tokens each source should have in every window; by default its share of the corpus. Sources
    without a target share what the targets leave in proportion to their tokens. A target that no source has, a negative
    one, and targets of over 1 together are errors. Windows keep to the targets until the scarcest source is used up;
    what the others have left then follows in windows of its own proportions. Nothing is repeated and nothing left out.

    Every source has a queue of its own, and so has a null source. A null or empty text is end_id alone. Repeated rows
    are packed each, and so are rows with a null id. Ids may be of any type. Other columns are not read. An empty table
    gives an empty table. Rows are dealt by their place in the partitions of `docs`, and packed in the order of a hash, so
    the same input gives the same windows.

    One shuffle moves the ids, at two bytes each where the vocabulary allows, and they are written once to the shared
    folder; the driver gets one number for each partition and phase. Each row meets the totals of its partition and
    source in a join.
    """
    kept = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), text_or_empty(text_col).alias("text"))
    id_type = kept.schema[0].dataType
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        claim("bpe")
        task, number, before = TaskContext.get().partitionId(), Counter(), Counter()
        for batch in (x for b in batches for x in pieces(b, 2 << 20)):
            packed, n, parts, starts = [], [], [], []
            for source, ids in zip(batch.column(1).to_pylist(), bpe.library_encoder(vocabulary).ids(batch.column(2).to_pylist()), strict=True):
                wide = np.append(np.frombuffer(ids, np.uint32), np.uint32(end_id))
                narrow = wide.max() < 1 << 16
                packed.append((b"\x02" if narrow else b"\x04") + wide.astype("<u2" if narrow else "<u4").tobytes())
                n.append(len(wide))
                if source not in number:  # each task begins elsewhere, so that rare sources are spread
                    number[source] = zlib.crc32(f"{task} {source}".encode("utf-8", "replace"))
                parts.append(number[source] % partitions)
                starts.append(before[source])
                number[source] += 1
                before[source] += len(wide)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(packed, pa.binary()), pa.array(parts, pa.int32()), pa.array([task] * len(n), pa.int32()), pa.array(starts, pa.int64())], names=["id", "source", "n", "packed", "part", "task", "before"])

    encoded = kept.mapInArrow(encode, kept.select("id", "source", *(F.lit(None).cast(t).alias(c) for c, t in (("n", "long"), ("packed", "binary"), ("part", "int"), ("task", "int"), ("before", "long")))).schema)
    placed = encoded.repartitionById(partitions, F.col("part")).withColumn("order", F.xxhash64("task", "source", "before"))
    queue = F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))
    dealt = cut(placed.sortWithinPartitions("order", "task", "before")).withColumn("queue", queue)
    dealt = _phased(dealt, targets, most_totals)
    sums = cut(dealt.groupBy("phase", "part", "queue").agg(F.sum("n").alias("n")))  # one pass over the ids; all else follows from it
    earlier = F.sum("n").over(Window.partitionBy("phase", "queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shares = sums.groupBy("phase", "queue").agg(F.sum("n").cast("double").alias("of")).join(sums.groupBy("phase").agg(F.sum("n").cast("double").alias("all")), "phase")
    totals = cut(sums.select("phase", "part", "queue", F.coalesce(earlier, F.lit(0)).alias("sent")).join(shares.select("phase", "queue", (F.col("of") / F.col("all")).alias("weight")), ["phase", "queue"]))
    joined = dealt.join(F.broadcast(totals) if totals.count() <= most_totals else totals, ["phase", "part", "queue"])
    if targets or totals.count() > most_totals:
        joined = joined.repartitionById(partitions, F.col("part")).sortWithinPartitions("part", "phase", "order", "task", "before")
    joined = joined.select("id", "source", "n", "packed", (F.col("phase") * partitions + F.col("part")).alias("unit"), "queue", "sent", "weight")
    before, position, first = {}, 0, {}
    for r in sums.groupBy("phase", "part").agg(F.sum("n").alias("n")).orderBy("phase", "part").collect():  # one number for each partition and phase
        first.setdefault(r["phase"], position)
        before[r["phase"] * partitions + r["part"]] = position, first[r["phase"]]
        position += r["n"]
    shared = docs.sparkSession.sparkContext.broadcast(before)
    names = [id_col, "source", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    types = [to_arrow_type(id_type), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("packing")
        state, unit = None, None
        for batch in (x for b in batches for x in pieces(b)):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[4] != unit:
                    if state:
                        yield from _cut_up(state, 0, names, types)
                    unit = row[4]
                    state = Rounds(*shared.value[unit], window)
                state.add(row)
                if state.held >= block_bytes:
                    yield from _cut_up(state, block_bytes * 3 // 4, names, types)
        if state:
            yield from _cut_up(state, 0, names, types)

    longs = ("start", "long"), ("length", "long"), ("ids", "binary"), ("doc_tokens", "long"), ("sequence_id", "long"), ("offset", "long")
    return joined.mapInArrow(run, joined.select(F.col("id").alias(id_col), "source", *(F.lit(None).cast(t).alias(c) for c, t in longs)).schema)


def _phased(dealt: DataFrame, targets: dict[str, float] | None, most_totals: int) -> DataFrame:
    """Adds `phase`: 0 for what keeps to the targets, 1 for the surplus. Of the tokens of a queue in each task the first ones are in phase 0, as many as the targets allow."""
    if not targets:
        return dealt.withColumn("phase", F.lit(0))
    named = {"=" + k: float(v) for k, v in targets.items()}
    if min(named.values()) < 0 or sum(named.values()) > 1 + 1e-9:
        raise ValueError("targets are shares: none is negative, and their sum is 1 at most")
    of_task = cut(dealt.groupBy("task", "queue").agg(F.sum("n").alias("of_task")))
    queues = of_task.groupBy("queue").agg(F.sum("of_task").cast("double").alias("n"))
    given = F.create_map(*(F.lit(x) for pair in named.items() for x in pair))[F.col("queue")]
    found = queues.where(F.col("queue").isin(list(named))).select("queue").collect()  # as many as there are targets, at most
    if len(found) < len(named) and queues.limit(1).count():
        raise ValueError(f"targets that no source has: {sorted(k[1:] for k in set(named) - {r['queue'] for r in found})}")
    others = queues.where(~F.col("queue").isin(list(named))).agg(F.sum("n")).head()[0] or 1.0
    queues = queues.withColumn("weight", F.coalesce(given, F.lit(max(0.0, 1 - sum(named.values()))) * F.col("n") / F.lit(others)))
    served = queues.where("weight > 0").agg(F.min(F.col("n") / F.col("weight"))).head()[0] or 0.0  # so often the scarcest queue can send its share
    shares = of_task.join(queues.select("queue", (F.col("weight") * F.lit(served) / F.col("n")).alias("share")), "queue")
    shares = cut(shares.select("task", "queue", (F.col("share") * F.col("of_task") + 1e-6).alias("until")))
    near = F.broadcast(shares) if shares.count() <= most_totals else shares
    return dealt.join(near, ["task", "queue"]).withColumn("phase", F.when(F.col("before") + F.col("n") / 2 <= F.col("until"), 0).otherwise(1)).drop("until")


class Rounds:
    """Deficit round-robin over queues. position: tokens sent before, of all queues; first: those sent before the phase began; held: bytes in the queues."""

    def __init__(self, position: int, first: int, window: int):
        self.position, self.first, self.window, self.held = position, first, window, 0
        self.queues: dict[str, deque] = {}
        self.sent: dict[str, int] = {}
        self.weight: dict[str, float] = {}

    def add(self, row: tuple) -> None:
        """Takes a row (id, source, n, ids, unit, queue, tokens of the queue before this unit, weight) as stretches (row, start, length)."""
        _, _, n, ids, _, k, sent, weight = row
        if k not in self.queues:
            self.queues[k], self.sent[k], self.weight[k] = deque(), sent, weight
        self.queues[k].extend((row, at, min(self.window, n - at)) for at in range(0, n, self.window))
        self.held += len(ids)

    def serve(self, enough: int) -> Iterator[tuple[tuple, int, int]]:
        """Stretches in the order in which they are sent, until a queue has run empty and at most `enough` bytes are held. What each queue is owed shows in `sent` and `position`, and carries on."""
        turns, credit, quantum, empty = [], {}, {}, False
        for i, (k, q) in enumerate(self.queues.items()):
            credit[k], quantum[k] = self.weight[k] * (self.position - self.first) - self.sent[k], max(self.weight[k] * self.window, 1e-9)
            empty |= not q
            if q:
                turns.append((max(1, ceil((q[0][2] - credit[k]) / quantum[k])), i, k))
        heapify(turns)  # the round in which a queue's credit covers what it sends first
        while turns and not (empty and 0 < self.held <= enough):
            turn, i, k = heappop(turns)
            q = self.queues[k]
            while q and q[0][2] <= credit[k] + turn * quantum[k] + 1e-9:
                row, start, length = q.popleft()
                credit[k] -= length
                self.sent[k] += length
                self.held -= len(row[3]) if start + length == row[2] else 0
                yield row, start, length
            if q:
                heappush(turns, (max(turn + 1, ceil((q[0][2] - credit[k]) / quantum[k])), i, k))
            else:
                empty = True


def _cut_up(state: Rounds, enough: int, names: list[str], types: list) -> Iterator[pa.RecordBatch]:
    """What the rounds send, cut at the ends of windows. Stretches that follow each other in a window are one piece."""
    window = state.window
    found: list[list] = []  # row, start, length, sequence, offset
    size = 0

    def batch() -> pa.RecordBatch:
        out = []
        for row, start, length, sequence, offset in found:
            ids = np.frombuffer(row[3], f"<u{row[3][0]}", offset=1)[start : start + length].astype("<u4").tobytes()
            out.append((row[0], row[1], start, length, ids, row[2], sequence, offset))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    for row, start, length in state.serve(enough):
        while length:
            sequence, offset = divmod(state.position, window)
            n = min(length, window - offset)
            if found and found[-1][0] is row and found[-1][1] + found[-1][2] == start and found[-1][3] == sequence:
                found[-1][2] += n
            else:
                if size > 4 << 20:
                    yield batch()
                    found, size = [], 0
                found.append([row, start, n, sequence, offset])
            start, length, state.position, size = start + n, length - n, state.position + n, size + 4 * n
    if found:
        yield batch()
