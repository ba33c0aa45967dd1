"""Exact token counts of every prefix of a text, and what follows from them: whole counts, budgets, truncation.

Dynamic programming over a pre-token's prefixes gives the number of tokens of each. These tables are kept by pre-token;
sums of their last entries count whole texts, and one table answers where within a pre-token a budget ends, for any
number of budgets, without encoding anything again.
"""

from __future__ import annotations

from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .shared import map_rows, text_or_empty

_spaces = regex.compile(r"\s+")  # as the pattern takes it, which is not as Python does
_last = itemgetter(-1)


def prefix_counts(model: bpe.Bpe, text: str) -> list[int]:
    """The number of tokens of text[:i], encoded by itself, for every i. The text holds no special string.

    The tables of its pre-tokens give the counts of all their prefixes. What a longer text would split differently is
    set right: a run of white space stands alone at a prefix's end, and half a contraction is two pre-tokens.
    """
    if model.marks_ends:
        raise ValueError("prefixes are counted for vocabularies that keep white space and don't mark ends of words")
    counts = [0] * (len(text) + 1)
    at = total = 0
    for word in model.pretokens(text):
        table = model.tables[word]
        for i in range(1, len(word) + 1):
            counts[at + i] = total + table[i]
        if word in ("'re", "'ve", "'ll"):
            counts[at + 2] = total + 2
        at, total = at + len(word), total + table[-1]
    for m in _spaces.finditer(text):
        if m.end() - m.start() > 1 or m.end() == len(text):
            table = model.tables[m[0]]
            for i in range(1, len(m[0]) + 1):
                if m.start() + i < len(text) or m.end() == len(text):
                    counts[m.start() + i] = counts[m.start()] + table[i]
    return counts


class Counted:
    """The counts of one text: `total` tokens; `prefix` and `longest` need a vocabulary that keeps white space."""

    def __init__(self, model: bpe.Bpe, text: str):
        self.model, self.text = model, text
        self.parts, self.total, self.size = [], 0, 0  # of each part without special strings: characters and tokens before it, its words and their counts
        for part, special in model.segments(text):
            if special is not None:
                self.parts.append((self.size, self.total, None, [1]))
                self.total += 1
            elif part:
                words = model.pretokens(part)
                counts = list(map(_last, map(model.tables.__getitem__, words)))
                self.parts.append((self.size, self.total, words, counts))
                self.total += sum(counts)
            self.size += len(part)

    def _around(self, part: tuple, j: int) -> tuple[int, int, list[int]]:
        """The stretch around word j that can be encoded by itself: characters and tokens before it, and the counts of its prefixes."""
        start, before, words, counts = part
        lengths = list(map(len, words))
        safe = lambda i: i == 0 or words[i][0] == " " and len(words[i]) > 1 and not words[i][1].isspace() and not words[i - 1][-1].isspace()  # noqa: E731  before one blank between visible characters
        low, high = j, j + 1
        while not safe(low):
            low -= 1
        while high < len(words) and not safe(high):
            high += 1
        return start + sum(lengths[:low]), before + sum(counts[:low]), prefix_counts(self.model, "".join(words[low:high]))

    def longest(self, budget: int) -> int:
        """Characters of the longest prefix of at most `budget` tokens. A special string is taken whole or not at all."""
        if self.total <= budget:
            return self.size
        for part in self.parts:
            start, before, words, counts = part
            if before + sum(counts) > budget:
                if words is None:
                    return start
                j = int(np.searchsorted(np.cumsum(counts), budget - before, side="right"))
                at, base, prefixes = self._around(part, j)
                return at + max(i for i, x in enumerate(prefixes) if base + x <= budget)
        return self.size

    def prefix(self, chars: int) -> int | None:
        """The tokens of the text's first `chars` characters (all, if it has fewer); None within a special string, where encoding starts anew."""
        if chars >= self.size:
            return self.total
        for i in range(len(self.parts) - 1, -1, -1):
            start, before, words, _ = part = self.parts[i]
            if chars == start:
                return before
            if chars > start:
                if words is None:
                    return None
                j = int(np.searchsorted(np.cumsum(list(map(len, words))), chars - start, side="left"))
                at, base, prefixes = self._around(part, j)
                return base + prefixes[chars - at]
        return 0


def longest_prefix(model: bpe.Bpe, text: str, budget: int) -> int:
    return Counted(model, text).longest(budget)


def count_tokens(docs: DataFrame, vocabulary: str, budgets: tuple[int, ...] = (), cuts: tuple[int, ...] = (), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The exact number of tokens of every whole text, and of its prefixes.

    Returns id_col, `n_bytes` long (of UTF-8), `n_tokens` long, `fits_chars` array<bigint>: for each of `budgets`, the
    characters of the longest prefix of at most so many tokens, `cut_tokens` array<bigint>: for each of `cuts`, the
    tokens of the text's first so many characters (null where that is within a special string). A null text counts as
    empty: 0 everywhere. Budgets and cuts need a vocabulary that keeps white space. There is no shuffle; rows that
    repeat are counted each; other columns are not read; an empty table gives an empty table.
    """
    kept = docs.select(F.col(id_col), text_or_empty(text_col).alias("text"))

    def rows(batch: pa.RecordBatch) -> list[pa.Array]:
        model = bpe.bpe(vocabulary)
        sizes, totals, fits, parts = [], [], [], []
        for text in batch.column(1).to_pylist():
            counted = Counted(model, text)
            sizes.append(len(text.encode()))
            totals.append(counted.total)
            fits.append([counted.longest(b) for b in budgets])
            parts.append([counted.prefix(c) for c in cuts])
        longs = pa.list_(pa.int64())
        return [batch.column(0), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64()), pa.array(fits, longs), pa.array(parts, longs)]

    schema = f"`{id_col}` {kept.schema[0].dataType.simpleString()}, n_bytes long, n_tokens long, fits_chars array<bigint>, cut_tokens array<bigint>"
    return map_rows(kept, rows, schema, [id_col, "n_bytes", "n_tokens", "fits_chars", "cut_tokens"], most_bytes=2 << 20, owner="bpe")
