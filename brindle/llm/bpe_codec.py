"""BPE encoding and decoding by per-prefix dynamic programming (see `bpe`)."""

from __future__ import annotations

from array import array

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .shared import map_rows, text_or_empty


def _numbers(ids: bytes) -> array:
    if len(ids) % 4:
        raise ValueError(f"{len(ids)} bytes aren't whole 32-bit ids")
    return array("I", ids)


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """Ids of every whole text.

    Returns id_col and `ids` binary: the ids as little-endian unsigned 32-bit integers; with `decoded` also `text`: what
    these ids decode to, as `decode` has it, in the same pass. A null or empty text has no ids.
    There is no shuffle and no limit to a text's length; rows that repeat are encoded each, rows with a null id too;
    columns other than the two named are not read. An empty table gives an empty table.
    vocabulary: the path of a tokenizers file whose model is byte-level BPE, there on every executor.
    """
    kept = docs.select(F.col(id_col), text_or_empty(text_col).alias("text"))

    def rows(batch: pa.RecordBatch) -> list[pa.Array]:
        model = bpe.bpe(vocabulary)
        ids = [model.ids(x) for x in batch.column(1).to_pylist()]
        return [batch.column(0), pa.array(ids, pa.binary()), *([pa.array([model.decode(_numbers(x)) for x in ids], pa.string())] if decoded else [])]

    schema, names = f"`{id_col}` {kept.schema[0].dataType.simpleString()}, ids binary", [id_col, "ids"]
    return map_rows(kept, rows, schema + ", text string" * decoded, names + ["text"] * decoded, most_bytes=2 << 20, owner="bpe")


def decode(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Adds `text`: what the ids stand for, special strings included. Null ids count as none, and give an empty text.

    Returns id_col, `ids` and `text`. Other columns are not read. Ids that are no token's, and bytes that aren't whole
    32-bit numbers, are an error. Repeated rows are decoded each; an empty table gives an empty table.
    """
    kept = encoded.select(F.col(id_col), F.coalesce(F.col(ids_col), F.lit(b"")).alias("ids"))

    def rows(batch: pa.RecordBatch) -> list[pa.Array]:
        to_text = bpe.bpe(vocabulary).decode
        return [batch.column(0), batch.column(1), pa.array([to_text(_numbers(x)) for x in batch.column(1).to_pylist()], pa.string())]

    return map_rows(kept, rows, f"`{id_col}` {kept.schema[0].dataType.simpleString()}, ids binary, text string", [id_col, "ids", "text"], owner="bpe")
