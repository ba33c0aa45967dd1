"""The corpus pipeline: language identification, toxicity, near-duplicate removal, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next one's docs. All
but the last return the rows they keep as they came, with every column of `docs`, also columns that have the name of
something an operator works out. What the stages need is `doc_id`, `text`, `lang` and `source`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import language_id, near_dup, packing, toxicity
from brindle.llm.queries import id_class, vocabulary
from brindle.llm.shared import delete, shared_folder, table

#: The least share of a document's trigrams that some language has to know.
LEAST_KNOWN = 0.5


def _judged(docs: DataFrame, judge: Callable[[DataFrame, tuple[str, ...]], DataFrame], condition: str) -> DataFrame:
    """The rows of `docs` whose judgement meets the condition. Their columns pass through the operator under names of their own."""
    names = {c: f"__column{i}" for i, c in enumerate(docs.columns)}
    carried = docs.select(F.col("doc_id"), F.col("text"), *(F.col(f"`{c}`").alias(x) for c, x in names.items()))
    return judge(carried, tuple(names.values())).where(condition).select(*(F.col(x).alias(c) for c, x in names.items()))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that are in no language: without letters (null and empty texts among them), or mostly of trigrams that no language has.

    Languages are learned from the documents' own labels; null labels teach nothing, and if there are none at all every
    document is rejected. Very long texts are judged whole. Rows that repeat an id or a text are judged each, alike for
    equal texts. An empty table gives an empty table.
    """
    model = language_id.fit(docs, id_class(4) != 2)
    return _judged(docs, lambda rows, keep: language_id.identify(rows, model, keep=keep), f"lang_pred <> 'und' AND known >= {LEAST_KNOWN}")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that score one half or more.

    A null text counts as empty and is scored like one. Labels come from `labels`; without labels of both kinds the score
    is their share, so nothing is rejected unless most are toxic. Very long texts are scored whole. Repeated rows are
    scored each. An empty table gives an empty table.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), id_class(5) != 0)
    return _judged(docs, lambda rows, keep: toxicity.score_documents(rows, model, keep=keep), "score < 0.5")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the least id stays.

    Null and empty texts are one class; of rows that repeat an id one stays; a row with a null id stays unless another
    row has its text (see near_dup.keep_one). Very long texts are compared whole. An empty table gives an empty table.
    """
    return near_dup.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into windows of 4096 tokens with the corpus's proportions of sources. Each piece with its token ids.

    A null source is a source of its own; a null or empty text is the end token alone; repeated rows are packed each; long
    texts are cut where windows end. An empty table gives an empty table.
    """
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), window=4096, end_id=2)


STAGES = [("language_id", identify_language), ("toxicity", reject_toxic), ("near_dup", drop_near_duplicates), ("packing", pack)]

#: Language mixtures, compression lengths and sampled similarity have no SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`. What a stage returns is written to the shared folder and read from there; what no later stage reads is deleted."""
    docs, folder, last = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if last:
            delete(spark, f"{folder}/{last}")
        last = name
    return STAGES[-1][1](spark, docs, sf_dir)
