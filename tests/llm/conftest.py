import pytest

TEXTS = [
    (0, None, "en", "a"), (1, "", "en", "a"), (2, "The quick brown fox jumps over the lazy dog and runs away from it all", "en", "b"), (3, "The quick brown fox jumps over the lazy dog and runs away from it all", "en", None),
    (4, "Ünïcödé tèxt, wîth <|endoftext|> a special string\tand\n\n  odd   space", None, "b"), (5, "中文没有空格的文字", "zh", "b"), (6, "x" * 5000, "en", "a"), (7, "1234 !!! ???", "en", "a"), (7, "1234 !!! ???", "en", "a"),
    (None, "a row without an id", "en", "a"), (9, "they're we'll I've don't   \n end ", "en", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture
def odd(spark):
    """Nulls, empty, long and repeated texts, with columns whose names clash with results."""
    rows = [(*r, 5, 6, "x", 1.5) for r in TEXTS]
    return spark.createDataFrame(rows, SCHEMA + ", shard int, slot int, ids string, score double")


@pytest.fixture
def none(spark, odd):
    return odd.where("false")
