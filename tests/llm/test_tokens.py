"""BPE, counts and packing against the tokenizers library."""

import random
import zlib
from array import array

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from brindle.llm import bpe, bpe_codec, packing, token_counts
from brindle.llm.queries import QUERIES, vocabulary

WORD, BYTE = vocabulary("word_bpe_49k.json"), vocabulary("byte_bpe_50k.json")
PIECES = ["a", "É", "ß", "İ", "Σ", "é", "中", "　", " ", "  ", "\n", "\t", "\x1c", "\xa0", "1", "½", "'s", "'RE", "'", "!", "<|endoftext|>", "<|", "😀", "ก", "한", "̀", "_", "the", "ing", "un", "re", "'ll", "'ve"]


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25))) for _ in range(n)]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_ids_counts_and_decoding_equal_the_library(path):
    library, model = Tokenizer.from_file(path), bpe.bpe(path)
    texts = odd_texts(1500, 1) + pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()[:60]
    for text, other in zip(texts, bpe.library_encoder(path).ids(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert array("I", model.ids(text)).tolist() == want == array("I", other).tolist(), text
        assert token_counts.Counted(model, text).total == len(want), text
        assert model.decode(want) == library.decode(want, skip_special_tokens=False), text


def test_every_prefix_is_counted_exactly():
    library, model = Tokenizer.from_file(BYTE), bpe.bpe(BYTE)
    for text in odd_texts(300, 2) + ["they're  all 'r  \n\n x", "   ", "a'll", "!'re"]:
        text = text.replace("<|endoftext|>", "")
        counts = token_counts.prefix_counts(model, text)
        assert counts == [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)], text


def test_counts_of_cuts():
    """Truncation at any character is answered from the stored tables; within a special string there is no answer."""
    library, model = Tokenizer.from_file(BYTE), bpe.bpe(BYTE)
    for text in odd_texts(150, 4) + ["x" * 3000 + " and  more"]:
        counted, inside = token_counts.Counted(model, text), {i for m in model.special_pattern.finditer(text) for i in range(m.start() + 1, m.end())}
        for i in (0, 1, 2, 3, 5, 8, 13, len(text) // 2, len(text) - 1, len(text), len(text) + 5):
            if 0 <= i:
                assert counted.prefix(i) == (None if i in inside else len(library.encode(text[:i], add_special_tokens=False).ids)), (text, i)


def test_other_preparations_are_refused(tmp_path):
    import json

    spec = json.load(open(BYTE))
    for pre, normal in (({"type": "Whitespace"}, None), (spec["pre_tokenizer"], {"type": "NFKC"}), (None, None)):
        (tmp_path / "x.json").write_text(json.dumps(spec | {"pre_tokenizer": pre, "normalizer": normal}))
        with pytest.raises(ValueError):
            bpe.Bpe(str(tmp_path / "x.json"))


def test_caches_keep_to_their_bytes_and_results(monkeypatch):
    """With room for a few words only, results are the same, and what is kept stays small."""
    monkeypatch.setattr(bpe, "CACHE_BYTES", 4000)
    texts = odd_texts(200, 5)
    library = Tokenizer.from_file(WORD)
    one, other = bpe.Bpe(WORD), bpe.LibraryEncoder(WORD)
    for text, ids in zip(texts, other.ids(texts), strict=True):
        assert one.ids(text) == ids == array("I", library.encode(text, add_special_tokens=False).ids).tobytes()
    assert len(one.words) < 20 and one.words.used < 5000


@pytest.mark.parametrize("budget", [0, 1, 3, 7])
def test_longest_prefix_within_a_budget(budget):
    library, model = Tokenizer.from_file(BYTE), bpe.bpe(BYTE)
    for text in odd_texts(120, 3):
        fits = [i for i in range(len(text) + 1) if len(library.encode(text[:i], add_special_tokens=False).ids) <= budget and not any(m.start() < i < m.end() for m in model.special_pattern.finditer(text))]
        special = [m.start() for m in model.special_pattern.finditer(text)]
        got = token_counts.longest_prefix(model, text, budget)
        if not special:
            assert got == max(fits), text
        assert got in fits, text


def test_odd_rows(spark, odd, none):
    library = Tokenizer.from_file(WORD)
    rows = bpe_codec.decode(bpe_codec.encode(odd, WORD), WORD).collect()
    assert len(rows) == odd.count()
    texts = {r["doc_id"]: r["text"] or "" for r in odd.collect()}
    for r in rows:
        want = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert array("I", bytes(r["ids"])).tolist() == want and r["text"] == library.decode(want, skip_special_tokens=False)
    counts = {r["doc_id"]: r for r in token_counts.count_tokens(odd, BYTE, (5, 2), (0, 3)).collect()}
    assert counts[0]["n_tokens"] == counts[0]["n_bytes"] == 0 and counts[0]["fits_chars"] == counts[0]["cut_tokens"] == [0, 0]
    assert bpe_codec.encode(none, WORD).count() == 0 and token_counts.count_tokens(none, BYTE, (5,)).count() == 0


def check_packing(docs, rows, window, library):
    want = {}
    for r in docs:
        want.setdefault(r["doc_id"], []).append(library.encode(r["text"] or "", add_special_tokens=False).ids + [2])
    at, by = {}, {}
    for r in rows:
        at.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by.setdefault(r["doc_id"], []).append(r)
    assert sorted(at) == list(range(len(at)))
    for k, spans in at.items():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end and length > 0
            end += length
        assert end == window or k == len(at) - 1
    for doc, ids in want.items():
        pieces = sorted(by[doc], key=lambda r: (r["sequence_id"], r["offset"]))
        found, text = [], []
        for p in pieces:
            text += array("I", bytes(p["ids"])).tolist()
            if p["start"] + p["length"] == p["doc_tokens"]:
                found.append(text)
                text = []
        assert sorted(found) == sorted(ids)


def test_packing_is_whole_and_gapless(spark, odd, none):
    library = Tokenizer.from_file(WORD)
    for block in (1 << 25, 200):
        rows = packing.pack(odd.where("doc_id <> 7"), WORD, window=16, block_bytes=block).collect()
        check_packing(odd.where("doc_id <> 7").collect(), rows, 16, library)
    assert sum(r["length"] for r in packing.pack(odd, WORD, window=16).collect()) == sum(len(library.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in odd.collect())
    assert packing.pack(none, WORD).count() == 0


def test_packing_keeps_to_the_mixture(spark):
    rng = np.random.default_rng(0)
    rows = [(i, "the cat " * int(rng.integers(1, 60)), "hot" if i % 3 == 0 else f"s{i % 5}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    pieces = packing.pack(docs, WORD, window=512).toPandas()
    share = pieces.groupby("source")["length"].sum() / pieces["length"].sum()
    order = pieces.sort_values(["sequence_id", "offset"])
    for source, part in share.items():
        sent = (order["length"] * (order["source"] == source)).cumsum()
        assert (sent - part * order["length"].cumsum()).abs().max() < 3 * 512, source  # a window, a document, and how unevenly a partition's documents fell


def test_packing_of_many_small_sources(spark):
    """Sources of half a percent are mixed evenly and can have targets, however their totals reach the rows."""
    docs = spark.createDataFrame([(i, "the cat " * 20, f"s{i // 40}") for i in range(8000)], "doc_id long, text string, source string").coalesce(1)
    for most in (1 << 20, 0):
        even = packing.pack(docs, WORD, window=512, block_bytes=1 << 22, most_totals=most).toPandas()
        order = even.sort_values(["sequence_id", "offset"])
        assert (order["sequence_id"] * 512 + order["offset"]).tolist() == [0, *order["length"].cumsum()[:-1]]
        for source in ("s0", "s77", "s199"):
            sent = (order["length"] * (order["source"] == source)).cumsum()
            assert (sent - order["length"].cumsum() / 200).abs().max() < 512, source
    for bad in ({"none": 0.2}, {"s7": -0.1}, {"s7": 0.7, "s8": 0.7}):
        with pytest.raises(ValueError):
            packing.pack(docs, WORD, window=512, targets=bad)


@pytest.mark.parametrize(("block", "parts"), [(1 << 25, 1), (30_000, 1), (30_000, 4)])
def test_packing_keeps_to_targets_until_a_source_ends(spark, block, parts):
    """Half and half of a corpus of one part in ten, over several blocks and partitions: each window but the last one of the scarce source has both halves, to within four documents where partitions meet, and what is left of the other follows."""
    docs = spark.createDataFrame([(i, "the cat " * 20, "a" if i % 10 == 3 else "b") for i in range(8000)], "doc_id long, text string, source string").repartition(parts)
    rows = packing.pack(docs, WORD, window=512, targets={"a": 0.5, "b": 0.5}, block_bytes=block).toPandas()
    share = rows.assign(a=rows["length"] * (rows["source"] == "a")).groupby("sequence_id")[["a", "length"]].sum()
    mixed = 800 * 41 * 2 // 512
    part = share["a"] / share["length"]
    assert len(rows["doc_id"].unique()) == 8000 and rows["length"].sum() == 8000 * 41 and (share["length"].iloc[:-1] == 512).all()
    assert (part.iloc[: mixed - 1] - 0.5).abs().max() <= 41 * 4 / 512 and (part.iloc[mixed + 1 :] == 0).all()


def test_packing_sends_long_documents_in_stretches(spark):
    """Between the windows of a document of many windows those of other sources of its partition are sent, and the same rows give the same windows again."""
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    rows = [(0, "the cat " * 6000, "long")] + [(i, "the cat " * 30, "short") for i in range(1, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1)
    found = [packing.pack(docs, WORD, window=512).toPandas().sort_values(["sequence_id", "offset"]).reset_index(drop=True) for _ in range(2)]
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found[0].equals(found[1])
    for source, n in (("long", 12001), ("short", 199 * 61)):
        sent = (found[0]["length"] * (found[0]["source"] == source)).cumsum()
        assert (sent - found[0]["length"].cumsum() * n / (12001 + 199 * 61)).abs().max() < 2.5 * 512


def test_packing_of_other_id_types(spark):
    docs = spark.createDataFrame([(1.5, "the cat", "a"), (None, None, None), (1.5, "the cat", "a")], "doc_id double, text string, source string")
    rows = packing.pack(docs, WORD, window=4).collect()
    assert {r["doc_id"] for r in rows} == {1.5, None} and sum(r["length"] for r in rows) == 7


def test_bpe_query(spark):
    import hashlib

    library = Tokenizer.from_file(WORD)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = QUERIES["op4_bpe"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_decoding_refuses_what_is_no_id(spark):
    for ids in (b"\x01\x00", np.array([60_000], "<u4").tobytes()):
        with pytest.raises(ValueError):
            bpe.bpe(WORD).decode(bpe_codec._numbers(ids))
    rows = bpe_codec.decode(spark.createDataFrame([(1, None), (2, b"")], "doc_id long, ids binary"), WORD).collect()
    assert [r["text"] for r in rows] == ["", ""]


def test_token_count_query(spark):
    library = Tokenizer.from_file(BYTE)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = QUERIES["op6_token_counts"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        text = texts[r["doc_id"]]
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 1024)
        cut = len(library.encode(text[: r["fits_chars"]], add_special_tokens=False).ids)
        assert r["fits_chars"] == len(text) if n <= 1024 else cut <= 1024


def test_packing_query(spark):
    rows = QUERIES["op2_packing"](spark, "/root/testdata/sf0.001").collect()
    library = Tokenizer.from_file(WORD)
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    ids = {k: np.array(library.encode(v or "", add_special_tokens=False).ids + [2], "<u4") for k, v in docs.items()}
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values()))
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
    assert max(r["offset"] + r["length"] for r in rows) <= 4096


def test_words_are_looked_up_once():
    """Each word of a text costs one look into the table, and another only when it is new."""
    encoder, looks = bpe.LibraryEncoder(WORD), []

    class Counted(dict):
        get = lambda self, *x: looks.append(x[0]) or dict.get(self, *x)
        __contains__ = lambda self, x: looks.append(x) or dict.__contains__(self, x)
        __getitem__ = lambda self, x: looks.append(x) or dict.__getitem__(self, x)

    encoder.words = Counted(encoder.words)
    text = "one two three " * 50
    first = encoder.ids([text, "", "four"])
    looks.clear()
    assert encoder.ids([text, "", "four"]) == first == [np.array(encoder.library.encode(t, add_special_tokens=False).ids, np.uint32).tobytes() for t in (text, "", "four")]
    assert len(looks) == 151
