"""Sharding, exact top-k, URL rules and fingerprints against brute force."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from brindle.llm import fingerprints, sharding, topk_search, url_filter
from brindle.llm.queries import ORACLE_SQL, QUERIES

SMALL = "/root/testdata/sf0.001"


def test_shards_are_exact_and_whole(spark, odd, none):
    for n, cells in ((3, None), (24, 1), (2, 3)):
        rows = sharding.shard(odd, shards=n, cells_per_shard=cells).collect()
        assert Counter(r["text"] for r in rows) == Counter(r["text"] for r in odd.collect())
        by = {}
        for r in rows:
            by.setdefault(r["shard"], []).append(r["slot"])
        assert all(sorted(v) == list(range(len(v))) for v in by.values())
        sizes = [len(by.get(i, ())) for i in range(n)]
        assert max(sizes) - min(sizes) <= 1
    assert sharding.shard(none).count() == 0


def test_shuffle_is_uniform(spark):
    """Where row 0 and row 1 of two partitions go, over many seeds; a chi-square test at about one in ten thousand."""
    counts, cells = np.array([3, 2]), np.array([2, 2, 1])
    seen = Counter(tuple(sharding.matrix_row(counts, cells, 0, s)) for s in range(6000))
    from math import comb

    for row, n in seen.items():
        p = comb(2, row[0]) * comb(2, row[1]) * comb(1, row[2]) / comb(5, 3)
        assert abs(n - 6000 * p) < 4.5 * (6000 * p * (1 - p)) ** 0.5
    for s in range(50):
        assert (sharding.matrix_row(counts, cells, 0, s) + sharding.matrix_row(counts, cells, 1, s) == cells).all()


def test_large_urns():
    rng = np.random.default_rng(0)
    good, bad, n = 3_000_000_000, 5_000_000_000, 1_000_000_000
    x = np.array([sharding.draw(rng, good, bad, n) for _ in range(40)])
    mean, deviation = n * 3 / 8, (n * 3 / 8 * 5 / 8 * 7 / 8) ** 0.5
    assert abs(x.mean() - mean) < 5 * deviation / 40**0.5 and 0.6 < x.std() / deviation < 1.5
    many = sharding.draw_many(rng, np.array([good, bad, 5]), n)
    assert many.sum() == n and many[2] <= 5


@pytest.mark.parametrize("block", [7, 64, 10_000])
def test_top_k_against_brute_force(spark, block):
    rng = np.random.default_rng(1)
    v = rng.integers(-9, 9, (200, 6))
    v[50:60] = v[0]
    rows = spark.createDataFrame([(i, x.tolist(), "x") for i, x in enumerate(v)] + [(None, [1] * 6, "x"), (999, None, "x")], "vec_id long, vector array<bigint>, score string")
    got = {}
    for r in topk_search.top_k(rows, rows.where("vec_id % 20 = 0"), 5, block_rows=block, query_rows=3).orderBy("rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    for q in range(0, 200, 20):
        want = sorted(((int(v[q] @ v[i]), i) for i in range(200) if i != q), key=lambda x: (-x[0], x[1]))[:5]
        assert got[q] == want
    assert topk_search.top_k(rows.where("false"), rows).count() == 0


@pytest.mark.parametrize("block", [64, 10_000])
def test_top_k_of_repeated_ids(spark, block):
    """Ids that stand there many times, with the same vector or several, take one place of the k."""
    rng = np.random.default_rng(2)
    v = rng.integers(-9, 9, (150, 6))
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(i, v[i].tolist()) for i in range(0, 150, 3) for _ in range(12)] + [(i, v[(i + 1) % 150].tolist()) for i in range(0, 150, 7)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<bigint>")
    got = {}
    for r in topk_search.top_k(df, df.where("vec_id IN (1, 20, 40, 101)"), 5, block_rows=block).orderBy("rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    for q in (1, 20, 40, 101):
        best = {}
        for i, x in rows:
            if i != q:
                best[i] = max(best.get(i, -(10**9)), int(v[q] @ np.array(x)))
        assert got[q] == sorted(((s, i) for i, s in best.items()), key=lambda x: (-x[0], x[1]))[:5]


def test_top_k_of_huge_numbers_and_few_candidates(spark):
    rows = spark.createDataFrame([(0, [2**30, 1]), (1, [2**30, 5]), (2, [1])], "vec_id long, vector array<bigint>")
    got = topk_search.top_k(rows, rows.where("vec_id = 0")).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(1, 2**60 + 5), (2, 2**30)]


def test_quantised(spark):
    df = spark.createDataFrame([([0.5, -0.001],), ([float("nan")],), ([float("inf")],), ([None],), (None,), ([],)], "v array<float>")
    assert [r[0] for r in df.select(topk_search.quantised(F.col("v"))).collect()] == [[128, -1], None, None, None, None, []]


URLS = ["http://A.Example.com/en/7x?q#f", "https://example.com/en/8", "http://xexample.com/en/", "http://com/en/", "ftp://de.example.net/de/81", "http://example.net/de/9#x", "http://net", "nothing", None, "", "a://b://c/en/", "http://example.org?x/es/", "http://.org/es/", "http://a.org/es/", "http://com./en/", "http://" + "a." * 3000 + "com/en/" + "x" * 50_000]


def judged(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [(len(k), k, v) for k, v in rules if (h := k.split("/")[0]) and (host == h or host.endswith("." + h)) and path.startswith(k[len(h) :])]
    return (host, path, max(fits)[1], max(fits)[2]) if fits else (host, path, None, default)


def test_url_rules_against_brute_force(spark):
    from brindle.llm.queries import URL_RULES

    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS + URLS[:2])], "page_id long, url string, host string")
    for rules in (URL_RULES, [("com/", "block"), ("b.com/", "allow")], []):
        got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(df, rules).collect()}
        assert got == {i: judged(u, rules) for i, u in enumerate(URLS + URLS[:2])}
    assert url_filter.judge(df.where("false"), URL_RULES).count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(40_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("CAST(substr(key, 2) AS INT) % 37 = 0")
    cascade = url_filter.build(listed, universe)
    assert len(cascade.levels) > 2
    assert universe.where(cascade.member(F.col("key")) != (F.substring("key", 2, 9).cast("int") % 37 == 0)).count() == 0


def test_no_python_runs_in_native_operators(spark):
    for name in ("op8_fingerprints", "op10_url_filter"):
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    assert "op10_url_filter" in ORACLE_SQL


def test_fingerprint_rows(spark, odd, none):
    docs = odd.where("doc_id IS NOT NULL AND doc_id <> 7")
    rows = {r["doc_id"]: r for r in fingerprints.compare_edits(docs).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    order = sorted(texts, reverse=True)
    for a, b in zip(order, order[1:] + order[:1], strict=True):
        n = len(texts[a])
        assert rows[a]["edited"] == texts[a][: n - n // 2] + texts[b][: n // 2]
        assert rows[a]["next_fingerprint"] == rows[b]["fingerprint"]
    assert rows[2]["fingerprint"] == rows[3]["fingerprint"] != [] and rows[0]["fingerprint"] == []
    assert fingerprints.compare_edits(none).count() == 0
    assert fingerprints.compare_edits(odd).count() == odd.count()


@pytest.mark.parametrize("buckets", [1, 3, 64])
def test_next_document_across_ranges(spark, buckets):
    df = spark.range(0, 500, 3).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    ids = sorted((r[0] for r in df.collect()), reverse=True)
    got = {r["doc_id"]: r["next_text"] for r in fingerprints.with_next(df, "doc_id", "text", [], buckets).collect()}
    assert got == {a: f"t{b}" for a, b in zip(ids, ids[1:] + ids[:1], strict=True)}


def test_likeness_falls_with_edits_and_order(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in rng.integers(0, 5000, 600)]
    few, swapped, other = words[:], words[300:] + words[:300], [f"v{i}" for i in range(600)]
    few[100:105] = ["x"] * 5
    shuffled = [" ".join(words[i : i + 6]) for i in range(0, 600, 6)]
    rng.shuffle(shuffled)
    texts = [" ".join(words), " ".join(few), " ".join(swapped), " ".join(shuffled), " ".join(other), " ".join(words)]
    df = fingerprints.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    base = df.where("doc_id = 0").select(F.col("fingerprint").alias("f"))
    s = {r[0]: r[1] for r in df.join(F.broadcast(base), F.lit(True)).select("doc_id", fingerprints.likeness(F.col("fingerprint"), F.col("f"))).collect()}
    assert s[0] == s[5] == 1.0 and s[1] > 0.85 and s[4] == 0 and s[1] > s[2] > s[3] - 0.15


def test_likeness_of_short_texts_falls_with_order(spark):
    """Halves swapped, unique words: permutations give about 0.34 for 30 words and 0.43 for 80."""
    for n, most in ((30, 0.45), (80, 0.52)):
        rows = []
        for i in range(60):
            words = [f"d{i}w{j}" for j in range(n)]
            rows.append((i, " ".join(words), " ".join(words[n // 2 :] + words[: n // 2])))
        df = fingerprints.with_fingerprint(fingerprints.with_fingerprint(spark.createDataFrame(rows, "doc_id long, a string, b string"), "a", "f"), "b", "g")
        mean, bins = df.agg(F.avg(fingerprints.likeness(F.col("f"), F.col("g"))), F.min(F.size(F.array_distinct(F.transform("f", lambda x: F.shiftright(x, 32)))))).head()
        assert 0.15 < mean < most and bins == fingerprints.BINS


def test_edited_hash_of_query(spark):
    rows = QUERIES["op8_fingerprints"](spark, SMALL).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    order = sorted(texts, reverse=True)
    want = {a: hashlib.sha256((texts[a][: len(texts[a]) - len(texts[a]) // 2] + texts[b][: len(texts[a]) // 2]).encode()).hexdigest() for a, b in zip(order, order[1:] + order[:1], strict=True)}
    assert {r["doc_id"]: r["edited_sha256"] for r in rows} == want and len(rows) == len(texts)
    assert all(0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1 for r in rows)


def spark_hash(*parts):
    """Spark's xxhash64, as a signed long: each part's hash is the seed of the next."""
    seed = 42
    for x in parts:
        seed = xxhash.xxh64_intdigest(x.encode() if isinstance(x, str) else x, seed=seed)
    return seed - (1 << 64) if seed >> 63 else seed


def plain_fingerprint(text):
    """Order MinHash step by step: numbered k-mers, the two least pairs of each bin (or of the next ones), in text order."""
    units = re.findall(fingerprints.UNIT, text, re.ASCII)
    if not units:
        return []
    kmers = [spark_hash(*units[i : i + 3]) for i in range(max(1, len(units) - 2))]
    nth, pairs = Counter(), []
    for place, k in enumerate(kmers):
        short = k >> 31
        pairs.append((spark_hash((short).to_bytes(8, "little", signed=True), nth[short].to_bytes(4, "little")) >> 31, place))
        nth[short] += 1
    pairs.sort()
    least, of_bin = [], Counter()
    for pair in pairs:
        if of_bin[pair[0] >> 27] < 2:
            of_bin[pair[0] >> 27] += 1
            least.append(pair)
    out, bins = {}, [h >> 27 for h, _ in least]
    for b in range(-32, 32):
        first = next((i for i, x in enumerate(bins) if x >= b), 0)
        chosen = sorted({least[(first + j) % len(least)][1] for j in range(2)})
        out[b] = (b & 63) << 32 | spark_hash(" ".join(f"{kmers[p] & (1 << 64) - 1:X}" for p in chosen)) & 0xFFFFFFFF
    return [out[b] for b in range(-32, 32)]


def test_fingerprints_of_the_query_against_plain_order_minhash(spark, odd):
    rows = {r["doc_id"]: r for r in QUERIES["op8_fingerprints"](spark, SMALL).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    order = sorted(texts, reverse=True)
    like = lambda a, b: 1.0 if not a and not b else len(set(a) & set(b)) / 64
    for a, b in list(zip(order, order[1:] + order[:1], strict=True))[:60]:
        n = len(texts[a])
        one, edited, other = (plain_fingerprint(x) for x in (texts[a], texts[a][: n - n // 2] + texts[b][: n // 2], texts[b]))
        assert rows[a]["fingerprint"] == "".join(f"{x:010X}" for x in one) and rows[a]["edited_fingerprint"] == "".join(f"{x:010X}" for x in edited)
        assert rows[a]["near_edited"] == pytest.approx(like(one, edited)) and rows[a]["near_next"] == pytest.approx(like(one, other)) and rows[a]["n_chars"] == n
    strange = ["the the the the the the the", "x" * 5000, "中文没有空格的文字 and more", "a b", "a", "word " * 900]
    got = fingerprints.fingerprints(spark.createDataFrame(list(enumerate(strange)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {i: plain_fingerprint(x) for i, x in enumerate(strange)}


def test_a_letter_more_changes_little_of_a_long_run(spark):
    """Data without blanks is cut by its content, so an insertion leaves most units as they are."""
    import base64

    data = base64.b64encode(np.random.default_rng(9).bytes(9000)).decode()
    df = spark.createDataFrame([(data, data[:50] + "x" + data[50:])], "a string, b string")
    df = fingerprints.with_fingerprint(fingerprints.with_fingerprint(df, "a", "f"), "b", "g")
    assert df.select(fingerprints.likeness(F.col("f"), F.col("g"))).head()[0] > 0.9


def test_places_beyond_any_text():
    assert fingerprints._PLACE >= 2**31 - 1


def test_bound_stops_the_search_where_vectors_have_a_structure():
    """Vectors near a plane of few dimensions, turned at random: a few percent of the rows are scored. Without any structure nearly all are; results are right in both cases."""
    rng = np.random.default_rng(4)
    turn = np.linalg.qr(rng.normal(size=(64, 64)))[0]
    shares = {}
    for name, spread in (("structured", 0.5 ** np.arange(64)), ("even", np.ones(64))):
        v = np.floor(256 * (rng.normal(size=(6000, 64)) * spread) @ turn)
        lists, seen = topk_search.Lists(np.arange(6000), v), []
        for q in range(0, 6000, 300):
            got = lists.search(v[q], q, 5)
            scores = v @ v[q]
            assert got == sorted(((int(scores[i]), i) for i in range(6000) if i != q), key=lambda x: (-x[0], x[1]))[:5]
            seen.append(lists.seen / 6000)
        shares[name] = np.mean(seen)
    assert shares["structured"] < 0.2


def test_long_lists_are_cut_into_parts(spark, monkeypatch):
    """Beyond the words of one filter, the list is held by cascades of its parts, and membership stays exact."""
    monkeypatch.setattr(url_filter, "MOST_WORDS", 16)
    universe = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    is_listed = F.substring("key", 2, 9).cast("int") % 7 == 0
    parts = url_filter.build(universe.where(is_listed), universe)
    assert len(parts.cascades) > 1 and all(len(level.words) <= 16 for c in parts.cascades for level in c.levels[:1])
    assert universe.where(parts.member(F.col("key")) != is_listed).count() == 0


def test_judging_keeps_clashing_names_apart(spark):
    df = spark.createDataFrame([(1, "http://a.com/en/", "r", "v", "p")], "page_id long, url string, rule string, verdict string, path string")
    assert url_filter.judge(df, [("com/en/", "block")]).collect() == [(1, "a.com", "/en/", "com/en/", "block")]


def test_sharding_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op3_sharding"](spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    by = {}
    for r in rows:
        text = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 8, zlib.crc32(text), "rows", None)
        by.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(by.get(i, ())) for i in range(24)]
    assert set(by) <= set(range(24)) and max(sizes) - min(sizes) <= 1 and all(sorted(x) == list(range(len(x))) for x in by.values())
