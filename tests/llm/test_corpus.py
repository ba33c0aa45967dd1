"""Language, toxicity, near duplicates and the pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brindle.llm import graph, language_id, near_dup, toxicity
from brindle.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang", "text")
    rows = QUERIES["op7_language_id"](spark, SMALL).join(docs, "doc_id").where("held_out").select((F.col("lang") == F.col("lang_pred")).alias("ok"), F.length("text").alias("n")).collect()
    assert np.mean([r["ok"] for r in rows]) > 0.98


def test_language_mixtures(spark, odd, none):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language_id.fit(docs, F.lit(True), train_rows=100)
    texts = {g: docs.where(f"lang = '{g}' AND n_chars > 1500").orderBy("doc_id").head()["text"][:1500] for g in ("en", "de")}
    both = spark.createDataFrame([(1, texts["en"]), (2, texts["en"] + " " + texts["de"]), (3, "123 !"), (4, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in language_id.identify(both, model).collect()}
    assert got[1]["languages"] == ["en"] and sorted(got[2]["languages"]) == ["de", "en"] and 0.3 < got[2]["score"] < 0.7
    assert got[3]["lang_pred"] == got[4]["lang_pred"] == "und" and got[3]["score"] == 0
    assert language_id.identify(odd, model).count() == odd.count() and language_id.identify(none, model).count() == 0
    assert language_id.identify(odd, language_id.fit(none, F.lit(True))).where("lang_pred <> 'und'").count() == 0


def test_many_languages(spark):
    """More labels than any table holds by chance: every one is learned."""
    rng = random.Random(2)
    words = lambda i: [f"{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + rng.randrange(26))}{i % 7}q" for _ in range(4)]
    rows = [(i * 3 + j, f"l{i}", " ".join(rng.choices(w, k=30))) for i in range(600) for w in [words(i)] for j in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = language_id.fit(docs, F.lit(True))
    assert len(model.languages) == 600
    assert language_id.identify(docs.where("doc_id % 97 = 0"), model, keep=("lang", "score")).where("lang = lang_pred").count() >= 15


def test_long_text_is_counted_in_chunks():
    text = "abcdefg " * 20_000
    h, n = language_id.trigrams(text)
    assert len(h) <= 8 and n.sum() == len(text) - 1


def test_toxicity_held_out(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = QUERIES["op9_toxicity"](spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").toPandas()
    rank = rows["score"].rank()
    bad = rows["toxic"] == 1
    auc = (rank[bad].sum() - bad.sum() * (bad.sum() + 1) / 2) / (bad.sum() * (~bad).sum())
    assert auc > 0.88 and rows[~bad]["predicted"].mean() < 0.05 and rows["score"].between(0, 1).all()


def test_toxic_words_of_a_minority(spark):
    """Words that each stand in under a fiftieth of all toxic training texts, since they are of a rarer language, are learned."""
    rng = random.Random(8)

    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    usual, marks = ({name: [letters(9) for _ in range(n)] for name in ("aba", "oco")} for n in (400, 12))

    def text(name, bad):
        return " ".join(rng.sample(rng.choices(usual[name], k=60) + rng.sample(marks[name] if bad else usual[name], 4), 64))

    rows = [(text("aba", i % 4 == 0), int(i % 4 == 0)) for i in range(2400)] + [(text("oco", i % 4 == 0), int(i % 4 == 0)) for i in range(100)]
    model = toxicity.train(rows)
    texts = [text("oco", True) for _ in range(20)], [text("oco", False) for _ in range(40)]
    recall, wrong = (np.mean([toxicity.score(model, t) >= 0.5 for t in x]) for x in texts)
    assert recall >= 0.8 and wrong <= 0.05


def _labelled(n=90):
    rng = random.Random(3)
    usual, marks = [f"w{i}ord" for i in range(300)], [f"bad{i}ness" for i in range(8)]
    return [(" ".join(rng.sample(usual, 40) + (rng.sample(marks, 3) if i % 3 == 0 else []) + [f"unique{i}x"]), int(i % 3 == 0)) for i in range(n)]


def test_each_dictionary_is_trained_on_its_own_class(monkeypatch):
    """zstandard's trainer gets windows of ordinary texts for the one, and only parts of toxic texts for the other; and it finds the words that mark them."""
    seen, real = [], toxicity.zstandard.train_dictionary
    monkeypatch.setattr(toxicity.zstandard, "train_dictionary", lambda size, parts, **how: seen.append((size, list(parts))) or real(size, parts, **how))
    rows = [(toxicity.windows(t), y) for t, y in _labelled()]
    ordinary, toxic, chosen = toxicity.dictionaries(rows)
    own = [b" ".join(x for w, y in rows if y == label for x in w) for label in (0, 1)]
    assert {size for size, _ in seen} == {toxicity.ORDINARY, toxicity.FIRST, toxicity.TOXIC}
    for size, parts in seen:
        assert parts and all(x.strip() in own[size != toxicity.ORDINARY] for x in parts)
    assert sorted(x for w, y in rows if not y for x in w) == sorted(next(parts for size, parts in seen if size == toxicity.ORDINARY))
    assert len(chosen) >= 6 and all(x.startswith(b" bad") for x in chosen) and all(x in toxic for x in chosen) and b"bad" not in ordinary


def test_score_against_a_plain_computation():
    """Window lengths by compressors made anew, their differences counted and weighed by hand."""
    import math

    import zstandard

    model = toxicity.train(_labelled())
    pack = lambda d: zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=zstandard.ZstdCompressionParameters(**toxicity.PARAMETERS))
    for text in [t for t, _ in _labelled(12)] + ["", "one", "bad1ness bad2ness " * 40, "x" * 9000]:
        parts = toxicity.windows(text)
        assert b"".join(parts).split() == text.lower().encode().split()
        gain = [len(pack(model.ordinary).compress(p)) - len(pack(model.ordinary + model.toxic).compress(p)) for p in parts]
        x = [max([0, *gain]), *(math.log1p(sum(g >= t for g in gain)) for t in toxicity.THRESHOLDS), math.log1p(len(gain))]
        at = model.weights[0] + sum(a * b for a, b in zip(model.weights[1:], x, strict=True))
        assert abs(toxicity.score(model, text) - 1 / (1 + math.exp(-max(-30, min(30, at))))) < 1e-9
    rows = _labelled(360)
    model = toxicity.train(rows[:300])
    assert np.mean([(toxicity.score(model, t) > 0.5) == y for t, y in rows[300:]]) > 0.9


def test_near_copies_of_one_label_count_once():
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(text, 0), (text + " end", 0), (text + " other", 1), ("short", 1), ("short", 1), ("", 0)]
    assert toxicity.distinct(rows) == [("", 0), ("short", 1), (text, 0), (text + " other", 1)]


def test_toxicity_of_odd_rows(spark, odd, none):
    model = toxicity.train([(f"good words here number {i} and more of them", 0) for i in range(60)] + [(f"you worthless idiot number {i} and more of them", 1) for i in range(60)])
    rows = toxicity.score_documents(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score_documents(none, model).count() == 0
    assert toxicity.score_documents(odd, model, keep=("text", "score")).columns == ["doc_id", "text", "score", "windows"]
    assert toxicity.score(toxicity.train([]), "x") < 0.01
    assert toxicity.score(toxicity.train([("a", 0)]), "x") < 0.01
    labels = spark.createDataFrame([(2, 1), (3, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.fit(odd, labels, F.lit(True)).weights[0] > 0


@pytest.mark.parametrize("part", [3, 1 << 16])
def test_components(spark, monkeypatch, part):
    monkeypatch.setattr(graph, "PART", part)
    rng = random.Random(4)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_classes(docs):
    """Classes by every pair of distinct texts that share an element."""
    counts = np.zeros(near_dup.CELLS, np.int64)
    for _, t in docs:
        counts[np.unique(near_dup.shingles(t) & np.uint64(near_dup.CELLS - 1)).astype(np.int64)] += 1
    w = near_dup.weights_of(counts, len(docs))
    sets = [near_dup.elements(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if docs[i][1] == docs[j][1] or (len(sets[i]) and len(sets[j]) and near_dup.similarity(sets[i], sets[j], w) >= 0.8):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: least[find(i)] for i, (d, _) in enumerate(docs)}


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(3000)}"
    docs = []
    for group in range(25):
        base = [word() for _ in range(rng.randrange(60, 200))]
        for copy in range(rng.choice([1, 1, 2, 5, 12])):
            text = base[:]
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                text[rng.randrange(len(text))] = word()
            docs.append((len(docs), " ".join(text)))
    docs += [(1000 + i, " ".join(word() for _ in range(4))) for i in range(5)] + [(2000, ""), (2001, "")]
    got = {r["doc_id"]: r["class_id"] for r in near_dup.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute_classes(docs)


def test_near_duplicates_of_stars_with_a_centre_in_the_middle(spark):
    """Copies like their original and not like each other, of two originals whose ids aren't the least."""
    rng = random.Random(6)
    docs = []
    for group, (n, first) in enumerate(((60, 0), (40, 500))):
        base = [f"g{group}w{i}" for i in range(200)]
        for i in range(n + 1):
            text = base[:]
            if i != n // 2:
                for at in rng.sample(range(10, 190, 6), 3):
                    text[at] = f"new{group}x{i}x{at}"
            docs.append((first + i, " ".join(text)))
    got = {r["doc_id"]: r["class_id"] for r in near_dup.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute_classes(docs) == {d: d // 500 * 500 for d, _ in docs}


def test_pairs_across_tasks(spark):
    """One band whose rows are in every task still makes one class."""
    text = " ".join(f"w{i}" for i in range(100))
    docs = spark.createDataFrame([(i, text + f" tail{i}") for i in range(200)], "doc_id long, text string").repartition(7)
    assert near_dup.classes(docs).agg(F.min("class_id"), F.max("class_id"), F.count("*")).head() == (0, 0, 200)
    assert near_dup.keep_one(docs).collect()[0]["doc_id"] == 0


def test_heavy_keys_are_spread(spark, monkeypatch):
    """With a limit of a few rows, a text of many copies and a text that many are like are spread over tasks, and classes stay the same."""
    from brindle.llm import shared

    monkeypatch.setattr(shared, "LIGHT", 6)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    docs = [(i, " ".join(base)) for i in range(40)]
    for i in range(40, 90):
        text = base[:]
        text[rng.randrange(120)] = f"x{i}"
        docs.append((i, " ".join(text)))
    docs += [(100 + i, " ".join(f"v{i}u{j}" for j in range(50))) for i in range(10)] + [(3, " ".join(base[:60]))]
    got = near_dup.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert len(got) == len(docs) and {r["class_id"] for r in got if r["doc_id"] < 90} == {0} and {r["class_id"] for r in got if r["doc_id"] >= 100} == {100 + i for i in range(10)}
    heavy = shared.heavy_keys(spark.createDataFrame([(1, 13), (2, 6), (None, 50)], "k long, n long"), 69)
    assert heavy == [(1, 3)]
    rows, one = spark.createDataFrame([(1, i) for i in range(13)] + [(2, 0), (None, 1), (4, 1)], "k long, v long"), spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, s string")
    assert sorted(tuple(r) for r in shared.join_spread(rows, one, "k", heavy).collect()) == [*((1, i, "a") for i in range(13)), (2, 0, "b")]


def test_near_duplicates_of_odd_rows(spark, odd, none):
    rows = near_dup.classes(odd).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r["class_id"] for r in rows}
    assert by[0] == by[1] == 0 and by[2] == by[3] == 2 and by[7] == 7 and by[None] is None
    kept = near_dup.keep_one(odd).collect()
    assert sorted(r["doc_id"] or -1 for r in kept) == sorted([-1, -1, 2, 4, 5, 6, 7, 9]) and set(kept[0].asDict()) == set(odd.columns)
    assert near_dup.classes(none).count() == 0 and near_dup.keep_one(none).count() == 0


def test_samples_collide_as_often_as_texts_are_alike():
    """The share of common samples is the weighted Jaccard similarity, up to what 64 x 40 draws allow."""
    rng = np.random.default_rng(6)
    weights = rng.uniform(near_dup.LEAST_WEIGHT, 1, near_dup.CELLS).astype(np.float32)
    sampler, found, wanted = near_dup.Sampler(weights), [], []
    for i in range(40):
        words = [f"{i}w{j}" for j in range(300)]
        other = words[:]
        for at in rng.choice(300, 8, replace=False):
            other[at] = f"new{at}"
        a, b = " ".join(words), " ".join(other)
        found.append((sampler.samples(a) == sampler.samples(b)).mean())
        wanted.append(near_dup.similarity(near_dup.elements(a), near_dup.elements(b), weights))
    assert abs(np.mean(found) - np.mean(wanted)) < 0.03


def test_words_of_long_texts_are_those_of_their_chunks(monkeypatch):
    text = " ".join(f"Wörd{i}, {i}" for i in range(4000)) + "  --  " + "x" * 3000
    whole = near_dup.words(text)
    monkeypatch.setattr(near_dup, "_CHUNK", 1000)
    assert (near_dup.words(text) == whole).all() and len(whole) == 8001
    assert (near_dup.words("Don't  STOP!") == near_dup.words("dont stop -")).all() and len(near_dup.words(" -- ")) == 0


def test_recall_of_near_duplicates_on_a_table(spark):
    """Of all pairs of documents that are alike, found by comparing every pair that has a shingle in common: those that are in one class. By the operator's weights, and by plain Jaccard similarity, of which the weights lose a little."""
    docs = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {r["doc_id"]: r["class_id"] for r in near_dup.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    counts = np.zeros(near_dup.CELLS, np.int64)
    sets, by = {}, {}
    for d, t in docs:
        counts[np.unique(near_dup.shingles(t) & np.uint64(near_dup.CELLS - 1)).astype(np.int64)] += 1
        sets[d] = near_dup.elements(t)
        for x in sets[d].tolist():
            by.setdefault(x, []).append(d)
    weights, pairs = near_dup.weights_of(counts, len(docs)), {(a, b) for ids in by.values() for i, b in enumerate(ids) for a in ids[:i]}
    ones = np.ones_like(weights)
    for w, least in ((weights, 0.999), (ones, 0.95)):
        alike = [(a, b) for a, b in pairs if near_dup.similarity(sets[a], sets[b], w) >= 0.8]
        assert len(alike) > 100 and np.mean([got[a] == got[b] for a, b in alike]) >= least


def test_frequencies_add_up_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "_FAN", 3)
    docs = spark.createDataFrame([(f"one two three four five {i}",) for i in range(50)], "text string").repartition(11)
    counts, n = near_dup.frequencies(docs)
    h = near_dup.shingles("one two three four five") & np.uint64(near_dup.CELLS - 1)
    assert n == 50 and counts[int(h[0])] >= 50 and counts.sum() == 100


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    folder, sizes = {}, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        folder[name] = docs = spark.createDataFrame(docs.collect(), docs.schema)
        sizes.append(docs.count())
    assert sizes[1] >= 0.98 * sizes[0] and sizes[2] >= 0.85 * sizes[1] and sizes[2] > sizes[3] >= 0.8 * sizes[2]
    labels = near_dup.classes(folder["near_dup"])
    assert labels.where("doc_id <> class_id").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).select("doc_id").distinct().count() == sizes[3]


def test_pipeline_stages_of_odd_rows(spark, odd, none):
    """Nulls, empty, long and repeated texts, a null id, and columns named like results: every stage but the last returns some of the rows, whole."""
    before = [tuple(r) for r in odd.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, odd, SMALL)
        assert kept.columns == odd.columns, name
        rows = [tuple(r) for r in kept.collect()]
        assert set(rows) <= set(before) and len(rows) <= len(before), name
        assert stage(spark, none, SMALL).count() == 0, name
    pieces = corpus_pipeline.pack(spark, odd, SMALL).collect()
    assert sum(1 for r in pieces if r["start"] == 0) == len(before) and corpus_pipeline.pack(spark, none, SMALL).count() == 0


def test_language_stage_rejects_what_is_in_no_language(spark):
    rows = [(i, f"{w} " * 20, "en" if i % 2 else "de", "s") for i, w in enumerate(["the house and the garden", "das haus und der garten"] * 30)]
    odd = [(100, None, None, "s"), (101, "123 456 !!", "en", "s"), (102, "zxqv kjwz qqxz " * 9, None, "s")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, source string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.identify_language(spark, docs, SMALL).collect()) == list(range(60))


def test_pipeline_against_its_parts(spark):
    """The documents of the last stage are those that every operator, applied by hand and by brute force, keeps."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    model = language_id.fit(docs, corpus_pipeline.id_class(4) != 2)
    first = {r["doc_id"] for r in language_id.identify(docs, model).collect() if r["lang_pred"] != "und" and r["known"] >= corpus_pipeline.LEAST_KNOWN}
    scorer = toxicity.fit(docs.where(F.col("doc_id").isin(sorted(first))), spark.read.parquet(f"{folder}/labels.parquet"), corpus_pipeline.id_class(5) != 0)
    second = sorted(d for d in first if toxicity.score(scorer, texts[d]) < 0.5)
    classes = brute_classes([(d, texts[d]) for d in second])
    third = {d for d in second if classes[d] == d}
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in rows} == third and 0 < len(third) < len(second) <= len(first) <= len(texts)
    whole = {}
    for r in rows:
        whole[r["doc_id"]] = whole.get(r["doc_id"], 0) + r["length"]
        assert r["length"] * 4 == len(r["ids"])
    assert all(whole[r["doc_id"]] == r["doc_tokens"] for r in rows)


@pytest.mark.parametrize("texts", [16, 512])
def test_no_link_is_lost_in_large_bands(spark, monkeypatch, texts):
    """Some pairs of texts that are alike, amid many that share most of their bands with both and are like none; in one block and in many, of several cells."""
    monkeypatch.setattr(near_dup, "TEXTS", texts, raising=False)
    part = lambda name, n: " ".join(f"{name}x{i}" for i in range(n))
    paired = lambda i: i % 25 == 0  # noqa: E731  with the one 250 further on
    docs = [(i, f"{part('core', 850)} {part(f'pair{i % 250}', 20)} {part(f'own{i}', 70)}" if paired(i) else f"{part('core', 850)} {part(f'own{i}', 95 + (i % 3) ** 9)}") for i in range(500)]
    got = {r["doc_id"]: r["class_id"] for r in near_dup.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute_classes(docs) == {i: i % 250 if paired(i) else i for i, _ in docs}


def test_links_of_a_band_against_every_pair():
    rng, weights = np.random.default_rng(4), np.random.default_rng(5).uniform(near_dup.LEAST_WEIGHT, 1, near_dup.CELLS).astype(np.float32)
    core, band = rng.integers(0, 1 << 32, 400, np.uint32), 50
    for n, sides in ((40, (2,)), (60, (0, 1)), (5, (2,))):
        sets = [np.unique(np.concatenate([core[: rng.integers(300, 400)], rng.integers(0, 1 << 32, rng.integers(0, 60), np.uint32)])) for _ in range(n)]
        rows = [(sides[i % len(sides)], i // 2, [band, *({10, 60, 70} if i % 7 == 0 else set())], float(weights[s & np.uint32(near_dup.CELLS - 1)].sum(dtype=np.float64)), s.tobytes()) for i, s in enumerate(sets)]
        tie = lambda pairs: sorted({frozenset(x) for x in _joined(pairs)}, key=min)
        meets = lambda i, j: i // 2 != j // 2 and (len(sides) == 1 or i % 2 != j % 2) and not (i % 7 == j % 7 == 0)
        wanted = [(i // 2, j // 2) for j in range(n) for i in range(j) if meets(i, j) and near_dup.similarity(sets[i], sets[j], weights) >= 0.8]
        got = near_dup.links_within(band, rows, weights, 0.8)
        assert wanted and tie(got) == tie(wanted) and len(got) < n


def _joined(pairs):
    groups = []
    for pair in pairs:
        hit = [g for g in groups if g & set(pair)]
        groups = [g for g in groups if g not in hit] + [set(pair).union(*hit)]
    return groups
