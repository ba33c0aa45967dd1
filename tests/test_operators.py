import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.functions import bind, geometry, stats, text
from brindle.operators import ledger, quantiles, ranking, raster, schedule, selection, spatial
from brindle.sources import documents, jsonl, ply, writers
from brindle.streaming import ledger as streams


def one(spark, *columns):
    return spark.range(1).select(*columns).head()


def test_mcnemar_and_wilson(spark):
    lit = lambda *v: [F.lit(x).cast("long") for x in v]
    r = one(spark, stats.mcnemar_exact(*lit(1, 3)), stats.mcnemar_exact(*lit(2400, 2600)), stats.mcnemar_exact(*lit(0, 0)), *stats.wilson(*lit(8, 10)), *stats.wilson(*lit(0, 0)))
    assert r[0] == pytest.approx(0.625) and r[1] == pytest.approx(0.0048836497, rel=1e-6) and r[2] is None
    assert r[3] == pytest.approx(0.490157, abs=1e-6) and r[4] == pytest.approx(0.943317, abs=1e-4) and r[5] is None


def test_summary_of_nothing_and_one(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, 1.0), (3, 2.0)], "k int, x double")
    by = {r["k"]: r for r in quantiles.summary(df, ["k"], F.col("x")).collect()}
    assert by[1]["count"] == 0 and by[1]["mean"] is None
    assert by[2]["ci_low"] is None and by[2]["p90"] == 5.0
    assert by[3]["ci_high"] - by[3]["mean"] == pytest.approx(1.96 * math.sqrt(0.5) / math.sqrt(2))


def test_natural_order_and_names(spark):
    df = spark.createDataFrame([("frame_00010", 0), ("frame_2b", 1), ("Frame_1", 2), ("frame_2", 3)], "n string, i int")
    assert [r["n"] for r in ranking.natural_order(df, "n", "i").orderBy("position").collect()] == ["Frame_1", "frame_2", "frame_2b", "frame_00010"]
    r = one(spark, text.slug(F.lit("..a b/c_")), text.rebase(F.lit("/x/y"), "/x", "/z"), text.rebase(F.lit("/xy"), "/x", "/z"), *[text.is_safe_relative(F.lit(p)) for p in ("a/../b", "a/../../b", "/a", "")])
    assert list(r) == ["a_b_c", "/z/y", "/xy", True, False, False, False]


def test_rank_all_has_no_gaps(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    got = ranking.rank_all(df, [F.col("v").desc()]).orderBy("rank").collect()
    assert [(r["rank"], r["v"]) for r in got] == [(i + 1, 999 - i) for i in range(1000)]


def test_nan_policy(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (3.0,)], "r double")
    assert ranking.drop_excess(df, F.col("r"), 10, True).count() == 2
    assert ranking.drop_excess(df, F.col("r"), 10, False).count() == 1


@pytest.mark.parametrize(
    ("scores", "k", "budget", "attempted", "reason"),
    [
        ([None, 0.9, 0.2, 0.8, 0.95], 2, 10, 4, "threshold_complete"),
        ([None, 0.9, 0.2, 0.1, 0.95], 2, 3, 4, "score_budget_exhausted"),
        ([None, 0.9, 0.2], 2, 10, 3, "candidate_pool_exhausted"),
    ],
)
def test_early_stop(spark, scores, k, budget, attempted, reason):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "i int, s double")
    tried = selection.attempted(df, [F.col("i")], F.col("s").isNotNull(), F.col("s") > 0.65, k, budget)
    r = selection.outcome(tried, k, budget).head()
    assert (r["attempted"], r["reason"]) == (attempted, reason)


def test_apportion_golden(spark):
    df = spark.createDataFrame([(0, 0.45), (1, 1.95), (2, 2.0)], "i int, w double")
    assert [r["share"] for r in selection.apportion(df, [], "w", "i", 30).orderBy("i").collect()] == [3, 13, 14]


def test_latest_and_reconcile(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "y")], "k string, n int, v string")
    assert {tuple(r) for r in ledger.latest(df, ["k"], ["n"]).collect()} == {("a", 2, None), ("b", 1, "y")}
    other = spark.createDataFrame([("b",), ("c",)], "k string")
    assert {tuple(r) for r in ledger.reconcile(df, other, ["k"]).collect()} == {("a", "missing"), ("c", "unexpected")}
    assert ledger.reconcile(df, df, ["k"]).count() == 0


def test_null_rules_are_broken(spark):
    df = spark.createDataFrame([(1, None), (2, True)], "i int, b boolean")
    assert [tuple(r) for r in ledger.violations(df, {"b": F.col("b")}, ["i"]).collect()] == [(1, "b")]


def cloud(spark, n=300, seed=0):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, 3)) * np.array([1, 1, 5.0])
    return v, spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(v)], "i long, x double, y double, z double")


def test_neighbours_against_brute_force(spark):
    v, df = cloud(spark)
    d = np.linalg.norm(v[:, None] - v[None], axis=2)
    np.fill_diagonal(d, np.inf)
    got = {(r["i"], r["rank"]): r["distance"] for r in spatial.nearest(df, "i", 3).collect()}
    want = np.sort(d, axis=1)[:, :3]
    assert len(got) == 900 and all(got[i, k + 1] == pytest.approx(want[i, k]) for i in range(300) for k in range(3))
    pairs = {(r["a"], r["b"]) for r in spatial.within(df, "i", 0.4).collect()}
    assert pairs == {(i, j) for i in range(300) for j in range(i + 1, 300) if d[i, j] < 0.4}


def test_separation_against_a_loop(spark):
    v, df = cloud(spark, 120, 1)
    taken = []
    for i, p in enumerate(v):
        if all(np.linalg.norm(p - v[j]) >= 0.8 for j in taken):
            taken.append(i)
    assert sorted(r["i"] for r in spatial.separated(df, [], "i", 0.8).collect()) == taken


def test_background_golden(spark):
    rows = [(0, x, y, y >= 2) for x in range(10) for y in range(10)] + [(1, x, y, True) for x in range(10) for y in range(10)]
    df = spark.createDataFrame(rows, "image int, px int, py int, covered boolean")
    assert {tuple(r) for r in raster.largest_background(df, ["image"], 10, 10).collect()} == {(0, 0.2), (1, 0.0)}
    assert {r["coverage"] for r in raster.coverage(df, ["image"], F.col("covered").cast("double"), 0.5).collect()} == {0.8, 1.0}


def test_rotations(spark):
    q = [F.lit(x) for x in (0.5, -0.1, 0.7, 0.2)]
    m = geometry.quaternion_rows(*q)
    df = bind(spark.range(1), **{f"m{i}{j}": m[i][j] for i in range(3) for j in range(3)})
    m = tuple(tuple(F.col(f"m{i}{j}") for j in range(3)) for i in range(3))
    inverse, shift = geometry.rigid_inverse(m, (F.lit(1.0), F.lit(2.0), F.lit(3.0)))
    back = geometry.apply(inverse, (F.lit(1.0), F.lit(2.0), F.lit(3.0)))
    r = df.select(geometry.orthonormal_error(m), geometry.determinant(m), *geometry.quaternion_of(m), *[a + b for a, b in zip(back, shift, strict=True)]).head()
    n = math.sqrt(0.25 + 0.01 + 0.49 + 0.04)
    assert r[0] < 1e-12 and r[1] == pytest.approx(1) and list(r[2:6]) == pytest.approx([x / n for x in (0.5, -0.1, 0.7, 0.2)]) and list(r[6:]) == pytest.approx([0, 0, 0])


def test_schedule_helpers(spark):
    numbers = lambda *v: F.array(*map(F.lit, v))
    r = one(spark, schedule.guarded(numbers(0.0, 1.0, 1.0, 0.5), numbers(0.0, 0.1, 0.61, 0.6)), schedule.first_fitting(lambda s: s < 0.3), schedule.first_fitting(lambda s: s < 0))
    assert r[0] == pytest.approx([0.0, 0.6, 0.64, 0.34]) and list(r[1:]) == [0.25, 0.0]


def test_zoom_and_crossfade_golden(spark):
    """Even steps with exact ends; a crossfade goes from 0 to 1 and takes no frame if it is hard or one frame long."""
    lit = lambda v: F.lit(v)
    r = one(spark, *[schedule.zoom(lit(1.0), lit(2.0), lit(t)) for t in (0.0, 0.5, 1.0)], *[schedule.crossfade(lit(i), lit(1), 5) for i in (0, 2, 4, 5)], schedule.crossfade(lit(0), lit(0), 5), schedule.crossfade(lit(0), lit(1), 1), schedule.crossfade(lit(0), lit(1), 5, hard=True))
    assert list(r) == [1.0, 1.5, 2.0, 0.0, 0.5, 1.0, 1.0, 1.0, 1.0, 1.0]
    frames = spark.createDataFrame([(0, 1.0), (1, 1.5), (2, 1.5), (3, 1.4)], "frame_index int, zoom double")
    assert [x["frame_index"] for x in schedule.not_rising(frames).orderBy("frame_index").collect()] == [2, 3]


def test_exposure_jump_golden(spark):
    """Nothing before the jump's frame, then a ramp over the frames of the transition or those that are left."""
    def progress(i, n=10, strength=0.5, position=0.5, transition=4):
        return schedule.jump_progress(F.lit(i), F.lit(n), F.lit(strength), F.lit(position), transition)

    r = one(spark, *[progress(i) for i in (3, 4, 5, 7, 9)], progress(9, position=1.0), progress(9, strength=0.0), progress(4, transition=0), progress(3, transition=0))
    assert list(r) == [0.0, 0.25, 0.5, 1.0, 1.0, 1.0, 0.0, 1.0, 0.0]
    state = schedule.jump_state(F.lit(0.5), F.lit(-0.5), 2.0, F.lit(0.1), 0.4)
    r = one(spark, *state.values())
    assert r[0] == -1.0 and r[1] == -0.5 and r[2] == pytest.approx(2**-0.5) and r[3] is True and r[4] == pytest.approx(0.1 * 0.8)


def test_development_adds_black_and_clips(spark):
    from brindle.functions import colour

    r = one(spark, *colour.develop((F.lit(0.2), F.lit(-0.5), F.lit(3.0)), black=0.1, soft=False), *colour.develop((F.lit(0.2),) * 3, gain=2.0), colour.falloff(F.lit(0), F.lit(0), 5, 5, 0.5), colour.falloff(F.lit(2), F.lit(2), 5, 5, 0.5), colour.finish(F.lit(4.0), 2.2, F.lit(0.5), F.lit(0.0)))
    assert list(r[:3]) == pytest.approx([0.3, 0.0, 1.0]) and list(r[3:6]) == pytest.approx([0.4] * 3) and list(r[6:]) == pytest.approx([0.5, 1.0, 0.5])


def test_names_and_seeds_golden(spark):
    import hashlib

    names = [("scene", "cam"), ('a|b"c\\d', "x\ny\x01\x1fü"), ("a", "b|c"), ("a|b", "c")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(names)], "i int, a string, b string")
    got = [int(r[0]) for r in df.orderBy("i").select(text.seed64(F.lit(42), F.col("a"), F.col("b"))).collect()]
    assert got == [int.from_bytes(hashlib.sha256(json.dumps([42, a, b], ensure_ascii=False).encode()).digest()[:8], "big") for a, b in names] and len(set(got)) == 4
    assert list(one(spark, text.label("position_", F.lit(12345), 4), text.label("position_", F.lit(7), 4))) == ["position_12345", "position_0007"]


def test_clipping_planes_golden(spark):
    near, far = geometry.clip_planes(F.lit(2.0), 0.01, 0.001, 4.0)
    _, behind = geometry.clip_planes(F.lit(2.0), 0.01, 0.001, 4.0, F.lit(3.0), F.lit(10.0))
    assert list(one(spark, near, far, behind)) == [0.01, 8.0, 16.0]


def test_stop_at_the_last_row_with_the_last_of_the_budget(spark):
    """Where pool and budget end on the same row, the pool's end is the reason."""
    df = spark.createDataFrame([(i, 0.1) for i in range(3)], "i int, s double")
    tried = selection.attempted(df, [F.col("i")], F.col("s").isNotNull(), F.col("s") > 0.65, 2, 3)
    assert selection.outcome(tried, 2, 3, pool=df).head()["reason"] == "candidate_pool_exhausted"
    assert selection.outcome(tried, 2, 3, pool=df.union(df)).head()["reason"] == "score_budget_exhausted"


@pytest.mark.parametrize("ranges", [4, 256])
def test_quantiles_against_numpy(spark, monkeypatch, ranges):
    """Ties, nulls, NaN, empty and single groups, and a group key that is null; no task holds a percentile of raw values."""
    monkeypatch.setattr(quantiles, "RANGES", ranges)
    rng = np.random.default_rng(8)
    rows = [("a", float(v), float(v % 3)) for v in rng.integers(0, 40, 500)] + [(None, float(v), None) for v in rng.normal(size=301)] + [("one", 5.0, 1.0), ("none", None, float("nan"))]
    df = spark.createDataFrame(rows, "k string, x double, y double").repartition(3)
    wanted = {"low": (F.col("x"), 0.0), "q": (F.col("x"), 0.37), "mid": (F.col("x"), 0.5), "high": (F.col("x"), 1.0), "other": (F.col("y"), 0.9)}
    out = quantiles.with_quantiles(df.groupBy("k").agg(F.count("x").alias("n")), df, ["k"], wanted)
    assert " percentile(" not in out._jdf.queryExecution().optimizedPlan().toString()
    for r in out.collect():
        x = [v for k, v, _ in rows if k == r["k"] and v is not None]
        y = [v for k, _, v in rows if k == r["k"] and v is not None and v == v]
        want = [float(np.quantile(x, p)) if x else None for p in (0, 0.37, 0.5, 1)] + [float(np.quantile(y, 0.9)) if y else None]
        assert [r["low"], r["q"], r["mid"], r["high"], r["other"]] == [v if v is None else pytest.approx(v) for v in want], r["k"]


def test_robust_bounds_against_numpy(spark):
    """With scales that widen the box, and for so few points that their quantiles enclose none."""
    rng = np.random.default_rng(3)
    p, s = rng.normal(size=(400, 3)), np.exp(rng.normal(size=(400, 3)))
    df = spark.createDataFrame([(*map(float, a), *map(float, b)) for a, b in zip(p, s, strict=True)], "x double, y double, z double, sx double, sy double, sz double")
    r = spatial.robust_bounds(df, 0.05, 0.95, tuple(F.col(f"s{c}") for c in "xyz"), 2.0, 0.8).head()
    low, high = np.quantile(p, 0.05, axis=0), np.quantile(p, 0.95, axis=0)
    inside = ((p >= low) & (p <= high)).all(1)
    cap = np.quantile(s[inside], 0.8, axis=0)
    reach, centre = 2 * np.minimum(s[inside], cap), np.median(p[inside], axis=0)
    box = np.quantile(p[inside] - reach, 0.05, axis=0), np.quantile(p[inside] + reach, 0.95, axis=0)
    radius = np.linalg.norm(np.maximum(abs(box[0] - centre), abs(box[1] - centre)))
    assert r["kept"] == inside.sum() and [r[f"{c}_cap"] for c in "xyz"] == pytest.approx(cap) and [r[f"{c}_min"] for c in "xyz"] == pytest.approx(box[0]) and [r[f"{c}_max"] for c in "xyz"] == pytest.approx(box[1]) and r["radius"] == pytest.approx(radius)
    few = spark.createDataFrame([(0.0, 2.0, 4.0), (1.0, 0.0, 2.0), (2.0, 1.0, 0.0)], "x double, y double, z double")
    r = spatial.robust_bounds(few).head()
    assert (r["kept"], r["x_low"], r["x_high"], r["z_high"]) == (3, 0.0, 2.0, 4.0)


def test_structural_loss_of_images():
    from brindle.functions import numeric

    rng = np.random.default_rng(1)
    image = rng.random((24, 32, 3))
    features = numeric.structural_features(image)
    same = numeric.structural_loss(image, features, 1.0, 1.0, 1.0)
    brighter = numeric.structural_loss(np.clip(image * 0.6 + 0.1, 0, 1), features, 1.0, 1.0, 1.0)
    other = numeric.structural_loss(rng.random((24, 32, 3)), features, 0.2, 0.3, 0.5)
    assert same["weighted_total"] == pytest.approx(0, abs=1e-9) and brighter["weighted_total"] < 0.05 < 0.3 < other["one_minus_ssim"]
    assert other["weighted_total"] == pytest.approx(0.2 * other["grayscale"] + 0.3 * other["gradient"] + 0.5 * other["one_minus_ssim"])
    flat = np.full((20, 20), 0.5)
    assert numeric.ssim(flat, flat) == pytest.approx(1) and np.allclose(numeric.blurred(flat, 1.5, 11), 0.5)


def test_bars_and_middle_parts():
    """Dark and bright bars go, a quarter from each side at most; even grey stays."""
    from brindle.functions import numeric

    image = np.random.default_rng(0).uniform(50, 200, (40, 60))
    barred = image.copy()
    barred[:5], barred[-3:], barred[:, :30] = 2, 2, 3
    assert numeric.trimmed(barred)[1] == (15, 5, 45, 32) and numeric.trimmed(image)[1] == (0, 0, 60, 40)
    image[:5] = 128
    assert numeric.trimmed(image)[1] == (0, 0, 60, 40)
    assert numeric.centre_cut(200, 100, 1, 1) == (50, 0, 100, 100) and numeric.centre_cut(100, 200, 2, 1) == (0, 75, 100, 50) and numeric.centre_cut(4, 2, 2, 1) == (0, 0, 4, 2)


def test_composed_rotation(spark):
    a, b = ([0.9, 0.1, -0.3, 0.2], [0.2, -0.5, 0.1, 0.8])
    turn = lambda q: np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)] for w, x, y, z in [np.array(q) / np.linalg.norm(q)]] + [[2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)] for w, x, y, z in [np.array(q) / np.linalg.norm(q)]] + [[2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)] for w, x, y, z in [np.array(q) / np.linalg.norm(q)]])
    r = one(spark, *geometry.composed(tuple(map(F.lit, a)), tuple(map(F.lit, b))))
    assert np.allclose(turn(list(r)), turn(a) @ turn(b)) and np.linalg.norm(list(r)) == pytest.approx(1)


ENTRY = "status string, candidate_index long, score double"


def test_json_lines_modes(spark, tmp_path):
    good, path = [{"status": "ok", "candidate_index": i, "score": i / 10} for i in range(3)], tmp_path / "a.jsonl"
    path.write_text("".join(json.dumps(x) + "\n" for x in good) + '{"status": "coverage_rej')
    assert jsonl.read(spark, str(path), ENTRY).count() == 3
    assert {r["problem"] for r in jsonl.problems(spark, str(path), ENTRY, ["candidate_index"], {"status": ["ok"]}).collect()} == {"torn tail"}
    assert documents.repair_tail(str(path)) == 24 and path.read_text().endswith("}\n")
    path.write_text(json.dumps(good[0]) + "\n\n" + json.dumps(good[0] | {"score": 0.9}) + "\n" + json.dumps(good[1] | {"status": "odd"}) + "\n")
    lenient = jsonl.read_lenient(spark, str(path), ENTRY, ["candidate_index"], F.col("status").isin("ok")).collect()
    assert [r["score"] for r in lenient] == [0.9]
    found = sorted(r["problem"] for r in jsonl.problems(spark, str(path), ENTRY, ["candidate_index"], {"status": ["ok"]}).collect())
    assert found == ["blank", "duplicate key", "duplicate key", "unknown status"]
    with pytest.raises(Exception, match="bad line"):
        jsonl.read(spark, str(path), ENTRY).collect()
    path.write_text("broken\n" + json.dumps(good[0]))
    with pytest.raises(ValueError):
        documents.repair_tail(str(path))


def test_ply_round_trip(spark, tmp_path):
    rows = np.array([(i, i / 2, 200 + i) for i in range(10)], dtype=[("x", "<f4"), ("opacity", "<f8"), ("red", "<u1")])
    head = b"ply\nformat binary_little_endian 1.0\nelement vertex 10\nproperty float x\nproperty double opacity\nproperty uchar red\nend_header\n"
    (tmp_path / "p.ply").write_bytes(head + rows.tobytes())
    spark.dataSource.register(ply.PlySource)
    df = spark.read.format("ply").option("path", str(tmp_path / "p.ply")).option("rows_per_partition", 4).load()
    assert df.rdd.getNumPartitions() == 3
    assert sorted(tuple(r) for r in df.collect()) == [(float(i), i / 2, 200 + i) for i in range(10)]
    assert ply.harmonics_degree([f"f_rest_{i}" for i in range(45)]) == 3 and ply.harmonics_degree([]) == 0
    with pytest.raises(ValueError):
        ply.harmonics_degree(["f_rest_1"])


def test_camera_dialects(spark, tmp_path):
    flat = {"id": 3, "img_name": "a", "width": 10, "height": 20, "position": [0, 0, 1], "rotation": [[1, 0, 0], [0, 1, 0], [0, 0, 1]], "fx": 5, "fy": 6}
    nested = {"image_relative_path": "b", "camera": {"position": [1, 2, 3], "camera_to_world": [[1, 0, 0, 1], [0, 1, 0, 2], [0, 0, 1, 3], [0, 0, 0, 1]]}, "intrinsics": {"width": 4, "height": 4, "fx": 1, "fy": 1, "cx": 2.5, "cy": 2}}
    for name, doc in (("list", [flat, nested]), ("object", {"cameras": [flat, nested]})):
        (tmp_path / name).write_text(json.dumps(doc))
        a, b = documents.cameras(spark, str(tmp_path / name)).orderBy("source_index").collect()
        assert (a["id"], a["cx"], b["name"], b["cx"], b["rotation"][2]) == ("3", 5.0, "b", 2.5, [0.0, 0.0, 1.0])
    (tmp_path / "single").write_text(json.dumps(flat))
    assert documents.cameras(spark, str(tmp_path / "single")).count() == 1


def test_small_parsers():
    assert documents.last_object('x {"a": {"b": 1}} y {bad} {"c": 2} z') == '{"c": 2}'
    assert documents.last_object(None) is None and documents.last_object("none") is None
    assert documents.literal_flag("Namespace(a=1, white_background=True)", "white_background")
    with pytest.raises(ValueError, match="again"):
        documents.merged_config({"a": {"x": 1}, "b": {"x": 2}}, {"a": {"x"}, "b": {"x"}})


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([("a|b", 0.5), ("c", None)], "n string, v double")
    assert writers.markdown(df).splitlines()[2:] == ["| a\\|b | 0.5000 |", "| c | n/a |"]
    writers.csv_report(df, str(tmp_path / "r.csv"))
    assert (tmp_path / "r.csv").read_text() == "n,v\na|b,0.5\nc,n/a\n"
    assert [r[0] for r in df.select(writers.general(F.col("v"))).collect()] == ["0.5", "n/a"]
    points = spark.createDataFrame([(1, 0.0, 1.0, 2.0, 1, 2, 3)], "point_id long, x double, y double, z double, red int, green int, blue int")
    assert writers.colmap_points_binary(points, str(tmp_path / "p.bin")) == 1 and (tmp_path / "p.bin").stat().st_size == 8 + 8 + 24 + 3 + 8 + 8


def test_stream_goes_on_where_it_ended(spark, tmp_path):
    source, rows = str(tmp_path / "in"), lambda ids: spark.createDataFrame([(i, "k", float(i)) for i in ids], "id long, k string, v double")
    rows([1, 2, 2]).write.mode("append").parquet(source)
    rolled = lambda: streams.roll_up(streams.tail(spark, source, "id long, k string, v double"), ["k"], ["id"], n=F.count(F.lit(1)))
    kept = rolled().writeStream.outputMode("update").foreachBatch(lambda df, _: df.write.mode("append").parquet(str(tmp_path / "out"))).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
    kept.start().awaitTermination()
    rows([2, 3]).write.mode("append").parquet(source)
    again = rolled().writeStream.outputMode("update").foreachBatch(lambda df, _: df.write.mode("append").parquet(str(tmp_path / "out"))).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
    again.start().awaitTermination()
    assert sorted(r["n"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [2, 3]


def test_searches(spark):
    import pandas as pd

    from brindle.functions import numeric
    from brindle.operators import search

    df = spark.createDataFrame([(1, 1.0, 4.0, 3.9), (2, 1.0, 100.0, 7.0), (3, 50.0, 100.0, 60.0)], "id long, near double, far double, hint double")
    f = lambda rows, d: 25 / d**2
    for hint in (None, "hint"):
        got = {r["id"]: r for r in search.farthest_passing(df, f, "near", "far", 0.5, 12, hint).collect()}
        assert got[1]["distance"] == 4.0 and got[1]["evaluations"] == 1 and got[1]["passes"]
        assert abs(got[2]["distance"] - 50**0.5) < 0.2 and got[2]["ratio"] >= 0.5 and got[2]["evaluations"] == 12
        assert not got[3]["passes"] and got[3]["distance"] == 50.0
    got = {r["id"]: r for r in search.shrinking(df, f, "near", "far", 0.5).collect()}
    assert 6 < got[2]["distance"] < 7.08 and got[2]["passes"] and not got[3]["passes"]
    points = spark.createDataFrame([(i, 1.0, 2.0) for i in range(20)], "id long, x double, y double")
    a = search.refine(points, lambda r, p: (p**2).sum(1), ["x", "y"], "id", 0.5).toPandas().sort_values("id")
    b = search.refine(points.repartition(5), lambda r, p: (p**2).sum(1), ["x", "y"], "id", 0.5).toPandas().sort_values("id")
    assert (a["loss"] < 0.5).mean() > 0.8 and (a["loss"] < 5).all() and pd.testing.assert_frame_equal(a.reset_index(drop=True), b.reset_index(drop=True)) is None
    m = np.array([[1, 0.1, 0], [0, 1, 0], [0, 0.1, -1.0]])
    r = np.array(spark.createDataFrame([(m.ravel().tolist(),)], "m array<double>").select(numeric.nearest_rotation(F.col("m"))).head()[0]).reshape(3, 3)
    assert np.allclose(r @ r.T, np.eye(3)) and np.linalg.det(r) == pytest.approx(1)
    x = np.array([0.0, 1, 2.5, 4])
    assert np.allclose(numeric.natural_spline(x, x**2, x), x**2) and np.allclose(numeric.natural_spline(x, 3 * x, np.array([0.3, 3.9])), [0.9, 11.7])


def test_required_fields_and_gates(spark, tmp_path):
    rows = np.zeros(3, dtype=[("x", "<f4"), ("y", "<f4")])
    (tmp_path / "p.ply").write_bytes(b"ply\nformat binary_little_endian 1.0\nelement vertex 3\nproperty float x\nproperty float y\nend_header\n" + rows.tobytes())
    spark.dataSource.register(ply.PlySource)
    read = lambda **o: spark.read.format("ply").option("path", str(tmp_path / "p.ply")).options(**o).load()
    assert read(fields="y", required="x,y").columns == ["y"]
    with pytest.raises(Exception, match="opacity"):
        read(required="splats")
    for folder, names in (("a", ("results.jsonl", "summary.json")), ("b", ("results.jsonl",))):
        (tmp_path / "runs" / folder).mkdir(parents=True)
        for n in names:
            (tmp_path / "runs" / folder / n).write_text("{}")
    found = documents.finished(documents.files(spark, str(tmp_path / "runs")), "results.jsonl", "summary.json").collect()
    assert [r["folder"].rsplit("/", 1)[1] for r in found] == ["a"]
    with pytest.raises(ValueError, match="line 2, column 3"):
        documents.object_of('{"a": 1,\n  x}', "f.json")
    with pytest.raises(ValueError, match="no object"):
        documents.object_of("[1]", "f.json")


def test_exports(spark, tmp_path):
    cameras = spark.createDataFrame([(2, 4, 3, 1.5, 2.5, 2.0, 1.5), (1, 4, 3, 1.0, 2.0, 2.0, 1.5)], "camera_id int, width int, height int, fx double, fy double, cx double, cy double")
    images = spark.createDataFrame([(1, 1.0, 0.0, 0.0, 0.0, 0.5, 0.25, 0.125, 1, "a.png")], "image_id int, qw double, qx double, qy double, qz double, tx double, ty double, tz double, camera_id int, name string")
    points = spark.createDataFrame([(i, i / 2, 1.0, 2.0, 1, 2, 3) for i in range(1, 41)], "point_id long, x double, y double, z double, red int, green int, blue int").repartition(5)
    writers.colmap_text(cameras, images, str(tmp_path))
    writers.colmap_binary(cameras, images, str(tmp_path))
    writers.colmap_points_text(points, str(tmp_path / "points3D.txt"))
    assert writers.colmap_points_binary(points, str(tmp_path / "points3D.bin")) == writers.ply_points(points, str(tmp_path / "points3D.ply")) == 40
    assert (tmp_path / "cameras.bin").stat().st_size == 8 + 2 * 56 and (tmp_path / "images.bin").stat().st_size == 8 + 64 + 6 + 8
    lines = (tmp_path / "points3D.txt").read_text().splitlines()
    assert [int(x.split()[0]) for x in lines] == list(range(1, 41)) and lines[0] == "1 0.5 1.0 2.0 1 2 3 0"
    assert (tmp_path / "points3D.bin").stat().st_size == 8 + 40 * 51
    spark.dataSource.register(ply.PlySource)
    back = spark.read.format("ply").option("path", str(tmp_path / "points3D.ply")).load()
    assert back.agg(F.sum("x")).head()[0] == 410 and back.count() == 40
    doc = {"a": "/old/x", "b": ["/old", {"c": "/older"}], "d": 3}
    assert writers.rebased(doc, "/old", "/new") == {"a": "/new/x", "b": ["/new", {"c": "/older"}], "d": 3}


def test_shares_of_nothing_and_too_few(spark):
    even = selection.apportion(spark.createDataFrame([(0, 0.0), (1, 0.0), (2, 0.0)], "i int, w double"), [], "w", "i", 5)
    assert [r["share"] for r in even.orderBy("i").collect()] == [2, 2, 1] and selection.unserved(even).count() == 0
    assert selection.unserved(selection.apportion(spark.createDataFrame([(0, 1.0), (1, 0.0)], "i int, w double"), [], "w", "i", 5)).count() == 1


def test_configurations_and_plans(tmp_path):
    from brindle.sources import configuration as c

    assert c.symmetric_range(30) == (-15.0, 15.0) and c.symmetric_range((1, 2)) == (1, 2) and c.symmetric_range(True) is True and c.or_default(None, {}) == {}
    old = {"initialization": {"scene_type": "object", "x": 1}}
    assert c.moved_key(old, ("initialization", "scene_type"), ("scene", "scene_type")) == {"initialization": {"x": 1}, "scene": {"scene_type": "object"}} and "scene" not in old
    assert c.moved_key({"scene": {}}, ("initialization", "scene_type"), ("scene", "scene_type")) == {"scene": {}}
    with pytest.raises(ValueError, match="conflicts"):
        c.moved_key(old | {"scene": {"scene_type": "interior"}}, ("initialization", "scene_type"), ("scene", "scene_type"))
    path, calls = str(tmp_path / "plan.json"), []
    make = lambda: calls.append(1) or [{"i": i} for i in range(3)]
    assert c.load_or_create_plan(path, {"a": 1, "b": 2}, make, 3) == c.load_or_create_plan(path, {"b": 2, "a": 1}, make, 3) and len(calls) == 1
    with pytest.raises(ValueError, match="other settings"):
        c.load_or_create_plan(path, {"a": 2}, make, 3)
    (tmp_path / "plan.json").write_text((tmp_path / "plan.json").read_text().replace('"i": 1', '"i": 7'))
    with pytest.raises(ValueError, match="hash"):
        c.load_or_create_plan(path, {"a": 1, "b": 2}, make, 3)
    with pytest.raises(ValueError, match="only 3"):
        c.load_or_create_plan(str(tmp_path / "other.json"), {}, make, 4)
    folder = tmp_path / "out"
    for x in ("frames", "kept"):
        (folder / x).mkdir(parents=True)
    with pytest.raises(FileExistsError):
        c.protect(str(folder), False, ("frames",))
    assert c.protect(str(folder), True, ("frames", "none")) == ["frames"] and (folder / "kept").exists()
    (folder / "link").symlink_to(folder / "kept")
    with pytest.raises(ValueError, match="link"):
        c.remove_rejected(str(folder), "link")
    assert c.remove_rejected(str(folder), "kept") and not c.remove_rejected(str(folder), "kept")
    assert c.base_pose(resolved=None, manual=3, reference=4) == (3, "manual")


def test_sampling(spark):
    from brindle.functions import sampling

    df = spark.range(40)
    rows = df.select(sampling.stratified(F.col("id"), 40, -90.0, 90.0, 3).alias("y")).collect()
    assert all(-90 + 4.5 * i <= r["y"] < -90 + 4.5 * (i + 1) for i, r in enumerate(rows))
    a, b = df.limit(1).select(*(sampling.shuffled(F.sequence(F.lit(0), F.lit(99)), s) for s in (1, 2))).head()
    assert sorted(a) == list(range(100)) and a != b and a != sorted(a)


def test_json_lines_are_numbered_across_the_blocks_of_a_file(spark, tmp_path):
    texts = {"a b+c.jsonl": "".join(f'{{"score": {i}}}\n' for i in range(3000)), "open.jsonl": "".join(f"é{i}\r\n\n" for i in range(500)) + "last", "empty.jsonl": "", "blank.jsonl": "\n", "marked.jsonl": "\ufeffx\ny"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, newline="")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        found = jsonl.lines(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() > len(texts)  # one file is the work of several tasks
        rows = sorted((r["file"].rpartition("/")[2], r["line_no"], r["line"], r["unended"]) for r in found.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    expected = [(name, i, line, not text.endswith("\n") and i == text.count("\n")) for name, text in texts.items() if text for i, line in enumerate(text.removesuffix("\n").split("\n"))]
    assert rows == sorted(expected)


def test_lenient_ledger_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    from brindle.plans import files

    monkeypatch.setattr(files, "_folder", lambda spark: f"file:{tmp_path}")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = files.ledger_file_lenient(spark, "/root/testdata/sf0.001").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = [[json.loads(line) for line in p.read_text().splitlines()] for p in (tmp_path / "ledger").glob("part-*")]
    assert len([p for p in parts if p]) > 1
    assert all(len(p) == 2 * len({e["event_id"] for e in p}) for p in parts)  # an event's two entries are in one file
    assert sum(r["n"] for r in found) == sum(len(p) for p in [[e for e in p if e["event_type"] != "error"] for p in parts]) / 2
