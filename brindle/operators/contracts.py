"""What entries, manifests, scenes and runs have to fulfil. Each contract gives the rows that break it: no rows, no fault."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import finite

#: How far times and scores may be from what they should be equal to.
TIME_TOLERANCE, SCORE_TOLERANCE, DRIFT = 1e-7, 1e-12, 1e-5


def entry_rules(schema_version: int = 1) -> dict[str, Column]:
    """Rules of a terminal ledger entry: schema_version, status, coverage_pass, output_ok, constraints_ok, score, initial, minimum, final, ratio, nearest, preview, output, evaluations, fit, render and total (seconds)."""
    c, passed = F.col, F.col("coverage_pass")
    lengths = ("initial", "minimum", "final", "ratio", "nearest")
    rules = {
        "schema": c("schema_version") == schema_version,
        "status": c("status").isin("ok", "coverage_rejected") & ((c("status") == "ok") == passed),
        "score_of_passed": ~passed | finite(c("score")),
        "score_of_rejected": passed | c("score").isNull(),
        "flags": (c("output_ok") == passed) & (c("constraints_ok") == passed),
        "evaluations": (c("preview") >= 1) & (c("evaluations") >= 1) & (c("output") >= 0) & (c("evaluations") == c("preview") + c("output")),
        "seconds": (F.least("fit", "render", "total") >= 0) & (F.abs(c("total") - c("fit") - c("render")) <= TIME_TOLERANCE),
        "render_of_rejected": passed | (c("render") == 0),
    }
    for name in lengths:
        rules[name] = finite(c(name)) & (c(name) >= 0)
    return rules


def pair_rules(target: float) -> dict[str, Column]:
    """Rules of two strategies' entries for one candidate (a_ and b_): who passes reaches the target and nobody else does, and both begin at one distance."""
    return {
        "a_target": F.col("a_coverage_pass") == (F.col("a_ratio") >= target),
        "b_target": F.col("b_coverage_pass") == (F.col("b_ratio") >= target),
        "initial": F.abs(F.col("a_initial") - F.col("b_initial")) <= 1e-8,
    }


def ranked_best(entries: DataFrame, groups: list[str], k: int, score: str = "score", tie: str = "candidate_index") -> DataFrame:
    """The k best scored entries of each group, with their rank: what a manifest has to list."""
    order = Window.partitionBy(*groups).orderBy(F.desc(score), tie)
    return entries.where(F.col("coverage_pass") & F.col(score).isNotNull()).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def manifest_faults(best: DataFrame, manifest: DataFrame, groups: list[str]) -> DataFrame:
    """A row for each rank and rule in which a manifest (groups, rank, candidate_index, score, rerender_score) differs from the recomputed best entries: ranks that one side lacks, another candidate, another score, and a second rendering that drifted."""
    on = [*groups, "rank"]
    both = best.select(*on, F.col("candidate_index").alias("c"), F.col("score").alias("s")).join(manifest.select(*on, F.col("candidate_index").alias("mc"), F.col("score").alias("ms"), F.col("rerender_score").alias("r")), on, "full_outer")
    rules = {
        "missing": F.col("c").isNotNull() & F.col("mc").isNull(),
        "unexpected": F.col("c").isNull() & F.col("mc").isNotNull(),
        "candidate": F.col("c") != F.col("mc"),
        "score": F.abs(F.col("s") - F.col("ms")) > SCORE_TOLERANCE,
        "drift": F.abs(F.col("r") - F.col("ms")) > DRIFT,
    }
    broken = F.filter(F.array(*[F.when(F.coalesce(r, F.lit(False)), F.lit(n)) for n, r in rules.items()]), lambda x: x.isNotNull())
    return both.select(*on, F.explode(broken).alias("rule"))


def not_poolable(scenes: DataFrame, scene: str, same: list[str], expected: list[str]) -> DataFrame:
    """Why scenes can't be analysed together: settings (`same`) that differ between them, scenes that are missing, unexpected or there twice. Rows (rule, detail)."""
    settings = scenes.agg(*[F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit("null"))).alias(c) for c in same])
    differing = settings.select(F.explode(F.filter(F.array(*[F.when(F.col(c) > 1, F.lit(c)) for c in same]), lambda x: x.isNotNull())).alias("detail")).select(F.lit("differs").alias("rule"), "detail")
    wanted = scenes.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, expected))).alias(scene)).withColumn("__e", F.lit(1))
    counts = scenes.groupBy(scene).agg(F.count(F.lit(1)).alias("__n")).join(wanted, scene, "full_outer")
    rule = F.when(F.col("__n").isNull(), "missing").when(F.col("__e").isNull(), "unexpected").when(F.col("__n") > 1, "twice")
    return differing.union(counts.select(rule.alias("rule"), F.col(scene).cast("string").alias("detail")).where("rule IS NOT NULL"))


def gate(error: Column, *verdicts: Column) -> Column:
    """Accepted: there was no error, and every verdict is true; a missing one is not."""
    out = error.isNull()
    for v in verdicts:
        out = out & F.coalesce(v, F.lit(False))
    return out


def scene_complete(status: Column, cameras: Column, results: Column, render_errors: Column, evaluation_errors: Column) -> Column:
    """A scene is done if its run ended, it has a result for every camera, and none of them failed."""
    none = lambda c: F.coalesce(c, F.lit(0)) == 0
    return F.coalesce((status == "completed") & cameras.isNotNull() & results.isNotNull() & (cameras == results), F.lit(False)) & none(render_errors) & none(evaluation_errors)


def video_complete(found: dict[str, Column], wanted: dict[str, Column], echoes: list[tuple[Column, Column]] = ()) -> Column:
    """A video has the frames, width and height that it should have, its rate to a thousandth, and was made with the same settings (pairs that are equal, nulls included)."""
    out = F.lit(True)
    for name in ("frames", "width", "height"):
        out = out & (found[name] == wanted[name])
    rate = F.abs(found["fps"] - wanted["fps"]) <= F.greatest(1e-3 * F.greatest(F.abs(found["fps"]), F.abs(wanted["fps"])), F.lit(1e-3))
    out = F.coalesce(out & rate, F.lit(False))
    for a, b in echoes:
        out = out & a.eqNullSafe(b)
    return out


def outcomes(runs: DataFrame, groups: list[str], order: str) -> DataFrame:
    """What became of each position of a scene (complete, worker_broken, failed, accepted: booleans; in_valid, in_invalid: where its folder is), up to the first that broke the worker, as a run ends there.

    Adds `status`: skipped_existing if its video was complete, evaluation_error if the worker broke, render_error if
    anything else failed, rejected or generated by the gate; and `valid`: whether it is filed with what can be used.
    """
    c = lambda name: F.coalesce(F.col(name), F.lit(False))
    status = F.when(c("complete") & ~c("failed"), "skipped_existing").when(c("worker_broken"), "evaluation_error").when(c("failed"), "render_error").when(~c("accepted"), "rejected").otherwise("generated")
    rows = runs.withColumn("status", status)
    fatal = (F.col("status") == "evaluation_error").cast("int")
    before = F.coalesce(F.max(fatal).over(Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    valid = F.col("status").isin("skipped_existing", "generated") | ((F.col("status") == "render_error") & c("in_valid") & ~c("in_invalid"))
    return rows.withColumn("__before", before).where("__before = 0").drop("__before").withColumn("valid", valid)


def merged_by_name(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    """One row for each name that both sides have exactly once, in the columns of both; anything else is an error when the rows are read."""
    a, b = (df.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(name))).select(name, *[F.col(c) for c in df.columns if c != name], F.col("__n").alias(f"__{side}")) for side, df in (("a", left), ("b", right)))
    both = a.join(b, name, "full_outer")
    bad = F.coalesce((F.col("__a") != 1) | (F.col("__b") != 1), F.lit(True))
    checked = F.when(bad, F.raise_error(F.concat(F.lit("not exactly once on either side: "), F.coalesce(F.col(name).cast("string"), F.lit("null"))))).otherwise(F.col(name))
    return both.select(checked.alias(name), *[c for c in both.columns if c not in (name, "__a", "__b")])


def not_falling(rows: DataFrame, groups: list[str], order: str, value: str, tolerance: float = 1e-12) -> DataFrame:
    """Rows whose value is above that of the row before it by more than the tolerance."""
    before = F.lag(value).over(Window.partitionBy(*groups).orderBy(order))
    return rows.withColumn("before", before).where(F.col(value) > F.col("before") + tolerance)


def camera_rules(matrix: Column, position: Column, fov: Column) -> dict[str, Column]:
    """Rules of a camera document: a pose as sixteen numbers (camera to world, row by row), a position of three, and a field of view in degrees. Numbers are finite; the last row is 0, 0, 0, 1; the rest turns without stretching or mirroring; its shift is the position; the view is over 1 and under 179 degrees."""
    m = [[F.get(matrix, F.lit(4 * i + j)) for j in range(4)] for i in range(4)]
    near = lambda a, b, tolerance: finite(b) & (F.abs(a - b) <= tolerance + 1e-5 * F.abs(b))
    every = lambda conditions: F.forall(F.array(*conditions), lambda x: F.coalesce(x, F.lit(False)))
    product = [(sum((m[k][i] * m[k][j] for k in range(3)), F.lit(0.0)), F.lit(1.0 if i == j else 0.0)) for i in range(3) for j in range(i, 3)]
    det = m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1]) - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0]) + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0])
    return {
        "shape": (F.size(matrix) == 16) & (F.size(position) == 3),
        "finite": F.forall(F.concat(matrix, position), finite),
        "last_row": every([near(m[3][j], F.lit(float(j == 3)), 1e-7) for j in range(4)]),
        "orthonormal": every([near(a, b, 1e-5) for a, b in product]),
        "determinant": near(det, F.lit(1.0), 1e-5),
        "position": every([near(m[i][3], F.get(position, F.lit(i)), 1e-7) for i in range(3)]),
        "fov": (fov > 1) & (fov < 179),
    }


def lens_faults(lenses: DataFrame, config: str, total_frames: int, jump_frames: int, switch_frames: int) -> DataFrame:
    """What is wrong with configurations of lenses (config, lens_index, name, zoom_min, zoom_max, frame_count, position of the jump): a row for each lens and rule, with a null lens for the sum of frames.

    Names are unique in a configuration; ranges of zoom rise and don't touch; every lens has a frame, and two if its
    range has two ends; what is left after a jump holds its transition, and a lens after the first one holds a switch;
    frames add up to the total.
    """
    w = Window.partitionBy(config).orderBy("lens_index")
    n, jump = F.col("frame_count"), F.rint(F.col("position") * (F.col("frame_count") - 1)).cast("long")
    rules = {
        "name": F.count(F.lit(1)).over(Window.partitionBy(config, "name")) > 1,
        "order": F.col("zoom_min") <= F.lag("zoom_max").over(w),
        "frames": n < 1,
        "ends": (n < 2) & (F.col("zoom_max") > F.col("zoom_min")),
        "jump": F.lit(jump_frames) > n - jump,
        "switch": (F.row_number().over(w) > 1) & (F.lit(switch_frames) > n),
    }
    marked = lenses.select(config, "lens_index", *[F.coalesce(v, F.lit(False)).alias(k) for k, v in rules.items()])
    each = marked.select(config, "lens_index", F.explode(F.filter(F.array(*[F.when(F.col(k), F.lit(k)) for k in rules]), lambda x: x.isNotNull())).alias("rule"))
    sums = lenses.groupBy(config).agg(F.sum("frame_count").alias("n")).where(F.col("n") != total_frames)
    return each.union(sums.select(config, F.lit(None).cast(dict(lenses.dtypes)["lens_index"]).alias("lens_index"), F.lit("total").alias("rule")))
