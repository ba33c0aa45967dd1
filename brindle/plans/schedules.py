"""Schedules, turns and offsets."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import colour
from ..operators import schedule
from ..session import table
from . import query

#: Three lenses: least and greatest zoom, frames, jump strength and position.
LENSES = [(0, 0.5, 0.95, 3, 0.15, 0.35), (1, 1.0, 2.95, 13, -0.1, 0.55), (2, 3.0, 5.0, 14, 0.2, 0.7)]
LENS_SQL = "l(lens_index, lo, hi, n, strength, position) AS (VALUES " + ", ".join(f"({i}::BIGINT, {a}::DOUBLE, {b}::DOUBLE, {n}::BIGINT, {s}::DOUBLE, {p}::DOUBLE)" for i, a, b, n, s, p in LENSES) + "), s AS (SELECT *, coalesce(sum(n) OVER (ORDER BY lens_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM l), f AS (SELECT *, unnest(generate_series(0, n - 1))::BIGINT AS local FROM s)"


def _lenses(spark):
    return spark.createDataFrame(LENSES, "lens_index long, zoom_min double, zoom_max double, frame_count long, strength double, position double")


@query(f"""WITH {LENS_SQL}, t AS (SELECT *, CASE WHEN n > 1 THEN local / (n - 1)::DOUBLE ELSE 0 END AS t0 FROM f), u AS (SELECT *, CASE WHEN t0 <= 0 THEN 0.0 WHEN t0 >= 1 THEN 1.0 ELSE t0 * t0 * (3 - 2 * t0) END AS t FROM t)
    SELECT start + local AS frame_index, lens_index, round(t, 9) AS progress, round(CASE WHEN t <= 0 THEN lo WHEN t >= 1 THEN hi ELSE lo + (hi - lo) * t END, 9) AS zoom, round(CASE WHEN lens_index > 0 AND local < 3 THEN local / 2.0::DOUBLE ELSE 1.0 END, 9) AS blend FROM u""")
def zoom_schedule(spark, sf):
    rows = schedule.frames(_lenses(spark)).withColumn("t", schedule.progress(F.col("local"), F.col("frame_count"), smooth=True))
    return rows.select("frame_index", "lens_index", F.round("t", 9).alias("progress"), F.round(schedule.zoom(F.col("zoom_min"), F.col("zoom_max"), F.col("t")), 9).alias("zoom"), F.round(schedule.crossfade(F.col("local"), F.col("lens_index"), 3), 9).alias("blend"))


@query(f"""WITH {LENS_SQL}, j AS (SELECT *, round_even(position * (n - 1), 0)::BIGINT AS jump FROM f), q AS (SELECT *, CASE WHEN local < jump THEN 0.0::DOUBLE ELSE least(1.0, (local - jump + 1) / least(4, n - jump)::DOUBLE) END AS progress FROM j)
    SELECT start + local AS frame_index, jump AS jump_frame, round(progress, 9) AS progress, round(strength * 2, 9) AS jump_ev, round(strength * 2 * progress, 9) AS applied_ev, round(pow(2, strength * 2 * progress), 9) AS gain, round(0.02 * greatest(0, 1 + strength * 2 * progress * 0.5), 9) AS noise_std, progress > 0 AS applied FROM q""")
def temporal_jump(spark, sf):
    rows = schedule.frames(_lenses(spark))
    progress = schedule.jump_progress(F.col("local"), F.col("frame_count"), F.col("strength"), F.col("position"), 4)
    state = schedule.jump_state(progress, F.col("strength"), 2.0, F.lit(0.02), 0.5)
    numbers = {"progress": progress, **{k: v for k, v in state.items() if k != "applied"}}
    return rows.select("frame_index", schedule.jump_frame(F.col("position"), F.col("frame_count")).alias("jump_frame"), *(F.round(v, 9).alias(k) for k, v in numbers.items()), state["applied"].alias("applied"))


@query(f"WITH {LENS_SQL} SELECT lens_index, start AS first_frame, start + n - 1 AS last_frame, start + round_even(position * (n - 1), 0)::BIGINT AS jump_at FROM s")
def lens_ranges(spark, sf):
    rows = schedule.frames(_lenses(spark)).groupBy("lens_index").agg(F.min("frame_index").alias("first_frame"), F.max("frame_index").alias("last_frame"), F.first("position").alias("p"), F.first("frame_count").alias("n"))
    return rows.select("lens_index", "first_frame", "last_frame", (F.col("first_frame") + schedule.jump_frame(F.col("p"), F.col("n"))).alias("jump_at"))


@query("""WITH o AS (SELECT * FROM (VALUES (0), (1), (2)) t(lens)) SELECT n_nationkey, lens, (lens * 25 + n_nationkey)::BIGINT AS candidate_index, CASE WHEN (lens * 25 + n_nationkey) % 2 = 0 THEN 'a,b' ELSE 'b,a' END AS strategy_order FROM nation, o""")
def plan_cross_product(spark, sf):
    """Nations stand for positions; the strategy that goes first alternates."""
    index = (F.col("lens") * 25 + F.col("n_nationkey")).cast("long")
    rows = schedule.plan(table(spark, sf, "nation").select("n_nationkey"), spark.range(3).select(F.col("id").cast("int").alias("lens")))
    return rows.select("n_nationkey", "lens", index.alias("candidate_index"), F.when(index % 2 == 0, "a,b").otherwise("b,a").alias("strategy_order"))


@query("SELECT conv_id, turn, CAST(coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start, CAST(length(text) AS BIGINT) AS length FROM conversations")
def running_offsets(spark, sf):
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    return table(spark, sf, "conversations").select("conv_id", "turn", F.coalesce(F.sum(F.length("text")).over(w), F.lit(0)).cast("long").alias("start"), F.length("text").cast("long").alias("length"))


@query("""SELECT conv_id, bool_and(coalesce(turn > p, true)) AS rising, bool_and(turn = n - 1) AS contiguous, bool_and(coalesce(length(text) <= l, true)) AS not_longer FROM (SELECT *, lag(turn) OVER w AS p, lag(length(text)) OVER w AS l, row_number() OVER w AS n FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) GROUP BY 1""")
def monotonic_contiguity(spark, sf):
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, sf, "conversations").withColumns({"p": F.lag("turn").over(w), "l": F.lag(F.length("text")).over(w), "n": F.row_number().over(w)})
    every = lambda c: F.bool_and(F.coalesce(c, F.lit(True)))
    return rows.groupBy("conv_id").agg(every(F.col("turn") > F.col("p")).alias("rising"), every(F.col("turn") == F.col("n") - 1).alias("contiguous"), every(F.length("text") <= F.col("l")).alias("not_longer"))


@query("SELECT conv_id, turn, role, lag(role) OVER w AS before, lead(role) OVER w AS after FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def adjacent_rows(spark, sf):
    w = Window.partitionBy("conv_id").orderBy("turn")
    return table(spark, sf, "conversations").select("conv_id", "turn", "role", F.lag("role").over(w).alias("before"), F.lead("role").over(w).alias("after"))


@query("""WITH RECURSIVE v AS (SELECT p_brand, p_size::DOUBLE AS o, (p_size + p_partkey % 9)::DOUBLE AS x, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS i FROM part), w AS (SELECT *, o - lag(o) OVER (PARTITION BY p_brand ORDER BY i) AS d FROM v),
    g AS (SELECT p_brand, i, x AS y FROM w WHERE i = 1 UNION ALL SELECT w.p_brand, w.i, CASE WHEN (w.x - g.y) * CASE WHEN d <> 0 THEN sign(d) WHEN w.x <> g.y THEN sign(w.x - g.y) ELSE 1 END < greatest(0.04, abs(d) * 0.6)
        THEN g.y + CASE WHEN d <> 0 THEN sign(d) WHEN w.x <> g.y THEN sign(w.x - g.y) ELSE 1 END * greatest(0.04, abs(d) * 0.6) ELSE w.x END FROM g JOIN w ON w.p_brand = g.p_brand AND w.i = g.i + 1)
    SELECT p_brand, i AS place, round(y, 6) AS value FROM g""")
def exposure_guard_fold(spark, sf):
    """Sizes of a brand's parts stand for exposures of neighbouring lenses, before and after a perturbation."""
    entry = F.struct("p_partkey", F.col("p_size").cast("double").alias("o"), (F.col("p_size") + F.col("p_partkey") % 9).cast("double").alias("x"))
    by = table(spark, sf, "part").groupBy("p_brand").agg(F.array_sort(F.collect_list(entry)).alias("v"))
    by = by.select("p_brand", schedule.guarded(F.transform("v", lambda r: r["o"]), F.transform("v", lambda r: r["x"])).alias("g"))
    return by.select("p_brand", F.posexplode("g").alias("place", "value")).select("p_brand", (F.col("place") + 1).cast("long").alias("place"), F.round("value", 6).alias("value"))


@query("""WITH c AS (SELECT vec_id, abs(embedding[1]::DOUBLE) * 2 AS r0, abs(embedding[2]::DOUBLE) * 2 AS g0, abs(embedding[3]::DOUBLE) * 2 AS b0 FROM embeddings), e AS (SELECT vec_id, ((r0 * 1.189207115002721 * 0.75 * 1.1 + 0.01 - 0.18) * 1.2 + 0.18) AS r, ((g0 * 1.189207115002721 * 0.75 + 0.01 - 0.18) * 1.2 + 0.18) AS g, ((b0 * 1.189207115002721 * 0.75 * 0.9 + 0.01 - 0.18) * 1.2 + 0.18) AS b FROM c),
    l AS (SELECT *, 0.2126 * r + 0.7152 * g + 0.0722 * b AS y FROM e), s AS (SELECT vec_id, y + (r - y) * 1.3 AS r, y + (g - y) * 1.3 AS g, y + (b - y) * 1.3 AS b FROM l)
    SELECT vec_id, """ + ", ".join(f"round(CASE WHEN {c} > 0.8 THEN 0.8 + 0.2 * (1 - exp(-({c} - 0.8) / 0.2)) ELSE greatest(0, {c}) END, 6) AS {c}" for c in "rgb") + " FROM s")
def color_pipeline(spark, sf):
    rgb = tuple(F.abs(F.get("embedding", F.lit(i)).cast("double")) * 2 for i in range(3))
    out = colour.develop(rgb, exposure=0.25, balance=(1.1, 1.0, 0.9), black=0.01, contrast=1.2, saturation=1.3, gain=0.75)
    return table(spark, sf, "embeddings").select("vec_id", *[F.round(x, 6).alias(c) for x, c in zip(out, "rgb", strict=True)])


@query("""WITH e AS (SELECT vec_id, unnest(generate_series(0, 63)) AS i, embedding FROM embeddings), v AS (SELECT vec_id, i, abs(embedding[i + 1]::DOUBLE) * 4 AS x, (i % 8) * 2.0 / 7 - 1 AS ax, floor(i / 8) * 2.0 / 7 - 1 AS ay FROM e)
    SELECT vec_id, i::INT AS pixel, round(greatest(0, least(1, pow(greatest(0, least(1, x)), 1 / 2.2) * greatest(0, least(1, 1 - 0.3 * (ax * ax + ay * ay) / 2)) + 0.01)), 6) AS value FROM v""")
def encoded_pixels(spark, sf):
    """Vectors as images of 8 by 8: gamma, falloff to the corners and a constant in place of noise."""
    pixels = table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("pixel", "v"))
    light = colour.falloff(F.col("pixel") % 8, F.floor(F.col("pixel") / 8), 8, 8, 0.3)
    return pixels.select("vec_id", "pixel", F.round(colour.finish(F.abs(F.col("v").cast("double")) * 4, 2.2, light, F.lit(0.01)), 6).alias("value"))


@query(f"WITH {LENS_SQL} SELECT count(*) AS n FROM (SELECT lo + (hi - lo) * CASE WHEN n > 1 THEN local / (n - 1)::DOUBLE ELSE 0 END AS z, lag(lo + (hi - lo) * CASE WHEN n > 1 THEN local / (n - 1)::DOUBLE ELSE 0 END) OVER (ORDER BY start + local) AS b FROM f) WHERE z <= b")
def zoom_not_rising(spark, sf):
    """A schedule whose zoom rises throughout has no such frames."""
    rows = schedule.frames(_lenses(spark))
    rows = rows.withColumn("zoom", schedule.zoom(F.col("zoom_min"), F.col("zoom_max"), schedule.progress(F.col("local"), F.col("frame_count"))))
    return schedule.not_rising(rows).agg(F.count(F.lit(1)).alias("n"))
