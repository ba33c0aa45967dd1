"""Points, cameras and pixels: the first components of embeddings stand for points."""

from pyspark.sql import functions as F

from ..functions import bind, colour, geometry
from ..operators import raster, spatial
from ..operators.quantiles import with_quantiles
from ..session import table
from . import query

P = "p AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z, embedding[4]::DOUBLE AS a, label FROM embeddings)"


def _points(spark, sf):
    at = lambda i: F.get("embedding", F.lit(i)).cast("double")
    return table(spark, sf, "embeddings").select("vec_id", at(0).alias("x"), at(1).alias("y"), at(2).alias("z"), at(3).alias("a"), "label")


def _xyz():
    return F.col("x"), F.col("y"), F.col("z")


@query(f"""WITH {P}, sized AS (SELECT p.*, {", ".join(f"exp(greatest(-30, least(30, embedding[{5 + i}]::DOUBLE * 4))) * 0.05 AS s{c}" for i, c in enumerate("xyz"))} FROM p JOIN embeddings USING (vec_id)),
    q AS (SELECT count(*) AS n, {", ".join(f"quantile_cont({c}, 0.01) AS {c}_low, quantile_cont({c}, 0.99) AS {c}_high" for c in "xyz")} FROM sized),
    r AS (SELECT sized.* FROM sized, q WHERE x BETWEEN x_low AND x_high AND y BETWEEN y_low AND y_high AND z BETWEEN z_low AND z_high),
    m AS (SELECT count(*) AS kept, {", ".join(f"median({c}) AS {c}_centre, quantile_cont(s{c}, 0.9) AS {c}_cap" for c in "xyz")} FROM r),
    e AS (SELECT {", ".join(f"quantile_cont({c} - 3 * least(s{c}, {c}_cap), 0.01) AS {c}_min, quantile_cont({c} + 3 * least(s{c}, {c}_cap), 0.99) AS {c}_max" for c in "xyz")} FROM r, m)
    SELECT n, kept, {", ".join(f"round({c}_{s}, 6) AS {c}_{s}" for c in "xyz" for s in ("low", "high", "centre", "cap", "min", "max"))},
    round(sqrt({" + ".join(f"pow(greatest(abs({c}_max - {c}_centre), abs({c}_min - {c}_centre)), 2)" for c in "xyz")}), 6) AS radius FROM q, m, e""")
def robust_bounds(spark, sf):
    at = lambda i: F.get("embedding", F.lit(i)).cast("double")
    rows = table(spark, sf, "embeddings").select(*(at(i).alias(c) for i, c in enumerate("xyz")), *(at(4 + i).alias(f"l{c}") for i, c in enumerate("xyz")))
    df = spatial.robust_bounds(rows, scales=tuple(geometry.decoded_scale(F.col(f"l{c}") * 4, 0.05) for c in "xyz"), most_scale=0.9)
    return df.withColumns({c: F.round(c, 6) for c in df.columns if c not in ("n", "kept")})


@query("""WITH o AS (SELECT label, CASE WHEN label % 2 = 0 THEN embedding[1]::DOUBLE ELSE abs(embedding[1]::DOUBLE) END AS raw FROM embeddings), s AS (SELECT label, NOT (min(raw) >= 0 AND max(raw) <= 1) AS is_logit FROM o GROUP BY 1)
    SELECT o.label, any_value(is_logit) AS is_logit, round(avg(CASE WHEN is_logit THEN 1 / (1 + exp(-raw)) ELSE greatest(0, least(1, raw)) END), 6) AS opacity FROM o JOIN s USING (label) GROUP BY 1""")
def opacity_storage(spark, sf):
    """Each scene's opacities are logits unless all of them lie between 0 and 1."""
    first = F.get("embedding", F.lit(0)).cast("double")
    rows = table(spark, sf, "embeddings").select("label", F.when(F.col("label") % 2 == 0, first).otherwise(F.abs(first)).alias("raw"))
    stored = rows.groupBy("label").agg(colour.is_logit(F.min("raw"), F.max("raw")).alias("is_logit"))
    value = F.when(F.col("is_logit"), colour.opacity(F.col("raw"), True)).otherwise(colour.opacity(F.col("raw"), False))
    return rows.join(stored, "label").groupBy("label").agg(F.first("is_logit").alias("is_logit"), F.round(F.avg(value), 6).alias("opacity"))


@query("""WITH q AS (SELECT vec_id, list_transform(embedding[1:4], lambda x: x::DOUBLE) AS q FROM embeddings), n AS (SELECT vec_id, list_transform(q, lambda x: x / sqrt(list_sum(list_transform(q, lambda y: y * y)))) AS q FROM q)
    SELECT vec_id, round(0.6 * q[1] - 0.8 * q[4], 6) AS w, round(0.6 * q[2] - 0.8 * q[3], 6) AS x, round(0.6 * q[3] + 0.8 * q[2], 6) AS y, round(0.6 * q[4] + 0.8 * q[1], 6) AS z FROM n""")
def composed_rotations(spark, sf):
    """A root rotation about z before each point's own."""
    at = lambda i: F.get("embedding", F.lit(i)).cast("double")
    out = geometry.composed((F.lit(0.6), F.lit(0.0), F.lit(0.0), F.lit(0.8)), tuple(at(i) for i in range(4)))
    return table(spark, sf, "embeddings").select("vec_id", *(F.round(v, 6).alias(c) for v, c in zip(out, "wxyz", strict=True)))


@query(f"WITH {P} SELECT vec_id, round(greatest(0.01, abs(x) * 0.5), 6) AS near, round(greatest(greatest(0.01, abs(x) * 0.5) * 10, abs(x) * 40), 6) AS far, round(greatest(abs(y) * 40, abs(z) + 2 * abs(y)), 6) AS far_global FROM p")
def clipping_planes(spark, sf):
    near, far = geometry.clip_planes(F.abs("x"), 0.01, 0.5, 40.0)
    _, behind = geometry.clip_planes(F.abs("x"), 0.01, 0.5, 40.0, F.abs("y"), F.abs("z"))
    return _points(spark, sf).select("vec_id", F.round(near, 6).alias("near"), F.round(far, 6).alias("far"), F.round(behind, 6).alias("far_global"))


@query(f"""WITH {P} SELECT count(*) FILTER (NOT isfinite(x + y + z + a)) AS nonfinite, count(*) FILTER (abs(a) < 0.05) AS low_opacity, count(*) FILTER (abs(a) >= 0.05 AND NOT (abs(x) <= 0.2 AND abs(y) <= 0.2 AND abs(z) <= 0.2)) AS outlier, count(*) FILTER (abs(a) >= 0.05 AND abs(x) <= 0.2 AND abs(y) <= 0.2 AND abs(z) <= 0.2) AS effective FROM p""")
def reject_breakdown(spark, sf):
    return spatial.reject_counts(_points(spark, sf), F.abs("a"), 0.05, [-0.2] * 3, [0.2] * 3, True)


@query(f"WITH {P}, n AS (SELECT count(*) AS n FROM p) SELECT count(*) AS n, round(avg(x), 6) AS mean_x, round(median(y), 6) AS median_y FROM p, n WHERE vec_id % greatest(1, CAST(ceil(n.n / 300.0) AS BIGINT)) = 0")
def stride_sample_stats(spark, sf):
    """A sampling operator: every row at a stride that leaves 300 at most."""
    rows = spatial.strided(_points(spark, sf), "vec_id", 300)
    out = with_quantiles(rows.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("x"), 6).alias("mean_x")), rows, [], {"median_y": (F.col("y"), 0.5)})
    return out.withColumn("median_y", F.round("median_y", 6))


DIST = "sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z))"


@query(f"WITH {P} SELECT a.vec_id, round(min({DIST}), 6) AS clearance FROM p a JOIN p b ON a.vec_id <> b.vec_id GROUP BY 1")
def nearest_clearance(spark, sf):
    return spatial.nearest(_points(spark, sf), "vec_id").select("vec_id", F.round("distance", 6).alias("clearance"))


@query(f"WITH {P}, d AS (SELECT a.vec_id, {DIST} AS distance, row_number() OVER (PARTITION BY a.vec_id ORDER BY {DIST}, b.vec_id) AS k FROM p a JOIN p b ON a.vec_id <> b.vec_id) SELECT vec_id, round(quantile_cont(distance, 0.95), 6) AS local_radius, round(max(distance), 6) AS farthest FROM d WHERE k <= 8 GROUP BY 1")
def knn_local_radius(spark, sf):
    by = spatial.nearest(_points(spark, sf), "vec_id", k=8).groupBy("vec_id")
    return by.agg(F.round(F.percentile("distance", 0.95), 6).alias("local_radius"), F.round(F.max("distance"), 6).alias("farthest"))


@query(f"WITH {P} SELECT a.vec_id AS a, b.vec_id AS b, round({DIST}, 6) AS distance FROM p a JOIN p b ON a.vec_id < b.vec_id AND {DIST} < 0.03")
def band_self_join(spark, sf):
    return spatial.within(_points(spark, sf), "vec_id", 0.03).withColumn("distance", F.round("distance", 6))


@query()
def greedy_separation(spark, sf):
    """Which points stay depends on those before them, so there is no SQL; tests hold it against a plain loop."""
    return spatial.separated(_points(spark, sf), ["label"], "vec_id", 0.1).select("vec_id", "label")


@query(f"WITH {P} SELECT floor(x / 0.1)::BIGINT AS cx, floor(y / 0.1)::BIGINT AS cy, floor(z / 0.1)::BIGINT AS cz, count(*) AS points FROM p GROUP BY 1, 2, 3")
def voxel_occupancy(spark, sf):
    return spatial.voxels(_points(spark, sf), 0.1)


OFFSETS = [(x, y, z) for x in (-0.05, 0.05) for y in (-0.05, 0.05) for z in (-0.05, 0.05)]


@query(f"""WITH {P}, o(dx, dy, dz) AS (VALUES {", ".join(f"({x}::DOUBLE, {y}::DOUBLE, {z}::DOUBLE)" for x, y, z in OFFSETS)}), v AS (SELECT label, vec_id, count(*) FILTER (abs(x + dx) <= 0.15 AND abs(y + dy) <= 0.15 AND abs(z + dz) <= 0.15) AS valid, 0.15 - greatest(abs(x), abs(y), abs(z)) AS margin FROM p, o GROUP BY ALL)
    SELECT label, vec_id, valid FROM v QUALIFY row_number() OVER (PARTITION BY label ORDER BY valid DESC, margin DESC, vec_id) = 1""")
def probe_density_seed(spark, sf):
    """The candidate with the most probes inside; then the widest margin; then the least index. Probes are a fixed list."""
    at = F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(o, ("dx", "dy", "dz"), strict=True)]) for o in OFFSETS]))
    rows = _points(spark, sf).select("*", at.alias("o"))
    ok = geometry.inside((F.col("x") + F.col("o.dx"), F.col("y") + F.col("o.dy"), F.col("z") + F.col("o.dz")), [-0.15] * 3, [0.15] * 3)
    by = rows.groupBy("label", "vec_id").agg(F.count_if(ok).alias("valid"), F.max(0.15 - F.greatest(F.abs("x"), F.abs("y"), F.abs("z"))).alias("margin"))
    return by.groupBy("label").agg(F.max_by(F.struct("vec_id", "valid"), F.struct("valid", "margin", (-F.col("vec_id")).alias("i"))).alias("r")).select("label", "r.*")


CAM = "c AS (SELECT vec_id, 0.5 + 1.5 * (0.8 * x - 0.6 * z) AS cx, 0.1 + 1.5 * y AS cy, 2.0 + 1.5 * (0.6 * x + 0.8 * z) AS cz, abs(a) * 0.05 + 0.01 AS s FROM p)"


def _camera(spark, sf):
    rows = _points(spark, sf)
    v = geometry.similarity(_xyz(), [[0.8, 0.0, -0.6], [0.0, 1.0, 0.0], [0.6, 0.0, 0.8]], [0.5, 0.1, 2.0], 1.5)
    return bind(rows.select("vec_id", "x", "y", "z", "a"), **dict(zip(("cx", "cy", "cz"), v, strict=True)), s=F.abs("a") * 0.05 + 0.01).select("vec_id", "cx", "cy", "cz", "s")


COV = """k AS (SELECT *, 100 / cz AS jx, -100 * cx / (cz * cz) AS jxz, 100 / cz AS jy, -100 * cy / (cz * cz) AS jyz FROM c), e AS (SELECT *, s * s * (jx * jx + jxz * jxz) + 0.3 AS a, s * s * jxz * jyz AS b, s * s * (jy * jy + jyz * jyz) + 0.3 AS d FROM k)"""


def _projected(spark, sf):
    v = F.col("cx"), F.col("cy"), F.col("cz")
    zero, s2 = 0.0, F.col("s") * F.col("s")
    u, w = geometry.pinhole(v, 100.0, 100.0, 60.0, 60.0)
    a, b, c = geometry.screen_covariance(v, ((s2, zero, zero), (zero, s2, zero), (zero, zero, s2)), 100.0, 100.0)
    return bind(_camera(spark, sf), u=u, v=w, a=a, b=b, c=c)


@query(f"WITH {P}, {CAM}, {COV} SELECT vec_id, round(100 * cx / cz + 60, 4) AS u, round(100 * cy / cz + 60, 4) AS v, round(3 * sqrt((a + d) / 2 + sqrt((a - d) * (a - d) / 4 + b * b)), 4) AS major, round(3 * sqrt(greatest((a + d) / 2 - sqrt((a - d) * (a - d) / 4 + b * b), 0)), 4) AS minor FROM e WHERE cz > 0.01 AND a * d - b * b > 1e-12")
def project_points(spark, sf):
    major, minor = geometry.ellipse_axes(F.col("a"), F.col("b"), F.col("c"))
    rows = _projected(spark, sf).where((F.col("cz") > 0.01) & (F.col("a") * F.col("c") - F.col("b") * F.col("b") > 1e-12))
    return rows.select("vec_id", F.round("u", 4).alias("u"), F.round("v", 4).alias("v"), F.round(major, 4).alias("major"), F.round(minor, 4).alias("minor"))


@query(f"WITH {P}, {CAM} SELECT vec_id, round_even(greatest(0, least(1, cx * 0.28209479177387814 + 0.5)) * 255, 0)::INT AS red FROM c WHERE cz > 1.9 AND cz < 2.5 AND 100 * cx / cz + 60 >= 0 AND 100 * cx / cz + 60 < 90 AND 100 * cy / cz + 60 >= 0 AND 100 * cy / cz + 60 < 70")
def frustum_cull(spark, sf):
    rows = _projected(spark, sf).where((F.col("cz") > 1.9) & (F.col("cz") < 2.5) & (F.col("u") >= 0) & (F.col("u") < 90) & (F.col("v") >= 0) & (F.col("v") < 70))
    return rows.select("vec_id", colour.sh_to_byte(F.col("cx")).alias("red"))


@query(f"""WITH {P} SELECT vec_id, round(least({", ".join(f"CASE WHEN {c} > 0 THEN 1 / {c} WHEN {c} < 0 THEN -1 / {c} END" for c in "xyz")}), 4) AS exit FROM p""")
def ray_aabb_exit(spark, sf):
    zero = F.lit(0.0)
    return _points(spark, sf).select("vec_id", F.round(geometry.box_exit((zero, zero, zero), _xyz(), [-1.0] * 3, [1.0] * 3), 4).alias("exit"))


@query(f"WITH {P} SELECT vec_id, round(degrees(atan2(x, z)), 6) AS yaw, round(degrees(asin(y / sqrt(x * x + y * y + z * z))), 6) AS pitch, round(degrees(2 * atan(tan(radians(60) / 2) / (1 + abs(a)))), 6) AS fov, round(1920 / (2 * tan(radians(40 + 20 * abs(a)) / 2)), 4) AS focal FROM p")
def pose_angles(spark, sf):
    yaw, pitch = geometry.yaw_pitch(_xyz())
    zoomed = geometry.zoomed_fov(F.lit(60.0), 1 + F.abs("a"))
    return _points(spark, sf).select("vec_id", F.round(yaw, 6).alias("yaw"), F.round(pitch, 6).alias("pitch"), F.round(zoomed, 6).alias("fov"), F.round(geometry.focal(40 + 20 * F.abs("a"), F.lit(1920.0)), 4).alias("focal"))


OWN = f"""WITH {P}, {CAM}, {COV}, g0 AS (SELECT e.*, 0.05 + abs(p.a) AS o, 100 * cx / cz + 60 AS u, 100 * cy / cz + 60 AS v, 3 * sqrt((e.a + d) / 2 + sqrt((e.a - d) * (e.a - d) / 4 + b * b)) AS reach FROM e JOIN p USING (vec_id)),
    g AS (SELECT *, row_number() OVER (ORDER BY round(o * 9 * pi() * sqrt(a * d - b * b), 6) DESC, vec_id) AS place FROM g0 QUALIFY place <= 64),
    t AS (SELECT g.*, px, py FROM g JOIN range(120) h(px) ON px BETWEEN floor(u - reach) AND floor(u + reach) JOIN range(120) w(py) ON py BETWEEN floor(v - reach) AND floor(v + reach)),
    m AS (SELECT *, (d * (px + 0.5 - u) * (px + 0.5 - u) - 2 * b * (px + 0.5 - u) * (py + 0.5 - v) + a * (py + 0.5 - v) * (py + 0.5 - v)) / (a * d - b * b) AS m FROM t),
    o AS (SELECT px, py, arg_max(vec_id, struct_pack(s := round(o * exp(-m / 2), 9), i := -place)) AS owner, count(*) AS layers FROM m WHERE m <= 9 AND o * exp(-m / 2) >= 0.01 GROUP BY 1, 2)"""


def _owners(spark, sf):
    major, _ = geometry.ellipse_axes(F.col("a"), F.col("b"), F.col("c"))
    splats = bind(_projected(spark, sf), reach=major, weight=(F.col("s") - 0.01) * 20 + 0.05)
    area = 9 * F.pi() * F.sqrt(F.col("a") * F.col("c") - F.col("b") * F.col("b"))
    touches = raster.footprints(raster.candidates(splats, [], F.round(F.col("weight") * area, 6), "vec_id"), 120, 120)
    return raster.ownership(touches.withColumn("share", F.round("share", 9)), [], "vec_id", "place")


@query(OWN + " SELECT px::INT AS px, py::INT AS py, owner, layers FROM o")
def pixel_ownership(spark, sf):
    return _owners(spark, sf)


@query(OWN + ", n AS (SELECT owner, count(*) AS n FROM o GROUP BY 1 ORDER BY n DESC, owner LIMIT 5) SELECT (SELECT count(*) FROM o) / 14400.0::DOUBLE AS coverage, (SELECT max(n) FROM n) / 14400.0::DOUBLE AS largest_share, (SELECT sum(n) FROM n)::DOUBLE / 14400 AS top_share, (SELECT count(*) FROM o WHERE layers >= 2) / 14400.0::DOUBLE AS overlap_share, (SELECT max(layers) FROM o) AS max_layers")
def pixel_dominance(spark, sf):
    return raster.dominance(_owners(spark, sf), [], 120 * 120)


@query("WITH g AS (SELECT label, vec_id, unnest(embedding) AS v FROM embeddings) SELECT label, round(avg((abs(v) > 0.05)::INT), 6) AS coverage FROM g GROUP BY 1")
def coverage_ratio(spark, sf):
    pixels = table(spark, sf, "embeddings").select("label", F.explode("embedding").alias("v"))
    return raster.coverage(pixels, ["label"], F.abs("v"), 0.05).withColumn("coverage", F.round("coverage", 6))


@query()
def largest_component(spark, sf):
    """Each vector as an image of 8 by 8; a flood fill has no SQL, so tests hold it against a plain one."""
    pixels = table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "v")).select("vec_id", (F.col("i") % 8).alias("px"), F.floor(F.col("i") / 8).cast("int").alias("py"), (F.abs("v") > 0.08).alias("covered"))
    return raster.largest_background(pixels, ["vec_id"], 8, 8)
