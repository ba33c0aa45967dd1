"""Searches and numerics. Their objectives are formulas here; a renderer or a scorer takes the same place."""

import numpy as np
from pyspark.sql import functions as F

from ..functions import numeric
from ..operators import search
from ..session import table
from . import query


def _ratio(rows, distance):
    return rows["p_size"].to_numpy() / np.maximum(distance, 1e-9) ** 2


def _parts(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_size", F.lit(1.0).alias("near"), (F.col("p_retailprice") / 50).alias("far"))


@query("""WITH RECURSIVE p AS (SELECT p_partkey, p_size::DOUBLE AS s, p_retailprice / 50 AS far FROM part), b AS (SELECT p_partkey, s, 1.0::DOUBLE AS lo, far AS hi, 2 AS n, s / (far * far) >= 0.25 AS done, s / 1.0 < 0.25 AS never FROM p
    UNION ALL SELECT p_partkey, s, CASE WHEN s / pow((lo + hi) / 2, 2) >= 0.25 THEN (lo + hi) / 2 ELSE lo END, CASE WHEN s / pow((lo + hi) / 2, 2) >= 0.25 THEN hi ELSE (lo + hi) / 2 END, n + 1, done, never FROM b WHERE n < 8 AND NOT done AND NOT never)
    SELECT p_partkey, round(CASE WHEN done THEN hi ELSE lo END, 10) AS distance, NOT never AS passes, CASE WHEN done THEN 1 ELSE n END AS evaluations FROM b QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY n DESC) = 1""")
def farthest_passing_distance(spark, sf):
    rows = search.farthest_passing(_parts(spark, sf), _ratio, "near", "far", 0.25)
    return rows.select("p_partkey", F.round("distance", 10).alias("distance"), "passes", "evaluations")


@query("""WITH RECURSIVE p AS (SELECT p_partkey, p_size::DOUBLE AS s, p_retailprice / 50 AS d, 1 AS n FROM part), w AS (SELECT * FROM p UNION ALL SELECT p_partkey, s, greatest(1, d * least(0.9, greatest(0.5, sqrt(s / (d * d) / 0.25)))), n + 1 FROM w WHERE s / (d * d) < 0.25 AND n < 6 AND d > 1)
    SELECT p_partkey, round(d, 7) AS distance, s / (d * d) >= 0.25 AS passes, n AS evaluations FROM w QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY n DESC) = 1""")
def shrinking_distance(spark, sf):
    rows = search.shrinking(_parts(spark, sf), _ratio, "near", "far", 0.25)
    return rows.select("p_partkey", F.round("distance", 7).alias("distance"), "passes", "evaluations")


@query()
def refined_poses(spark, sf):
    """A stochastic search has no SQL; tests see that losses fall and depend on the key alone."""
    at = lambda i: F.get("embedding", F.lit(i)).cast("double")
    rows = table(spark, sf, "embeddings").select("vec_id", at(0).alias("x"), at(1).alias("y"))
    return search.refine(rows, lambda r, p: ((p - 0.25) ** 2).sum(1), ["x", "y"], "vec_id", 0.1)


_K = ", ".join(f"({i - 5}, exp(-{(i - 5) ** 2} / 4.5::DOUBLE))" for i in range(11))


@query(f"""WITH k0(o, w) AS (VALUES {_K}), k AS (SELECT o, w / (SELECT sum(w) FROM k0) AS w FROM k0), m AS (SELECT k.o, t.x, CASE WHEN abs(t.x + o) > 7 THEN 14 - abs(t.x + o) ELSE abs(t.x + o) END AS s, w FROM k, range(8) t(x)),
    v AS (SELECT vec_id, i % 8 AS x, i // 8 AS y, abs(embedding[i + 1]::DOUBLE) AS a, abs(embedding[64 - i]::DOUBLE) AS b FROM embeddings, range(64) r(i)),
    h AS (SELECT vec_id, m.x, v.y, sum(w * a) AS a, sum(w * b) AS b, sum(w * a * a) AS aa, sum(w * b * b) AS bb, sum(w * a * b) AS ab FROM v JOIN m ON m.s = v.x GROUP BY ALL),
    g AS (SELECT vec_id, h.x, m.x AS y, sum(w * a) AS a, sum(w * b) AS b, sum(w * aa) AS aa, sum(w * bb) AS bb, sum(w * ab) AS ab FROM h JOIN m ON m.s = h.y GROUP BY ALL)
    SELECT vec_id, round(greatest(-1, least(1, avg((2 * a * b + 0.0001) * (2 * (ab - a * b) + 0.0009) / ((a * a + b * b + 0.0001) * (aa - a * a + bb - b * b + 0.0009))))), 6) AS ssim FROM g GROUP BY 1""")
def structural_similarity(spark, sf):
    """Each vector as an image of 8 by 8, against itself upside down."""
    image = F.transform("embedding", lambda x: F.abs(x.cast("double")))
    return table(spark, sf, "embeddings").select("vec_id", F.round(numeric.structural_similarity(image, F.reverse(image), 8), 6).alias("ssim"))


@query("""WITH RECURSIVE p AS (SELECT p_partkey, p_size::DOUBLE AS s, 1.0::DOUBLE AS lo, p_retailprice / 50 AS hi, 0 AS n, NULL::DOUBLE AS d, NULL::DOUBLE AS cov, NULL::DOUBLE AS bg FROM part),
    w AS (SELECT * FROM p UNION ALL SELECT p_partkey, s, CASE WHEN least(1, s / (m * m)) < 0.5 OR m / 40 > 0.3 THEN lo ELSE m END, CASE WHEN least(1, s / (m * m)) < 0.5 OR m / 40 > 0.3 THEN m ELSE hi END, n + 1, m, least(1, s / (m * m)), m / 40 FROM (SELECT *, (lo + hi) / 2 AS m FROM w WHERE n < 12)),
    c AS (SELECT *, abs(cov - 0.5) + 2 * greatest(0, bg - 0.3) + 2 * greatest(0, 0.4 - cov) AS score FROM w WHERE n > 0)
    SELECT p_partkey, round(d, 8) AS distance, round(score, 8) AS score, cov >= 0.4 AND bg <= 0.3 AS met FROM c QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY score, n) = 1""")
def fitted_distance(spark, sf):
    rows = search.fitted(_parts(spark, sf), lambda r, d: (np.minimum(1, r["p_size"].to_numpy() / (d * d)), d / 40), "near", "far", 0.5, 0.4, 0.3)
    return rows.select("p_partkey", F.round("distance", 8).alias("distance"), F.round("score", 8).alias("score"), "met")


@query("""WITH t AS (SELECT p_partkey, k, 1 / pow(2, k) AS size, greatest(0, p_size / pow(2, k) - 5) + CASE WHEN p_partkey % 7 = 0 THEN 1 + k ELSE 0 END AS penalty FROM part, range(4) r(k))
    SELECT p_partkey, size, round(penalty, 9) AS penalty, penalty <= 0 AS met FROM t QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY CASE WHEN penalty <= 0 THEN 0 ELSE 1 END, penalty, k) = 1""")
def damped_motion(spark, sf):
    def penalty(rows, size):
        stubborn = rows["p_partkey"].to_numpy() % 7 == 0
        return np.maximum(0, rows["p_size"].to_numpy() * size - 5) + np.where(stubborn, 1 - np.log2(size), 0)

    rows = search.damped(table(spark, sf, "part").select("p_partkey", "p_size"), penalty)
    return rows.select("p_partkey", "size", F.round("penalty", 9).alias("penalty"), "met")


@query("""WITH RECURSIVE p AS (SELECT p_partkey, p_size::DOUBLE AS s, 1 + p_retailprice / 400 AS d, 1 AS n FROM part), w AS (SELECT * FROM p UNION ALL SELECT p_partkey, s, greatest(1, d * 0.98), n + 1 FROM w WHERE s / (d * d) < 1 AND n < 3 AND d > 1)
    SELECT p_partkey, round(d, 8) AS distance, s / (d * d) >= 1 AS passes, n AS evaluations FROM w QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY n DESC) = 1""")
def corrected_distance(spark, sf):
    """A distance that another resolution found, moved in until it passes."""
    rows = table(spark, sf, "part").select("p_partkey", "p_size", F.lit(1.0).alias("near"), (1 + F.col("p_retailprice") / 400).alias("distance"))
    return search.corrected(rows, _ratio, "distance", "near", 1.0).select("p_partkey", F.round("distance", 8).alias("distance"), "passes", "evaluations")
