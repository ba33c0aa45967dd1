"""Paired analysis and summaries."""

from pyspark.sql import functions as F

from ..functions.stats import ratio, wilson
from ..operators import paired, quantiles, ranking
from ..session import table
from . import query

NUMBERS = ("mean", "median", "stddev", "min", "p10", "p25", "p75", "p90", "p95", "max", "ci_low", "ci_high")


def rounded(df, digits=6, prefix="", names=NUMBERS):
    return df.withColumns({prefix + c: F.round(prefix + c, digits) for c in names})


def summary_sql(x: str, digits: int = 6) -> str:
    q = ", ".join(f"round(quantile_cont({x}, {p / 100}), {digits}) AS p{p}" for p in (10, 25, 75, 90, 95))
    half = f"CASE WHEN count({x}) > 1 THEN 1.96 * stddev_samp({x}) / sqrt(count({x})) END"
    return f"count({x}) AS count, round(avg({x}), {digits}) AS mean, round(median({x}), {digits}) AS median, round(stddev_pop({x}), {digits}) AS stddev, round(min({x}), {digits}) AS min, {q}, round(max({x}), {digits}) AS max, round(avg({x}) - {half}, {digits}) AS ci_low, round(avg({x}) + {half}, {digits}) AS ci_high"


@query(f"SELECT l_returnflag, {summary_sql('l_extendedprice', 4)} FROM lineitem GROUP BY l_returnflag")
def describe12_by_group(spark, sf):
    return rounded(quantiles.summary(table(spark, sf, "lineitem"), ["l_returnflag"], F.col("l_extendedprice")), 4)


WILSON = """round(({k} / n::DOUBLE + 3.8416 / (2 * n) - 1.96 * sqrt({k} / n::DOUBLE * (1 - {k} / n::DOUBLE) / n + 3.8416 / (4 * n::DOUBLE * n))) / (1 + 3.8416 / n), 6) AS {low},
    round(({k} / n::DOUBLE + 3.8416 / (2 * n) + 1.96 * sqrt({k} / n::DOUBLE * (1 - {k} / n::DOUBLE) / n + 3.8416 / (4 * n::DOUBLE * n))) / (1 + 3.8416 / n), 6) AS {high}"""


@query(f"SELECT l_linestatus, n, k, {WILSON.format(k='k', low='low', high='high')} FROM (SELECT l_linestatus, count(*) AS n, count(*) FILTER (round(l_discount * 100) > 5) AS k FROM lineitem GROUP BY 1)")
def wilson_rate_by_group(spark, sf):
    by = table(spark, sf, "lineitem").groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.round(F.col("l_discount") * 100) > 5).alias("k"))
    low, high = wilson(F.col("k"), F.col("n"))
    return by.select("l_linestatus", "n", "k", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


CONTINGENCY = f"""SELECT n AS pairs, "both", only_a, only_b, neither, round(ka / n::DOUBLE, 6) AS rate_a, {WILSON.format(k='ka', low='a_low', high='a_high')}, round(kb / n::DOUBLE, 6) AS rate_b, {WILSON.format(k='kb', low='b_low', high='b_high')},
    round((kb - ka) / n::DOUBLE, 6) AS rate_delta,
    CASE WHEN only_a + only_b > 0 THEN round(least(1.0, 2 * (SELECT sum(exp(lgamma(only_a + only_b + 1) - lgamma(i + 1) - lgamma(only_a + only_b - i + 1) - (only_a + only_b) * ln(2))) FROM (SELECT unnest(generate_series(0, least(only_a, only_b))) AS i))), 6) END AS p_value
    FROM (SELECT count(*) AS n, count(*) FILTER (a AND b) AS "both", count(*) FILTER (a AND NOT b) AS only_a, count(*) FILTER (b AND NOT a) AS only_b, count(*) FILTER (NOT a AND NOT b) AS neither, count(*) FILTER (a) AS ka, count(*) FILTER (b) AS kb FROM s)"""


def _contingency(df):
    names = ("rate_a", "a_low", "a_high", "rate_b", "b_low", "b_high", "rate_delta", "p_value")
    return rounded(df, 6, names=names)


@query(f"WITH s AS (SELECT quality = 1 AS a, toxic = 1 AS b FROM labels) {CONTINGENCY}")
def mcnemar_contingency(spark, sf):
    return _contingency(paired.contingency(table(spark, sf, "labels"), F.col("quality") == 1, F.col("toxic") == 1))


def _passes(spark, sf):
    """Of each part, what two strategies reach: the exact sum of their discounts in hundredths, their number and their prices."""
    return paired.pair_grouped(table(spark, sf, "lineitem"), ["l_partkey"], F.col("l_returnflag"), "A", "R", points=F.sum(F.round(F.col("l_discount") * 100).cast("long")), n=F.count(F.lit(1)), quantity=F.sum(F.col("l_quantity").cast("long")))


PAIRS = """p AS (SELECT l_partkey, sum(CAST(round(l_discount * 100) AS BIGINT)) FILTER (l_returnflag = 'A') AS a_points, sum(CAST(round(l_discount * 100) AS BIGINT)) FILTER (l_returnflag = 'R') AS b_points,
    count(*) FILTER (l_returnflag = 'A') AS a_n, count(*) FILTER (l_returnflag = 'R') AS b_n, sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag = 'A') AS a_quantity, sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag = 'R') AS b_quantity
    FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY l_partkey HAVING a_n > 0 AND b_n > 0)"""


@query(f"WITH {PAIRS}, s AS (SELECT a_points > 5 * a_n AS a, b_points > 5 * b_n AS b FROM p) {CONTINGENCY}")
def paired_outcome(spark, sf):
    return _contingency(paired.contingency(_passes(spark, sf), F.col("a_points") > 5 * F.col("a_n"), F.col("b_points") > 5 * F.col("b_n")))


D = "(b_points / b_n::DOUBLE - a_points / a_n::DOUBLE)"


@query(f"WITH {PAIRS}, d AS (SELECT {D} AS x FROM p) SELECT {summary_sql('x')}, count(*) FILTER (x > 1e-12) AS higher, count(*) FILTER (abs(x) <= 1e-12) AS level, count(*) FILTER (x < -1e-12) AS lower FROM d")
def paired_delta_stats(spark, sf):
    mean = lambda s: F.col(f"{s}_points") / F.col(f"{s}_n").cast("double")
    return rounded(paired.delta_summary(_passes(spark, sf), mean("a"), mean("b")))


@query("""SELECT l_linestatus, l_returnflag, count(*) AS candidates, count(*) FILTER (round(l_discount * 100) > 5) AS passes, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS seconds, round(avg(l_discount), 6) AS mean_score, round(median(l_discount), 6) AS median_score, round(min(l_discount), 6) AS least_score, round(max(l_discount), 6) AS most_score, round(quantile_cont(l_discount, 0.9), 6) AS p90_score,
    round(avg(l_discount) FILTER (round(l_discount * 100) > 5), 6) AS passing_score, round(count(*) FILTER (round(l_discount * 100) > 5) * 1000.0::DOUBLE / count(*), 6) AS per_thousand,
    round(count(*) FILTER (round(l_discount * 100) > 5) * 3600.0::DOUBLE / sum(l_quantity), 6) AS per_hour, round(sum(l_quantity) / nullif(count(*) FILTER (round(l_discount * 100) > 5), 0), 6) AS seconds_per_pass FROM lineitem GROUP BY 1, 2""")
def strategy_metrics(spark, sf):
    ok = F.round(F.col("l_discount") * 100) > 5
    rows, score = table(spark, sf, "lineitem"), F.col("l_discount")
    by = rows.groupBy("l_linestatus", "l_returnflag").agg(
        F.count(F.lit(1)).alias("candidates"), F.count_if(ok).alias("passes"), F.sum(F.col("l_quantity").cast("long")).alias("seconds"), F.round(F.avg(score), 6).alias("mean_score"), F.round(F.min(score), 6).alias("least_score"), F.round(F.max(score), 6).alias("most_score"), F.round(F.avg(F.when(ok, score)), 6).alias("passing_score")
    )
    by = quantiles.with_quantiles(by, rows, ["l_linestatus", "l_returnflag"], {"median_score": (score, 0.5), "p90_score": (score, 0.9)})
    by = by.withColumns({c: F.round(c, 6) for c in ("median_score", "p90_score")})
    extra = paired.rates(F.col("passes"), F.col("candidates"), F.col("seconds"))
    return by.select("*", *[F.round(v, 6).alias(k) for k, v in extra.items()])


@query("""SELECT l_linestatus, l_returnflag, count(*) AS n, round(avg(l_quantity), 6) AS mean, round(median(l_quantity), 6) AS median, round(quantile_cont(l_quantity, 0.9), 6) AS p90 FROM lineitem GROUP BY GROUPING SETS ((l_linestatus, l_returnflag), (l_returnflag))""")
def micro_rollup(spark, sf):
    q = F.col("l_quantity")
    rows = paired.pooled(table(spark, sf, "lineitem"), "l_linestatus", "l_returnflag", [F.count(F.lit(1)).alias("n"), F.round(F.avg(q), 6).alias("mean")], {"median": (q, 0.5), "p90": (q, 0.9)})
    return rows.withColumns({c: F.round(c, 6) for c in ("median", "p90")})


@query("""SELECT r.l_linestatus, round(r.q / nullif(a.q, 0), 6) AS speed_ratio FROM (SELECT l_linestatus, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) r JOIN (SELECT l_linestatus, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) a USING (l_linestatus)""")
def speed_ratio(spark, sf):
    total = lambda f: F.sum(F.when(F.col("l_returnflag") == f, F.col("l_quantity")))
    by = table(spark, sf, "lineitem").groupBy("l_linestatus").agg(total("R").alias("r"), total("A").alias("a")).where("r IS NOT NULL AND a IS NOT NULL")
    return by.select("l_linestatus", F.round(ratio(F.col("r"), F.col("a")), 6).alias("speed_ratio"))


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def count_by_status(spark, sf):
    return table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH e AS (SELECT conv_id, arg_min(CASE WHEN role = 'system' THEN NULL ELSE length(text) > 120 END, turn) FILTER (true) AS x, max(turn) AS last, min(turn) AS first FROM conversations GROUP BY 1),
    f AS (SELECT e.conv_id, a.v AS first_valid, b.v AS last_valid FROM e JOIN (SELECT conv_id, turn, CASE WHEN role = 'system' THEN NULL ELSE length(text) > 120 END AS v FROM conversations) a ON a.conv_id = e.conv_id AND a.turn = e.first JOIN (SELECT conv_id, turn, CASE WHEN role = 'system' THEN NULL ELSE length(text) > 120 END AS v FROM conversations) b ON b.conv_id = e.conv_id AND b.turn = e.last)
    SELECT count(*) FILTER (first_valid = true AND last_valid = true) AS "both", count(*) FILTER (first_valid = true AND last_valid = false) AS first_only, count(*) FILTER (first_valid = false AND last_valid = true) AS last_only, count(*) FILTER (first_valid = false AND last_valid = false) AS neither, count(*) FILTER (first_valid IS NULL OR last_valid IS NULL) AS unknown FROM f""")
def endpoint_outcomes(spark, sf):
    """True and false count only where they are exactly that; a missing verdict is neither."""
    valid = F.when(F.col("role") != "system", F.length("text") > 120)
    ends = table(spark, sf, "conversations").withColumn("v", F.struct(valid.alias("v"))).groupBy("conv_id").agg(F.min_by("v", "turn").alias("a"), F.max_by("v", "turn").alias("b"))
    a, b = F.col("a.v"), F.col("b.v")
    n = lambda x, y: F.count_if((a == x) & (b == y))
    return ends.agg(n(True, True).alias("both"), n(True, False).alias("first_only"), n(False, True).alias("last_only"), n(False, False).alias("neither"), F.count_if(a.isNull() | b.isNull()).alias("unknown"))


@query("""SELECT p_brand, CASE WHEN count(DISTINCT p_size) = 1 THEN CAST(min(p_size) AS VARCHAR) ELSE 'mixed' END AS size FROM part GROUP BY 1""")
def single_or_mixed(spark, sf):
    sizes = F.collect_set("p_size")
    return table(spark, sf, "part").groupBy("p_brand").agg(F.when(F.size(sizes) == 1, F.get(sizes, F.lit(0)).cast("string")).otherwise("mixed").alias("size"))


@query("""SELECT n_regionkey, sha256(string_agg(n_nationkey || ':' || n_name, ',' ORDER BY n_nationkey)) AS identity FROM nation GROUP BY 1""")
def canonical_identity(spark, sf):
    """A hash over a group's rows in order; groups are small, as those of a plan are."""
    rows = F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda r: F.concat(r["n_nationkey"].cast("string"), F.lit(":"), r["n_name"]))
    return table(spark, sf, "nation").groupBy("n_regionkey").agg(F.sha2(F.array_join(rows, ","), 256).alias("identity"))


@query("""WITH a AS (SELECT p_partkey FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 100), b AS (SELECT p_partkey FROM part ORDER BY p_size DESC, p_partkey LIMIT 100)
    SELECT count(*) FILTER (a.p_partkey IS NOT NULL AND b.p_partkey IS NOT NULL) AS common, count(*) AS union_size, round(count(*) FILTER (a.p_partkey IS NOT NULL AND b.p_partkey IS NOT NULL) / count(*)::DOUBLE, 6) AS jaccard FROM a FULL JOIN b ON a.p_partkey = b.p_partkey""")
def topk_overlap_jaccard(spark, sf):
    part = table(spark, sf, "part")
    top = lambda c: part.orderBy(F.desc(c), "p_partkey").limit(100)
    return ranking.overlap(top("p_retailprice"), top("p_size"), "p_partkey").withColumn("jaccard", F.round("jaccard", 6))
