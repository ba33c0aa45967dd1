"""Ranking, top k and selection that stops early."""

from pyspark.sql import functions as F

from ..functions.text import slug
from ..operators import ranking, selection
from ..session import table
from . import query


def _best():
    return [F.desc("l_extendedprice"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")]


TOP1 = "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_suppkey, l_linenumber) = 1"


@query(TOP1)
def top1_per_group(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")
    return ranking.best_per_group(rows, ["l_orderkey"], _best())


@query(f"SELECT l_orderkey, l_extendedprice, row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey) AS rank FROM ({TOP1})")
def global_rank(spark, sf):
    return ranking.rank_all(top1_per_group(spark, sf).select("l_orderkey", "l_extendedprice"), [F.desc("l_extendedprice"), F.col("l_orderkey")])


@query("SELECT p_partkey, p_retailprice, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part ORDER BY rank LIMIT 20")
def topk_ordered(spark, sf):
    return ranking.top_k(table(spark, sf, "part").select("p_partkey", "p_retailprice"), [F.desc("p_retailprice"), F.col("p_partkey")], 20)


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CASE WHEN l_linenumber = 7 THEN 'nan'::DOUBLE ELSE l_extendedprice / l_quantity END AS ratio FROM lineitem)
    SELECT l_orderkey, l_partkey, l_extendedprice, isnan(ratio) AS unknown, row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rank FROM r WHERE isnan(ratio) OR ratio <= 2000 ORDER BY rank LIMIT 50""")
def topk_excluding_ratio(spark, sf):
    """Rows without a ratio stay, as they do where a comparison with NaN is false."""
    ratio = F.when(F.col("l_linenumber") == 7, F.lit(float("nan"))).otherwise(F.col("l_extendedprice") / F.col("l_quantity"))
    rows = ranking.drop_excess(table(spark, sf, "lineitem").withColumn("ratio", ratio), F.col("ratio"), 2000, nan_stays=True)
    order = [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")]
    return ranking.top_k(rows, order, 50).select("l_orderkey", "l_partkey", "l_extendedprice", F.isnan("ratio").alias("unknown"), "rank")


@query("SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders WHERE o_orderstatus = 'F' AND isfinite(o_totalprice) ORDER BY rank LIMIT 10")
def topk_coverage_qualified(spark, sf):
    rows = table(spark, sf, "orders").where((F.col("o_orderstatus") == "F") & (F.abs("o_totalprice") < float("inf"))).select("o_orderkey", "o_totalprice")
    return ranking.top_k(rows, [F.desc("o_totalprice"), F.col("o_orderkey")], 10)


@query("""SELECT c_custkey, (CASE WHEN c_custkey % 2 = 0 THEN 'Frame_' ELSE 'frame_' END) || c_custkey AS name, row_number() OVER (ORDER BY c_custkey) AS position FROM customer""")
def natural_sort_rank(spark, sf):
    name = F.concat(F.when(F.col("c_custkey") % 2 == 0, "Frame_").otherwise("frame_"), F.col("c_custkey").cast("string"))
    return ranking.natural_order(table(spark, sf, "customer").select("c_custkey", name.alias("name")), "name", "c_custkey")


@query("""SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC, l_discount DESC, l_orderkey, l_linenumber, l_partkey) = 1""")
def lexicographic_argmax(spark, sf):
    key = F.struct("l_quantity", "l_discount", (-F.col("l_orderkey")).alias("a"), (-F.col("l_linenumber")).alias("b"), (-F.col("l_partkey")).alias("c"))
    best = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.max_by(F.struct("l_orderkey", "l_linenumber", "l_quantity"), key).alias("r"))
    return best.select("l_suppkey", "r.*")


@query("""SELECT p_brand, p_partkey, p_retailprice, s AS second, round(s - p_retailprice, 6) AS gap, coalesce(s - p_retailprice <= 0.5, false) OR 1 / (1 + p_retailprice / 1000) < 0.5 AS ambiguous FROM (SELECT *, lead(p_retailprice) OVER w AS s, row_number() OVER w AS n FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey)) WHERE n = 1""")
def ambiguity_gap(spark, sf):
    rows = table(spark, sf, "part").select("p_brand", "p_partkey", "p_retailprice")
    found = ranking.gap_to_next(rows, ["p_brand"], "p_retailprice", "p_partkey", 0.5)
    return found.withColumn("ambiguous", ranking.ambiguous(F.col("gap"), F.col("p_retailprice") / 1000, 0.5, 0.5)).withColumn("gap", F.round("gap", 6))


EVENTS = "SELECT *, event_type <> 'error' AS scored, event_type <> 'error' AND value > 60 AS good FROM events"
TRIED = f"""s AS ({EVENTS}), r AS (SELECT *, sum(scored::BIGINT) OVER w AS rs, sum(good::BIGINT) OVER w AS rq FROM s WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
    t AS (SELECT * FROM r WHERE rs - scored::BIGINT < 20 AND rq - good::BIGINT < 5)"""


def _tried(spark, sf):
    scored = F.col("event_type") != "error"
    return selection.attempted(table(spark, sf, "events"), [F.col("event_id")], scored, scored & (F.col("value") > 60), 5, 20, ["user_id"])


@query(f"""WITH {TRIED}, n AS (SELECT user_id, count(*) AS pool FROM events GROUP BY 1) SELECT user_id, count(*) AS attempted, CAST(max(rs) AS BIGINT) AS scored, CAST(max(rq) AS BIGINT) AS qualified, CASE WHEN max(rq) >= 5 THEN 'threshold_complete' WHEN count(*) >= any_value(pool) THEN 'candidate_pool_exhausted' ELSE 'score_budget_exhausted' END AS reason, max(rq) < 5 AS fallback FROM t JOIN n USING (user_id) GROUP BY 1""")
def early_stop_budget(spark, sf):
    return selection.outcome(_tried(spark, sf), 5, 20, ["user_id"], table(spark, sf, "events"))


@query(f"""WITH {TRIED} SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rank FROM t WHERE scored QUALIFY rank <= 5""")
def early_stop_topk(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy(F.desc("value"), "event_id")
    return _tried(spark, sf).where("event_type <> 'error'").withColumn("rank", F.row_number().over(w).cast("long")).where("rank <= 5").select("user_id", "event_id", "value", "rank")


@query("""SELECT user_id, event_id, CAST(n AS BIGINT) AS accepted_rank FROM (SELECT *, sum((value > 60)::BIGINT) OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events) WHERE value > 60 AND n <= 3""")
def accept_until_k(spark, sf):
    return selection.accept_until(table(spark, sf, "events"), [F.col("event_id")], F.col("value") > 60, 3, ["user_id"]).select("user_id", "event_id", "accepted_rank")


@query("""WITH g AS (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2), e AS (SELECT *, n * 100 / (sum(n) OVER (PARTITION BY l_returnflag))::DOUBLE AS x FROM g),
    f AS (SELECT *, CAST(floor(x) AS BIGINT) AS fl, row_number() OVER (PARTITION BY l_returnflag ORDER BY round(x - floor(x), 9) DESC, l_linestatus) AS k, 100 - sum(CAST(floor(x) AS BIGINT)) OVER (PARTITION BY l_returnflag) AS left_over FROM e)
    SELECT l_returnflag, l_linestatus, n, CAST(fl + CASE WHEN k <= left_over THEN 1 ELSE 0 END AS BIGINT) AS share FROM f""")
def apportion_largest_remainder(spark, sf):
    by = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    return selection.apportion(by, ["l_returnflag"], "n", "l_linestatus", 100)


@query()
def bottomk_sample(spark, sf):
    """A sampling operator: 100 documents by the hash of their id."""
    return ranking.sample_k(table(spark, sf, "documents"), F.col("doc_id"), 100, seed=3).select("doc_id", "lang", "source")


@query("""SELECT page_id, trim(regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g'), '._') AS label, CASE WHEN url = 'https://www' THEN 'root' WHEN starts_with(url, 'https://www/') THEN 'root' || substr(url, 12) ELSE url END AS rebased, 'page_' || CASE WHEN length(page_id::VARCHAR) >= 3 THEN page_id::VARCHAR ELSE lpad(page_id::VARCHAR, 3, '0') END AS number FROM pages""")
def path_rebase(spark, sf):
    from ..functions.text import label, rebase

    return table(spark, sf, "pages").select("page_id", slug(F.col("url")).alias("label"), rebase(F.col("url"), "https://www", "root").alias("rebased"), label("page_", F.col("page_id"), 3).alias("number"))


@query("""SELECT page_id, CAST(('0x' || substr(sha256('[7, ' || to_json(url)::VARCHAR || ', "a|' || page_id || '"]'), 1, 16)) AS UBIGINT)::DECIMAL(20,0) AS seed FROM pages""")
def derived_seeds(spark, sf):
    """A seed for each scene and camera, from the JSON list of what names them."""
    from ..functions.text import seed64

    return table(spark, sf, "pages").select("page_id", seed64(F.lit(7), F.col("url"), F.concat(F.lit("a|"), F.col("page_id").cast("string"))).alias("seed"))


@query("""WITH a AS (SELECT user_id, event_id, sum((value > 90)::BIGINT) OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events WHERE value > 90), c AS (SELECT user_id, count(*) AS accepted FROM a WHERE n <= 6 GROUP BY 1)
    SELECT user_id, coalesce(accepted, 0) AS accepted FROM (SELECT DISTINCT user_id FROM events) LEFT JOIN c USING (user_id) WHERE coalesce(accepted, 0) < 6""")
def too_few_accepted(spark, sf):
    events = table(spark, sf, "events")
    return selection.too_few(selection.accept_until(events, [F.col("event_id")], F.col("value") > 90, 6, ["user_id"]), events, 6, ["user_id"])
