"""Contracts of ledgers, manifests, scenes and runs. Line items of two return flags stand for the candidates of two strategies; some of their columns are made faulty by rule, so that every contract has something to find."""

from pyspark.sql import functions as F

from ..functions import sampling, values
from ..operators import contracts, ledger, paired, quantiles, ranking, reports, search
from ..session import table
from . import query
from .experiments import rounded, summary_sql

#: Of a line item: a ledger entry, in expressions that both engines take.
ENTRY = {
    "candidate_index": "l_orderkey * 8 + l_linenumber",
    "strategy": "l_returnflag",
    "schema_version": "CASE WHEN l_quantity = 11 THEN 2 ELSE 1 END",
    "coverage_pass": "l_discount > 0.035",
    "status": "CASE WHEN (l_discount > 0.035) = (l_quantity <> 13) THEN 'ok' ELSE 'coverage_rejected' END",
    "output_ok": "(l_discount > 0.035) = (l_quantity <> 14)",
    "constraints_ok": "l_discount > 0.035",
    "score": "CASE WHEN (l_discount > 0.035) = (l_quantity <> 17) THEN l_discount * 10 END",
    "initial": "l_quantity * 1.0",
    "minimum": "CASE WHEN l_linenumber = 2 THEN l_quantity * 1.0 ELSE l_quantity * 0.25 END",
    "final": "l_quantity * (1 - l_tax)",
    "ratio": "CASE WHEN l_quantity = 19 THEN -1.0 ELSE l_discount + l_tax END",
    "nearest": "l_extendedprice / 100000",
    "preview": "CASE WHEN l_quantity = 21 THEN 0 ELSE l_linenumber END",
    "output": "CASE WHEN l_discount > 0.035 THEN 1 ELSE 0 END",
    "evaluations": "l_linenumber + CASE WHEN l_discount > 0.035 THEN 1 ELSE 0 END",
    "fit": "l_tax * 10",
    "render": "CASE WHEN l_discount > 0.035 THEN l_discount * 100 WHEN l_quantity = 23 THEN 1.0 ELSE 0.0 END",
    "total": "l_tax * 10 + CASE WHEN l_discount > 0.035 THEN l_discount * 100 WHEN l_quantity = 23 THEN 1.0 ELSE 0.0 END + CASE WHEN l_quantity = 29 THEN 0.5 ELSE 0.0 END",
}
DOUBLES = ("score", "initial", "minimum", "final", "ratio", "nearest", "fit", "render", "total")
E_SQL = "e AS (SELECT " + ", ".join(f"CAST({v} AS DOUBLE) AS {k}" if k in DOUBLES else f"{v} AS {k}" for k, v in ENTRY.items()) + " FROM lineitem WHERE l_returnflag IN ('A', 'R'))"


def _entries(spark, sf):
    rows = table(spark, sf, "lineitem").where("l_returnflag IN ('A', 'R')")
    return rows.select(*[F.expr(f"CAST({v} AS DOUBLE)" if k in DOUBLES else v).alias(k) for k, v in ENTRY.items()])


FINE = ", ".join(f"('{x}', count(*) FILTER (NOT coalesce(isfinite({x}) AND {x} >= 0, false)))" for x in ("initial", "minimum", "final", "ratio", "nearest"))
RULES = f"""[('schema', count(*) FILTER (NOT schema_version = 1)), ('status', count(*) FILTER (NOT (status IN ('ok', 'coverage_rejected') AND (status = 'ok') = coverage_pass))), ('score_of_passed', count(*) FILTER (coverage_pass AND score IS NULL)), ('score_of_rejected', count(*) FILTER (NOT coverage_pass AND score IS NOT NULL)),
    ('flags', count(*) FILTER (NOT (output_ok = coverage_pass AND constraints_ok = coverage_pass))), ('evaluations', count(*) FILTER (NOT (preview >= 1 AND evaluations >= 1 AND output >= 0 AND evaluations = preview + output))), ('seconds', count(*) FILTER (NOT (least(fit, render, total) >= 0 AND abs(total - fit - render) <= 1e-7))),
    ('render_of_rejected', count(*) FILTER (NOT coverage_pass AND render <> 0)), {FINE}]"""


@query(f"WITH {E_SQL}, r AS (SELECT unnest({RULES}) AS x FROM e) SELECT x[1] AS rule, x[2] AS broken FROM r".replace("x[1]", "struct_extract(x, 1)").replace("x[2]", "struct_extract(x, 2)"))
def ledger_contract(spark, sf):
    """Each rule of a terminal entry, and how many entries break it."""
    return ledger.violation_counts(_entries(spark, sf), contracts.entry_rules())


@query(f"""WITH {E_SQL}, s AS (SELECT candidate_index // 8 AS k, strategy, bool_and(coverage_pass) AS p, min(ratio) AS r, min(initial) AS i FROM e GROUP BY ALL),
    j AS (SELECT a.k, a.p AS ap, a.r AS ar, a.i AS ai, b.p AS bp, b.r AS br, b.i AS bi FROM s a JOIN s b ON a.k = b.k AND a.strategy = 'A' AND b.strategy = 'R')
    SELECT k, unnest(list_filter([CASE WHEN ap <> (ar >= 0.08) THEN 'a_target' END, CASE WHEN bp <> (br >= 0.08) THEN 'b_target' END, CASE WHEN NOT abs(ai - bi) <= 1e-8 THEN 'initial' END], lambda x: x IS NOT NULL)) AS rule FROM j""")
def pair_contract(spark, sf):
    """What either strategy's entries of an order have in common, as one candidate's pair."""
    one = _entries(spark, sf).withColumn("k", F.expr("candidate_index div 8")).groupBy("k", "strategy").agg(F.bool_and("coverage_pass").alias("coverage_pass"), F.min("ratio").alias("ratio"), F.min("initial").alias("initial"))
    side = lambda s: one.where(F.col("strategy") == s)
    return ledger.violations(paired.pair(side("A"), side("R"), ["k"], ["coverage_pass", "ratio", "initial"]), contracts.pair_rules(0.08), ["k"])


MEASURES = {
    "final_pixel_ratio_all": "ratio", "final_pixel_ratio_passed": "CASE WHEN coverage_pass THEN ratio END", "overshoot_passed": "CASE WHEN coverage_pass THEN ratio - 0.08 END", "score": "CASE WHEN coverage_pass THEN score END", "initial_distance": "initial", "final_distance": "final", "pull_in_distance": "initial - final",
    "final_over_initial": "CASE WHEN initial > 0 THEN final / initial END", "pull_in_fraction": "1 - CASE WHEN initial > 0 THEN final / initial END", "range_retained": "CASE WHEN initial - minimum > greatest(initial, 1) * 1e-12 THEN (final - minimum) / (initial - minimum) END", "nearest_distance": "nearest", "preview_evaluations": "preview", "output_evaluations": "output",
    "evaluations": "evaluations", "fit_seconds": "fit", "render_seconds": "render", "render_seconds_scored": "CASE WHEN coverage_pass THEN render END", "total_seconds": "total",
}


@query(f"WITH {E_SQL}, m AS (SELECT strategy, unnest([{', '.join(repr(k) for k in MEASURES)}]) AS measure, unnest([{', '.join(f'CAST({v} AS DOUBLE)' for v in MEASURES.values())}]) AS value FROM e) SELECT strategy, measure, {summary_sql('value', 5)} FROM m GROUP BY 1, 2")
def strategy_measures(spark, sf):
    return rounded(reports.strategy_measures(_entries(spark, sf), ["strategy"], 0.08), 5)


Z = "(k / n::DOUBLE + 3.8416 / (2 * n) {sign} 1.96 * sqrt(k / n::DOUBLE * (1 - k / n::DOUBLE) / n + 3.8416 / (4 * n::DOUBLE * n))) / (1 + 3.8416 / n)"


@query(f"""WITH {E_SQL}, b AS (SELECT strategy, count(*) AS n, count(*) FILTER (coverage_pass) AS k, count(score) FILTER (coverage_pass) AS s, count(*) FILTER (coverage_pass AND score > 0.7) AS t, sum(evaluations)::BIGINT AS ev, sum(fit) AS fs, sum(render) AS rs, sum(total) AS ts FROM e GROUP BY 1)
    SELECT strategy, n AS candidates, k AS coverage_passes, s AS scores, t AS threshold_passes, ev AS evaluations, round(fs, 4) AS fit_seconds, round(rs, 4) AS render_seconds, round(ts, 4) AS total_seconds, round(k / n::DOUBLE, 6) AS coverage_rate, round({Z.format(sign='-')}, 6) AS coverage_low, round({Z.format(sign='+')}, 6) AS coverage_high,
    round(t / n::DOUBLE, 6) AS threshold_rate, round(t / s::DOUBLE, 6) AS threshold_rate_of_scored, round(k * 1000 / n::DOUBLE, 6) AS coverage_per_thousand, round(t * 1000 / n::DOUBLE, 6) AS threshold_per_thousand, round(n * 3600 / ts, 6) AS candidates_per_hour, round(k * 3600 / ts, 6) AS coverage_per_hour, round(t * 3600 / ts, 6) AS threshold_per_hour, round(ts / t, 6) AS seconds_per_threshold_pass FROM b""")
def strategy_rates(spark, sf):
    df = reports.strategy_rates(_entries(spark, sf), ["strategy"], 0.7)
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.round(c, 4 if c.endswith("_seconds") else 6) for c in df.columns if kinds[c] == "double"})


BEST = f"{E_SQL}, k AS (SELECT strategy, candidate_index, score, row_number() OVER (PARTITION BY strategy ORDER BY score DESC, candidate_index) AS rank FROM e WHERE coverage_pass AND score IS NOT NULL QUALIFY rank <= 10)"
MANIFEST = "CASE WHEN rank = 4 THEN candidate_index + 1 ELSE candidate_index END AS candidate_index, CASE WHEN rank = 6 THEN score + 1e-9 ELSE score END AS score, CASE WHEN rank = 8 THEN score + 0.001 ELSE score + 1e-7 END AS rerender_score"


@query(f"""WITH {BEST}, m AS (SELECT strategy, CASE WHEN rank = 10 AND strategy = 'A' THEN 11 ELSE rank END AS rank, {MANIFEST} FROM k)
    SELECT strategy, rank, unnest(list_filter([CASE WHEN k.candidate_index IS NOT NULL AND m.candidate_index IS NULL THEN 'missing' END, CASE WHEN k.candidate_index IS NULL AND m.candidate_index IS NOT NULL THEN 'unexpected' END, CASE WHEN k.candidate_index <> m.candidate_index THEN 'candidate' END, CASE WHEN abs(k.score - m.score) > 1e-12 THEN 'score' END, CASE WHEN abs(m.rerender_score - m.score) > 1e-5 THEN 'drift' END], lambda x: x IS NOT NULL)) AS rule FROM k FULL JOIN m USING (strategy, rank)""")
def manifest_faults(spark, sf):
    """A stored list of the ten best with one fault of each kind."""
    best = contracts.ranked_best(_entries(spark, sf), ["strategy"], 10).select("strategy", "candidate_index", "score", F.col("rank").cast("long").alias("rank"))
    manifest = best.selectExpr("strategy", "CASE WHEN rank = 10 AND strategy = 'A' THEN 11 ELSE rank END AS rank", *MANIFEST.replace(" AS score,", " AS score;").replace(" AS candidate_index,", " AS candidate_index;").split(";"))
    return contracts.manifest_faults(best, manifest, ["strategy"])


@query(f"WITH {BEST} SELECT count(*) AS common, round(avg(b.score - a.score), 9) AS mean FROM (SELECT rank, score FROM k WHERE strategy = 'A') a JOIN (SELECT rank, score FROM k WHERE strategy = 'R') b USING (rank)")
def top_list_deltas(spark, sf):
    """Ranks stand for candidates that both lists hold."""
    best = contracts.ranked_best(_entries(spark, sf), ["strategy"], 10)
    rows = reports.overlap_deltas(best.where("strategy = 'A'"), best.where("strategy = 'R'"), "rank", "score")
    return rows.agg(F.count(F.lit(1)).alias("common"), F.round(F.avg("delta"), 9).alias("mean"))


@query("""WITH s AS (SELECT n_name AS scene, n_regionkey AS threshold, 'x' AS target FROM nation), c AS (SELECT scene, count(*) AS n FROM s GROUP BY 1), w(scene) AS (VALUES ('FRANCE'), ('CHINA'), ('ATLANTIS'))
    SELECT 'differs' AS rule, 'threshold' AS detail FROM s HAVING count(DISTINCT threshold) > 1 UNION ALL SELECT 'differs', 'target' FROM s HAVING count(DISTINCT target) > 1
    UNION ALL SELECT CASE WHEN c.n IS NULL THEN 'missing' WHEN w.scene IS NULL THEN 'unexpected' ELSE 'twice' END, coalesce(c.scene, w.scene) FROM c FULL JOIN w ON c.scene = w.scene WHERE c.n IS NULL OR w.scene IS NULL OR c.n > 1""")
def pooling_faults(spark, sf):
    scenes = table(spark, sf, "nation").select(F.col("n_name").alias("scene"), F.col("n_regionkey").alias("threshold"), F.lit("x").alias("target"))
    return contracts.not_poolable(scenes, "scene", ["threshold", "target"], ["FRANCE", "CHINA", "ATLANTIS"])


@query("""SELECT n_nationkey, c AS "column" FROM (SELECT n_nationkey, unnest(list_filter([CASE WHEN n_nationkey % 3 = 0 THEN 'n_name' END, CASE WHEN n_nationkey % 5 = 0 THEN 'n_regionkey' END], lambda x: x IS NOT NULL)) AS c FROM nation)""")
def marker_identity(spark, sf):
    """A stored marker of each scene against the settings in force, key by key; texts and numbers are compared as they are."""
    now = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    stored = now.select("n_nationkey", F.when(F.col("n_nationkey") % 3 == 0, F.concat("n_name", F.lit("?"))).otherwise(F.col("n_name")).alias("n_name"), F.when(F.col("n_nationkey") % 5 != 0, F.col("n_regionkey")).alias("n_regionkey"))
    return ledger.agree(now, stored, ["n_nationkey"], ["n_name", "n_regionkey"], tolerance=None)


VERDICT = "CASE WHEN role = 'system' THEN NULL ELSE length(text) > 120 END"


@query(f"WITH c AS (SELECT conv_id, turn, CASE WHEN length(text) % 11 = 0 THEN 'timeout' END AS error, {VERDICT} AS a, lead({VERDICT}) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM conversations) SELECT conv_id, turn, error IS NULL AND coalesce(a, false) AND coalesce(b, false) AS accepted FROM c")
def endpoint_gate(spark, sf):
    from pyspark.sql import Window

    verdict = F.when(F.col("role") != "system", F.length("text") > 120)
    rows = table(spark, sf, "conversations").select("conv_id", "turn", F.when(F.length("text") % 11 == 0, "timeout").alias("error"), verdict.alias("a"))
    rows = rows.withColumn("b", F.lead("a").over(Window.partitionBy("conv_id").orderBy("turn")))
    return rows.select("conv_id", "turn", contracts.gate(F.col("error"), F.col("a"), F.col("b")).alias("accepted"))


@query("""WITH s AS (SELECT o_custkey, CASE WHEN o_custkey % 4 = 0 THEN 'running' ELSE 'completed' END AS status, count(*) AS results, CASE WHEN o_custkey % 7 = 0 THEN NULL WHEN o_custkey % 5 = 0 THEN count(*) + 1 ELSE count(*) END AS cameras, CASE WHEN o_custkey % 3 = 0 THEN count(*) FILTER (o_orderstatus = 'P') END AS render_errors FROM orders GROUP BY 1)
    SELECT o_custkey, coalesce(status = 'completed' AND cameras = results, false) AND coalesce(render_errors, 0) = 0 AS complete FROM s""")
def scene_completeness(spark, sf):
    key, n = F.col("o_custkey"), F.count(F.lit(1))
    by = table(spark, sf, "orders").groupBy("o_custkey").agg(n.alias("results"), F.count_if(F.col("o_orderstatus") == "P").alias("p"))
    cameras = F.when(key % 7 != 0, F.when(key % 5 == 0, F.col("results") + 1).otherwise(F.col("results")))
    done = contracts.scene_complete(F.when(key % 4 == 0, "running").otherwise("completed"), cameras, F.col("results"), F.when(key % 3 == 0, F.col("p")), F.lit(None).cast("long"))
    return by.select("o_custkey", done.alias("complete"))


@query("""WITH v AS (SELECT p_partkey, p_size AS frames, p_size + (p_partkey % 6 = 1)::INT AS wanted_frames, 30 + (p_partkey % 5) * 0.02 AS fps, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_brand END AS echo FROM part)
    SELECT p_partkey, frames = wanted_frames AND abs(fps - 30) <= greatest(1e-3 * greatest(abs(fps), 30), 1e-3) AND echo IS NOT DISTINCT FROM p_brand AS complete FROM v JOIN part USING (p_partkey)""")
def video_completeness(spark, sf):
    """Sizes stand for frames, brands for settings."""
    key, size = F.col("p_partkey"), F.col("p_size")
    found = {"frames": size, "width": F.lit(1920), "height": F.lit(1080), "fps": 30 + (key % 5) * 0.02}
    wanted = {"frames": size + (key % 6 == 1).cast("int"), "width": F.lit(1920), "height": F.lit(1080), "fps": F.lit(30.0)}
    return table(spark, sf, "part").select("p_partkey", contracts.video_complete(found, wanted, [(F.when(key % 4 != 0, F.col("p_brand")), F.col("p_brand"))]).alias("complete"))


@query("""WITH r AS (SELECT user_id, event_id, value < 5 AS complete, value > 97 AS worker_broken, event_type = 'error' AS failed, CASE WHEN event_id % 6 <> 0 THEN value > 40 END AS accepted, event_id % 2 = 0 AS in_valid, event_id % 4 = 0 AS in_invalid FROM events),
    s AS (SELECT *, CASE WHEN complete AND NOT failed THEN 'skipped_existing' WHEN worker_broken THEN 'evaluation_error' WHEN failed THEN 'render_error' WHEN NOT coalesce(accepted, false) THEN 'rejected' ELSE 'generated' END AS status FROM r),
    b AS (SELECT *, coalesce(max((status = 'evaluation_error')::INT) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s)
    SELECT user_id, event_id, status, status IN ('skipped_existing', 'generated') OR (status = 'render_error' AND in_valid AND NOT in_invalid) AS valid FROM b WHERE before = 0""")
def run_outcomes(spark, sf):
    """Events of a user stand for the positions of a scene."""
    v, i = F.col("value"), F.col("event_id")
    rows = table(spark, sf, "events").select("user_id", "event_id", (v < 5).alias("complete"), (v > 97).alias("worker_broken"), (F.col("event_type") == "error").alias("failed"), F.when(i % 6 != 0, v > 40).alias("accepted"), (i % 2 == 0).alias("in_valid"), (i % 4 == 0).alias("in_invalid"))
    return contracts.outcomes(rows, ["user_id"], "event_id").select("user_id", "event_id", "status", "valid")


JSON_TEXT = """CASE event_id % 10 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN '1' WHEN 3 THEN '0' WHEN 4 THEN '-7' WHEN 5 THEN '"1"' WHEN 6 THEN 'null' WHEN 7 THEN '1.5' WHEN 8 THEN props ELSE '[1, 2]' END"""


@query(f"""WITH t AS (SELECT event_id, {JSON_TEXT} AS j FROM events), k AS (SELECT *, json_type(j) AS t FROM t)
    SELECT event_id, CASE t WHEN 'BOOLEAN' THEN 'boolean' WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'number' WHEN 'VARCHAR' THEN 'string' WHEN 'NULL' THEN 'null' WHEN 'OBJECT' THEN 'object' ELSE 'array' END AS kind,
    CASE WHEN t = 'BOOLEAN' THEN j = 'true' WHEN j IN ('0', '1') THEN j = '1' END AS as_boolean, CASE WHEN t IN ('UBIGINT', 'BIGINT') AND j::BIGINT >= 0 THEN j::BIGINT END AS as_integer, CASE WHEN t IN ('UBIGINT', 'BIGINT', 'DOUBLE') AND j::DOUBLE > 0 THEN j::DOUBLE END AS as_positive FROM k""")
def json_values(spark, sf):
    rows = table(spark, sf, "events").select("event_id", values.parsed(F.expr(JSON_TEXT)).alias("v"))
    v = F.col("v")
    return rows.select("event_id", values.kind(v).alias("kind"), values.boolean(v).alias("as_boolean"), values.integer(v, 0).alias("as_integer"), values.number(v, above=0).alias("as_positive"))


JUDGED = """CASE event_id % 8 WHEN 0 THEN '{"valid": true, "artifact": ["a"], "severity": "low"}' WHEN 1 THEN '{"valid": 1, "artifact": [], "severity": "low"}' WHEN 2 THEN '{"valid": true, "artifact": [1], "severity": "low"}' WHEN 3 THEN '{"valid": false, "artifact": [], "severity": "none"}'
    WHEN 4 THEN '{"valid": true, "artifact": []}' WHEN 5 THEN '{"severity": "high", "valid": false, "artifact": [], "more": 1}' WHEN 6 THEN 'no json' ELSE '{"severity": "high", "valid": false, "artifact": []}' END"""


@query("SELECT event_id, CASE event_id % 8 WHEN 1 THEN 'valid' WHEN 2 THEN 'artifact' WHEN 3 THEN 'severity' WHEN 4 THEN 'keys' WHEN 5 THEN 'keys' WHEN 6 THEN 'object' END AS problem FROM events")
def verdict_contract(spark, sf):
    return table(spark, sf, "events").select("event_id", values.verdict_problem(values.parsed(F.expr(JUDGED))).alias("problem"))


@query("""SELECT event_id, coalesce(CASE WHEN event_id % 5 = 0 THEN 'explicit' END, CASE WHEN event_id % 3 = 0 THEN event_type END, 'user' || user_id) AS identity, CASE WHEN event_id % 5 = 0 THEN 'manifest' WHEN event_id % 3 = 0 THEN 'plan' ELSE 'records' END AS source,
    CASE WHEN coalesce(CASE WHEN event_id % 4 = 0 THEN value END, value - 10 + 2) >= 0 THEN round(coalesce(CASE WHEN event_id % 4 = 0 THEN value END, value - 10 + 2), 9) END AS seconds FROM events""")
def identity_cascade(spark, sf):
    i = F.col("event_id")
    identity, source = values.first_of(manifest=F.when(i % 5 == 0, F.lit("explicit")), plan=F.when(i % 3 == 0, F.col("event_type")), records=F.concat(F.lit("user"), F.col("user_id").cast("string")))
    seconds = values.total_seconds(F.when(i % 4 == 0, F.col("value")), F.col("value") - 10, F.lit(2.0))
    return table(spark, sf, "events").select("event_id", identity.alias("identity"), source.alias("source"), F.round(seconds, 9).alias("seconds"))


@query("""SELECT l_partkey, round(avg(abs(1 - l_discount) + 2 * greatest(0.95 - l_discount, 0) + 2 * greatest(l_tax - 0.05, 0)), 9) AS objective, round(avg(greatest(0.05 - l_discount, 0)), 9) AS lacking, round(max(l_extendedprice) - min(l_extendedprice), 4) AS span, round(min(l_discount), 6) AS least, round(max(l_discount), 6) AS most, round(avg(l_discount), 6) AS mean,
    arg_max(l_orderkey * 8 + l_linenumber, struct_pack(p := l_extendedprice, o := -l_orderkey, l := -l_linenumber)) AS largest, arg_min(l_orderkey * 8 + l_linenumber, struct_pack(q := l_quantity, o := l_orderkey, l := l_linenumber)) AS reference FROM lineitem GROUP BY 1""")
def scene_extremes(spark, sf):
    """Line items of a part stand for frames of a scene: its coverage, hinges, spans, and the first of the frames with the largest area and the least focal length."""
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.round(F.avg(reports.coverage_objective(F.col("l_discount"), F.col("l_tax"), 0.95, 0.05)), 9).alias("objective"), F.round(F.avg(reports.hinge(0.05 - F.col("l_discount"))), 9).alias("lacking"),
        F.round(F.max("l_extendedprice") - F.min("l_extendedprice"), 4).alias("span"), F.round(F.min("l_discount"), 6).alias("least"), F.round(F.max("l_discount"), 6).alias("most"), F.round(F.avg("l_discount"), 6).alias("mean"),
        F.max_by(key, F.struct("l_extendedprice", (-F.col("l_orderkey")).alias("o"), (-F.col("l_linenumber")).alias("l"))).alias("largest"), F.min_by(key, F.struct("l_quantity", "l_orderkey", "l_linenumber")).alias("reference"),
    )


@query("""SELECT p_partkey, coalesce(n, 0) AS visible, coalesce(round(m, 4), 0.0) AS largest, f AS first_order FROM part LEFT JOIN (SELECT l_partkey AS p_partkey, count(*) AS n, max(l_extendedprice) AS m, min(l_orderkey) AS f FROM lineitem WHERE l_quantity >= 49 GROUP BY 1) USING (p_partkey)""")
def metrics_with_default(spark, sf):
    """Parts without any such line get a row of zeros."""
    found = table(spark, sf, "lineitem").where("l_quantity >= 49").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("visible"), F.round(F.max("l_extendedprice"), 4).alias("largest"), F.min("l_orderkey").alias("first_order"))
    return reports.with_default(table(spark, sf, "part").select("p_partkey"), found, ["p_partkey"], visible=0, largest=0.0)


@query("""SELECT c_nationkey AS nation, count(*) AS n, round(avg((c_acctbal >= 0)::INT), 6) AS inside, CASE WHEN avg((c_acctbal >= 0)::INT) >= 0.9 THEN 'interior' ELSE 'object' END AS kind FROM customer GROUP BY 1""")
def scene_kinds(spark, sf):
    """Accounts in credit stand for cameras inside the box; the limit is set higher here, as most of them are."""
    share = F.avg((F.col("c_acctbal") >= 0).cast("int"))
    by = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("n"), share.alias("s"))
    return by.select("nation", "n", F.round("s", 6).alias("inside"), sampling.scene_kind(F.col("s") - 0.4).alias("kind"))


@query("""SELECT s_nationkey, bool_and(abs(s_acctbal - f) <= greatest(1e-9 * greatest(abs(s_acctbal), abs(f)), 1e-9)) AS fixed FROM (SELECT s_nationkey, CASE WHEN s_nationkey % 2 = 0 THEN 7.0 ELSE s_acctbal END AS s_acctbal, first_value(CASE WHEN s_nationkey % 2 = 0 THEN 7.0 ELSE s_acctbal END) OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS f FROM supplier) GROUP BY 1""")
def fixed_intrinsics(spark, sf):
    """Every camera's focal length against that of the first."""
    from ..functions.stats import close

    rows = table(spark, sf, "supplier").select("s_nationkey", "s_suppkey", F.when(F.col("s_nationkey") % 2 == 0, 7.0).otherwise(F.col("s_acctbal")).alias("f"))
    first = rows.groupBy("s_nationkey").agg(F.min_by("f", "s_suppkey").alias("first"))
    return rows.join(first, "s_nationkey").groupBy("s_nationkey").agg(F.bool_and(close(F.col("f"), F.col("first"), 1e-9, 1e-9)).alias("fixed"))


@query("""WITH i AS (SELECT range AS i FROM range(500)), f AS (SELECT i, (0.1 + i * 0.6180339887498949) - floor(0.1 + i * 0.6180339887498949) AS a, (0.2 + i * 0.7548776662466927) - floor(0.2 + i * 0.7548776662466927) AS b, (0.3 + i * 0.5698402909980532) - floor(0.3 + i * 0.5698402909980532) AS c FROM i),
    g AS (SELECT i, -1.0 + a * 3.0 AS t, asin(sin(-0.5) + b * (sin(0.9) - sin(-0.5))) AS e, (1.5 + 2.5 * c * c) * 2 AS d FROM f) SELECT i AS attempt, round(1 + d * cos(e) * cos(t), 6) AS x, round(2 + d * cos(e) * sin(t), 6) AS y, round(3 + d * sin(e), 6) AS z FROM g""")
def shell_positions(spark, sf):
    """The first 500 positions of a shell about a centre."""
    unit = lambda *v: tuple(map(F.lit, v))
    frame = unit(1.0, 0.0, 0.0), unit(0.0, 1.0, 0.0), unit(0.0, 0.0, 1.0)
    at = sampling.on_shell(F.col("id"), (0.1, 0.2, 0.3), (-1.0, 2.0), (-0.5, 0.9), (1.5, 4.0), frame, unit(1.0, 2.0, 3.0), 2.0)
    return spark.range(500).select(F.col("id").alias("attempt"), *[F.round(v, 6).alias(c) for v, c in zip(at, "xyz", strict=True)])


@query("""WITH i AS (SELECT range AS i FROM range(9)) SELECT i, round(-180 + i * 40.0, 9) AS around, round(30 + CASE WHEN i = 4 THEN 0 ELSE -45 + i * 90.0 / 8 END, 9) AS about, round(10 + [0, -0.5, 0.5, -1, 1][i % 5 + 1] * 20, 9) AS pitch, round(CASE WHEN i = 0 THEN 0 ELSE sin(2 * pi() * 2 * (i / 8.0) / 3 + 0.4) END, 9) AS motion FROM i""")
def orientation_grid(spark, sf):
    i = F.col("id")
    return spark.range(9).select(i.alias("i"), F.round(sampling.yaw_grid(i, 9, None, 0), 9).alias("around"), F.round(sampling.yaw_grid(i, 9, 30.0, 90.0), 9).alias("about"), F.round(sampling.pitch_grid(i, 10.0, 40.0), 9).alias("pitch"), F.round(sampling.slow_motion(i / 8, 1, 0.4, 3), 9).alias("motion"))


@query("""WITH p AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings)
    SELECT vec_id, round(least(CASE WHEN x > 1e-12 THEN 1.0 / x WHEN x < -1e-12 THEN -1.5 / x END, CASE WHEN y > 1e-12 THEN 1.0 / y WHEN y < -1e-12 THEN -1.5 / y END, CASE WHEN z > 1e-12 THEN 1.0 / z WHEN z < -1e-12 THEN -1.5 / z END) + 0.1 * 2 + 2e-9, 5) AS distance FROM p""")
def exterior_distances(spark, sf):
    way = tuple(F.get("embedding", F.lit(i)).cast("double") for i in range(3))
    return table(spark, sf, "embeddings").select("vec_id", F.round(sampling.exterior_distance(way, [-1.5] * 3, [1.0] * 3, [0.0] * 3, 2.0, 0.1), 5).alias("distance"))


@query("""SELECT p_partkey, p_name, s_name FROM (SELECT p_partkey, p_name FROM part WHERE p_partkey <= 5) JOIN (SELECT s_suppkey AS p_partkey, s_name FROM supplier WHERE s_suppkey <= 5) USING (p_partkey)""")
def merged_lenses(spark, sf):
    """Two lists that must name the same lenses, once each."""
    a = table(spark, sf, "part").where("p_partkey <= 5").select("p_partkey", "p_name")
    return contracts.merged_by_name(a, table(spark, sf, "supplier").where("s_suppkey <= 5").select(F.col("s_suppkey").alias("p_partkey"), "s_name"), "p_partkey")


@query("""SELECT user_id, event_id, b AS before, value FROM (SELECT user_id, event_id, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS b, value FROM events) WHERE value > b + 20""")
def rank_order_faults(spark, sf):
    rows = contracts.not_falling(table(spark, sf, "events").select("user_id", "event_id", "value"), ["user_id"], "event_id", "value", 20.0)
    return rows.select("user_id", "event_id", "before", "value")


@query("""WITH r AS (SELECT p_brand, p_partkey, p_retailprice AS loss, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) AS k FROM part), t AS (SELECT *, loss / (1 + p_partkey % 3) AS refined FROM r WHERE k <= 4), s AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY refined, p_partkey) AS place FROM t)
    SELECT p_brand, p_partkey, place, round(refined, 6) AS refined FROM s""")
def coarse_to_fine(spark, sf):
    """The four best of each brand by a first loss, sorted again by a better one."""
    rows = table(spark, sf, "part").select("p_brand", "p_partkey", F.col("p_retailprice").alias("loss"))
    return ranking.coarse_to_fine(rows, ["p_brand"], F.col("loss"), F.col("loss") / (1 + F.col("p_partkey") % 3), "p_partkey", 4).select("p_brand", "p_partkey", "place", F.round("refined", 6).alias("refined"))


@query(f"WITH {E_SQL} SELECT strategy, count(*) AS n, round(quantile_cont(score, 0.99), 9) AS top FROM e GROUP BY 1")
def score_tails(spark, sf):
    rows, score = _entries(spark, sf), F.col("score")
    by = quantiles.with_quantiles(rows.groupBy("strategy").agg(F.count(F.lit(1)).alias("n")), rows, ["strategy"], {"top": (score, 0.99)})
    return by.withColumn("top", F.round("top", 9))


@query("""WITH c AS (SELECT vec_id, embedding[1]::DOUBLE * 3 AS a FROM embeddings)
    SELECT vec_id, unnest(list_filter([CASE WHEN vec_id % 17 = 0 THEN 'finite' END, CASE WHEN vec_id % 11 = 0 THEN 'last_row' END, CASE WHEN vec_id % 7 = 0 THEN 'orthonormal' END, CASE WHEN vec_id % 7 = 0 THEN 'determinant' END, CASE WHEN vec_id % 5 = 0 OR vec_id % 17 = 0 THEN 'position' END, CASE WHEN vec_id % 13 = 0 THEN 'fov' END], lambda x: x IS NOT NULL)) AS rule FROM c""")
def camera_contract(spark, sf):
    """Turned cameras, of which some are stretched, shifted, not finite or too wide."""
    i, a = F.col("vec_id"), F.get("embedding", F.lit(0)).cast("double") * 3
    scale = F.when(i % 7 == 0, 1.01).otherwise(1.0)
    zero, one = F.lit(0.0), F.lit(1.0)
    matrix = F.array(F.cos(a) * scale, -F.sin(a), zero, one, F.sin(a) * scale, F.cos(a), zero, F.lit(2.0), zero, zero, one, F.lit(3.0), F.when(i % 11 == 0, 0.1).otherwise(0.0), zero, zero, one)
    position = F.array(F.when(i % 17 == 0, float("inf")).when(i % 5 == 0, 1.001).otherwise(1.0), F.lit(2.0), F.lit(3.0))
    fov = 60 + F.when(i % 13 == 0, 120.0).otherwise(0.0)
    rows = table(spark, sf, "embeddings").select("vec_id", matrix.alias("m"), position.alias("p"), fov.alias("fov"))
    return ledger.violations(rows, contracts.camera_rules(F.col("m"), F.col("p"), F.col("fov")), ["vec_id"])


@query("""WITH l AS (SELECT p.p_brand, count(q.p_partkey) AS lens_index, p.p_size AS n FROM part p LEFT JOIN part q ON q.p_brand = p.p_brand AND q.p_partkey < p.p_partkey GROUP BY p.p_brand, p.p_partkey, p.p_size HAVING count(q.p_partkey) < 4),
    c AS (SELECT *, n % 5 AS name, lens_index + (n % 3) * 0.5 AS lo, lens_index + (n % 3) * 0.5 + 0.6 AS hi, (n % 10) / 10.0 AS position FROM l),
    r AS (SELECT c.*, (SELECT count(*) FROM c d WHERE d.p_brand = c.p_brand AND d.name = c.name) AS same, b.hi AS before, round_even(c.position * (c.n - 1), 0) AS jump FROM c LEFT JOIN c b ON b.p_brand = c.p_brand AND b.lens_index = c.lens_index - 1),
    x AS (SELECT p_brand, lens_index, same > 1 AS f1, coalesce(lo <= before, false) AS f2, n < 1 AS f3, n < 2 AND hi > lo AS f4, 6 > n - jump AS f5, lens_index > 0 AND 8 > n AS f6 FROM r)
    SELECT p_brand, lens_index, 'name' AS rule FROM x WHERE f1 UNION ALL SELECT p_brand, lens_index, 'order' FROM x WHERE f2 UNION ALL SELECT p_brand, lens_index, 'frames' FROM x WHERE f3 UNION ALL SELECT p_brand, lens_index, 'ends' FROM x WHERE f4 UNION ALL SELECT p_brand, lens_index, 'jump' FROM x WHERE f5 UNION ALL SELECT p_brand, lens_index, 'switch' FROM x WHERE f6
    UNION ALL SELECT p_brand, NULL, 'total' FROM c GROUP BY 1 HAVING sum(n) <> 100""")
def lens_contract(spark, sf):
    """The first four parts of a brand stand for the lenses of a configuration."""
    from pyspark.sql import Window

    rows = table(spark, sf, "part").withColumn("lens_index", (F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey")) - 1).cast("long")).where("lens_index < 4")
    n, start = F.col("p_size"), F.col("lens_index") + (F.col("p_size") % 3) * 0.5
    lenses = rows.select("p_brand", "lens_index", (n % 5).alias("name"), start.alias("zoom_min"), (start + 0.6).alias("zoom_max"), n.alias("frame_count"), ((n % 10) / 10).alias("position"))
    return contracts.lens_faults(lenses, "p_brand", 100, 6, 8)


@query("SELECT vec_id, round(embedding[1]::DOUBLE * 2 + 1, 6) AS quality FROM embeddings")
def boundary_scores(spark, sf):
    """A scorer that is loaded once for each task; a formula takes the place of a model."""
    def load():
        return lambda rows: rows["x"] * 2 + 1

    rows = table(spark, sf, "embeddings").select("vec_id", F.get("embedding", F.lit(0)).cast("double").alias("x"))
    return search.scored(rows, load, "quality").select("vec_id", F.round("quality", 6).alias("quality"))


@query(f"""WITH {E_SQL} SELECT strategy, count(*) AS n, count(*) FILTER (coverage_pass AND coalesce(score > 0.7, false)) AS accepted, count(score) AS judged, count(*) FILTER (ratio >= 0.08) AS met, sum(preview + output)::BIGINT AS parts, sum(evaluations)::BIGINT AS total FROM e GROUP BY 1""")
def nested_documents(spark, sf):
    """Entries as documents, written as JSON and read again."""
    document = reports.capture_document(0.7, 0.08)
    rows = _entries(spark, sf).select(document.alias("d"))
    schema = rows.schema["d"].dataType
    read = rows.select(F.from_json(F.to_json("d", {"ignoreNullFields": "false"}), schema).alias("d"))
    return read.groupBy(F.col("d.candidate.strategy").alias("strategy")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("d.accepted").alias("accepted"), F.count("d.image_quality").alias("judged"), F.count_if("d.coverage.constraints_met").alias("met"),
        F.sum(F.col("d.coverage.evaluations.preview") + F.col("d.coverage.evaluations.output")).cast("long").alias("parts"), F.sum("d.coverage.evaluations.total").cast("long").alias("total"),
    )


@query("""SELECT label, CASE WHEN min(abs(embedding[1]::DOUBLE)) / 2 < 0.01 AND greatest(max(embedding[1]::DOUBLE) - min(embedding[1]::DOUBLE), max(embedding[2]::DOUBLE) - min(embedding[2]::DOUBLE), max(embedding[3]::DOUBLE) - min(embedding[3]::DOUBLE)) / greatest(least(max(embedding[1]::DOUBLE) - min(embedding[1]::DOUBLE), max(embedding[2]::DOUBLE) - min(embedding[2]::DOUBLE), max(embedding[3]::DOUBLE) - min(embedding[3]::DOUBLE)), 1e-9) < 2 THEN 'object' ELSE 'interior' END AS kind FROM embeddings GROUP BY 1""")
def inferred_kinds(spark, sf):
    at = lambda i: F.get("embedding", F.lit(i)).cast("double")
    span = lambda i: F.max(at(i)) - F.min(at(i))
    by = table(spark, sf, "embeddings").groupBy("label").agg(F.min(F.abs(at(0))).alias("c"), *(span(i).alias(f"e{i}") for i in range(3)))
    return by.select("label", sampling.inferred_kind(F.col("c"), F.lit(2.0), tuple(F.col(f"e{i}") for i in range(3))).alias("kind"))


@query("""WITH z AS (SELECT a.frame, a.x, b.y FROM (SELECT row_number() OVER (ORDER BY vec_id) AS frame, embedding[1]::DOUBLE AS x FROM embeddings) a JOIN (SELECT row_number() OVER (ORDER BY vec_id DESC) AS frame, embedding[2]::DOUBLE AS y FROM embeddings) b USING (frame)) SELECT frame, round(x, 6) AS x, round(y, 6) AS y FROM z""")
def zipped_frames(spark, sf):
    """Two lists of frames, matched by place."""
    rows = table(spark, sf, "embeddings")
    side = lambda order, i, name: ranking.rank_all(rows.select("vec_id", F.round(F.get("embedding", F.lit(i)).cast("double"), 6).alias(name)), [order], "frame").select("frame", name)
    return side(F.col("vec_id"), 0, "x").join(side(F.col("vec_id").desc(), 1, "y"), "frame")
