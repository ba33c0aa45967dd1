"""Ledgers, contracts and streams."""

import tempfile
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.stats import ratio
from ..operators import ledger
from ..sources.documents import embedded_objects
from ..streaming import ledger as streams
from ..session import table
from . import query


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def ledger_latest_wins(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return ledger.latest(rows, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query("""SELECT 'small_value' AS rule, count(*) FILTER (NOT value >= 1) AS broken FROM events UNION ALL SELECT 'known_type', count(*) FILTER (event_type NOT IN ('view', 'click', 'purchase', 'error')) FROM events
    UNION ALL SELECT 'has_k', count(*) FILTER (NOT coalesce(CAST(json_extract_string(props, '$.k') AS INT) >= 5, false)) FROM events UNION ALL SELECT 'unique_key', CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM events GROUP BY user_id, event_type, CAST(ts AS DATE) HAVING count(*) > 1)""")
def ledger_strict_violations(spark, sf):
    rows = table(spark, sf, "events")
    n = F.count(F.lit(1)).over(Window.partitionBy("user_id", "event_type", F.to_date("ts")))
    rules = {"small_value": F.col("value") >= 1, "known_type": F.col("event_type").isin("view", "click", "purchase", "error"), "has_k": F.get_json_object("props", "$.k").cast("int") >= 5, "unique_key": F.col("n") == 1}
    return ledger.violation_counts(rows.withColumn("n", n), rules)


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def resume_left_anti(spark, sf):
    done = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return ledger.remaining(table(spark, sf, "orders"), done, ["o_orderkey"]).select("o_orderkey", "o_orderstatus")


@query("""SELECT coalesce(c_custkey, k) AS key, CASE WHEN k IS NULL THEN 'missing' ELSE 'unexpected' END AS side FROM customer FULL JOIN (SELECT DISTINCT o_custkey + 3 AS k FROM orders) ON c_custkey = k WHERE c_custkey IS NULL OR k IS NULL""")
def key_reconciliation(spark, sf):
    expected = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"))
    return ledger.reconcile(expected, table(spark, sf, "orders").select((F.col("o_custkey") + 3).alias("key")), ["key"])


@query("""SELECT 'lineitem' AS child, count(*) AS orphans FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')""")
def fk_integrity(spark, sf):
    orders = table(spark, sf, "orders")
    a = ledger.orphans(table(spark, sf, "lineitem"), orders.where("o_orderstatus <> 'P'"), "l_orderkey", "o_orderkey")
    b = ledger.orphans(orders, table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'"), "o_custkey", "c_custkey")
    count = lambda df, n: df.agg(F.lit(n).alias("child"), F.count(F.lit(1)).alias("orphans"))
    return count(a, "lineitem").union(count(b, "orders"))


@query("SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def foreign_key_join(spark, sf):
    """Nations are a fixed list: a broadcast of 25 rows."""
    nation = table(spark, sf, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"))
    return table(spark, sf, "customer").join(F.broadcast(nation), "c_nationkey", "left_semi").select("c_custkey", "c_nationkey")


@query("""SELECT conv_id, bool_or(role = 'system') AS has_first, bool_or(role = 'assistant') AS has_second, CASE WHEN bool_or(role = 'system') AND bool_or(role = 'assistant') THEN 'both' WHEN bool_or(role = 'system') OR bool_or(role = 'assistant') THEN 'partial' ELSE 'neither' END AS state FROM conversations GROUP BY 1""")
def pair_completeness(spark, sf):
    return ledger.completeness(table(spark, sf, "conversations"), "conv_id", F.col("role") == "system", F.col("role") == "assistant")


@query("SELECT user_id, event_type, count(*) AS copies FROM events GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return ledger.duplicates(table(spark, sf, "events"), ["user_id", "event_type"])


@query("""WITH c AS (SELECT o_orderkey, CASE WHEN o_totalprice <= 400000 THEN NULL ELSE 'price' END AS a, CASE WHEN o_orderpriority LIKE '%-%' AND o_orderpriority <> '5-LOW' THEN NULL ELSE 'priority' END AS b, CASE WHEN o_orderstatus IN ('F', 'O') THEN NULL ELSE 'status' END AS s FROM orders)
    SELECT o_orderkey, rule FROM (SELECT o_orderkey, unnest([a, b, s]) AS rule FROM c) WHERE rule IS NOT NULL""")
def validation_rules(spark, sf):
    rules = {"price": F.col("o_totalprice") <= 400000, "priority": F.col("o_orderpriority").like("%-%") & (F.col("o_orderpriority") != "5-LOW"), "status": F.col("o_orderstatus").isin("F", "O")}
    return ledger.violations(table(spark, sf, "orders"), rules, ["o_orderkey"])


@query("""SELECT o_orderkey, 'lines' AS "column" FROM (SELECT l_orderkey AS o_orderkey, count(*) AS n FROM lineitem GROUP BY 1) a FULL JOIN (SELECT o_orderkey, CAST(o_orderkey % 7 + 1 AS BIGINT) AS n FROM orders) b USING (o_orderkey) WHERE a.n IS DISTINCT FROM b.n""")
def summary_agrees(spark, sf):
    """A stored roll-up against the one that rows give."""
    found = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("lines"))
    stored = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 7 + 1).alias("lines"))
    return ledger.agree(found, stored, ["o_orderkey"], ["lines"])


@query("""SELECT event_id, coalesce(try_cast(json_extract_string(props, '$.missing') AS DOUBLE), try_cast(json_extract_string(props, '$.k') AS DOUBLE), value) AS amount, round(value / nullif(try_cast(json_extract_string(props, '$.k') AS DOUBLE), 0), 9) AS share, try_cast(json_extract_string(props, '$.k') AS DOUBLE) % 2 = 1 AS flag FROM events""")
def coalesce_paths(spark, sf):
    path = lambda p: F.expr(f"try_cast(get_json_object(props, '$.{p}') AS double)")
    return table(spark, sf, "events").select("event_id", F.coalesce(path("missing"), path("k"), F.col("value")).alias("amount"), F.round(ratio(F.col("value"), path("k")), 9).alias("share"), (path("k") % 2 == 1).alias("flag"))


@query("SELECT event_id, props AS answer FROM events")
def embedded_json_extract(spark, sf):
    """The last JSON object inside free text that holds two."""
    text = F.concat(F.lit('Sure: {"k": {"x": [1]}} then '), F.col("props"), F.lit(" - done }"))
    return table(spark, sf, "events").select("event_id", embedded_objects(text).alias("answer"))


IDLE = "WITH e AS (SELECT user_id, event_id, CAST(floor(value / 50) AS BIGINT) AS done FROM events), c AS (SELECT *, coalesce(done <> lag(done) OVER w, true)::BIGINT AS changed FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id)), i AS (SELECT *, sum(changed) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM c)"


@query(f"{IDLE} SELECT user_id, CAST(island AS BIGINT) AS island, count(*) AS polls, min(event_id) AS first_event FROM i GROUP BY 1, 2")
def idle_pass_islands(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_id", F.floor(F.col("value") / 50).alias("done"))
    changed = F.col("done") != F.lag("done").over(Window.partitionBy("user_id").orderBy("event_id"))
    return ledger.islands(rows.withColumn("changed", changed), ["user_id"], [F.col("event_id")], F.col("changed")).groupBy("user_id", "island").agg(F.count(F.lit(1)).alias("polls"), F.min("event_id").alias("first_event"))


def _stream(spark, sf):
    return streams.tail(spark, sf, table(spark, sf, "events").schema, glob="events.parquet")


def _folder(spark):
    """In the folder that the cluster shares; one of this machine only where all runs on one machine."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
    return f"{named}/stream-{uuid.uuid4().hex}" if named else tempfile.mkdtemp(prefix="brindle-stream-")


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def streaming_ledger_rollup(spark, sf):
    rolled = streams.roll_up(_stream(spark, sf), ["event_type"], ["event_id"], n=F.count(F.lit(1)), total=F.round(F.sum("value"), 4))
    return streams.drain(rolled, _folder(spark))


@query("SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id)::INT AS rank, value, event_id FROM events QUALIFY rank <= 5")
def streaming_running_top(spark, sf):
    top = streams.running_top(_stream(spark, sf).select("event_type", "value", "event_id"), "event_type", "value", "event_id", 5)
    return streams.drain(top, _folder(spark), "update").groupBy("event_type", "rank").agg(F.max_by(F.struct("value", "event_id"), F.struct("value", -F.col("event_id"))).alias("r")).select("event_type", "rank", "r.*")


@query("SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def streaming_windows(spark, sf):
    """An extra: event-time windows aren't among what ledgers need."""
    by = streams.windowed(_stream(spark, sf).withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 day", "30 days", ["event_type"], n=F.count(F.lit(1)))
    found = streams.drain(by, _folder(spark))
    return found.select(F.col("window.start").cast("timestamp_ntz").alias("day"), "event_type", "n")


@query("""WITH e AS (SELECT user_id, event_id, CAST(floor(value / 50) AS BIGINT) AS completed FROM events), d AS (SELECT *, coalesce(completed <> lag(completed) OVER (PARTITION BY user_id ORDER BY event_id), true)::BIGINT AS changed FROM e), c AS (SELECT *, sum(changed) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM d)
    SELECT user_id, event_id, completed, (row_number() OVER (PARTITION BY user_id, run ORDER BY event_id) - 1)::INT AS idle FROM c""")
def streaming_idle_passes(spark, sf):
    """Polls in a row without progress, kept from batch to batch."""
    polls = _stream(spark, sf).select("user_id", "event_id", F.floor(F.col("value") / 50).alias("completed"))
    return streams.drain(streams.idle_passes(polls, "user_id", "event_id", "completed"), _folder(spark), "append")
