"""Run-event analytics; a user is a run."""

from __future__ import annotations

from pyspark.sql import functions as F

from textforge.catalog.inputs import table
from textforge.catalog.registry import query
from textforge.operators import runlog as L

HOUR = 3_600_000_000


def events(spark, sf_dir):
    """Events with microseconds since 2000, whatever the session time zone."""
    base = F.lit("2000-01-01").cast("timestamp_ntz")
    return table(spark, sf_dir, "events").withColumn(
        "ts_us", F.timestamp_diff("MICROSECOND", base, F.col("ts").cast("timestamp_ntz"))).withColumnRenamed("user_id", "run_id")


TS_US = "(epoch_us(ts) - epoch_us(TIMESTAMP '2000-01-01'))"


@query("event_durations", f"""
SELECT run_id, event_id, stop_us - ts_us AS duration_us FROM (
  SELECT user_id AS run_id, event_id, event_type, {TS_US} AS ts_us, min(CASE WHEN event_type = 'purchase' THEN {TS_US} END) OVER (
    PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS stop_us FROM events)
WHERE event_type = 'click'""")
def event_durations(spark, sf_dir):
    rows = events(spark, sf_dir).select("run_id", "event_id", "event_type", "ts_us")
    return L.durations(rows, F.col("event_type") == "click", F.col("event_type") == "purchase", F.floor(F.col("ts_us") / HOUR),
                       ["run_id"], ["ts_us", "event_id"]).select("run_id", "event_id", "duration_us")


@query("block_steps", """
SELECT run_id, step, prev + 1 AS first_step, step - prev AS step_count FROM (
  SELECT user_id AS run_id, event_id + 1 AS step, lag(event_id + 1, 1, 0) OVER (PARTITION BY user_id ORDER BY event_id) AS prev FROM events)""")
def block_steps(spark, sf_dir):
    saves = events(spark, sf_dir).select("run_id", (F.col("event_id") + 1).alias("step"))
    return L.block_steps(saves, ["run_id"], "step", F.floor(F.col("step") / 100_000)).select("run_id", "step", "first_step", "step_count")


@query("time_to_target", f"""
WITH results AS (SELECT user_id AS run_id, event_id AS step, {TS_US} AS ts_us, value / (SELECT max(value) FROM events WHERE event_type = 'view') AS acc
  FROM events WHERE event_type = 'view')
SELECT run_id, min(step) AS step, arg_min(ts_us, step) AS ts_us FROM results WHERE acc >= 0.720::DOUBLE GROUP BY run_id""")
def time_to_target(spark, sf_dir):
    views = events(spark, sf_dir).where(F.col("event_type") == "view")
    top = views.agg(F.max("value")).scalar()
    results = views.select("run_id", F.col("event_id").alias("step"), "ts_us", (F.col("value") / top).alias("acc"))
    return L.time_to_target(results, ["run_id"])


RUNS = """runs AS (SELECT user_id AS run_id, count(*) * 16 AS batch, count(DISTINCT event_type) * 100 AS steps,
  1000000 + count(*) * 10000 AS samples FROM events GROUP BY user_id)"""


def runs(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("run_id")).agg(
        (F.count(F.lit(1)) * 16).alias("batch"), (F.count_distinct("event_type") * 100).alias("steps"),
        (F.count(F.lit(1)) * 10000 + 1000000).alias("samples"))


@query("eval_schedule", f"""WITH {RUNS}
SELECT run_id, batch, step AS at_samples FROM (SELECT run_id, batch, unnest(range(0, samples + 1,
  (floor(0.05::DOUBLE * (230.23::DOUBLE * batch + 3000000) / 25000) * 25000)::BIGINT)) AS step FROM runs)""")
def eval_schedule(spark, sf_dir):
    return L.eval_schedule(runs(spark, sf_dir), "batch", "samples").select("run_id", "batch", "at_samples")


@query("run_params", f"""WITH {RUNS}, wide AS (SELECT *, batch * steps AS train_samples FROM runs)
SELECT run_id, key, value FROM (UNPIVOT wide ON batch, steps, train_samples, samples INTO NAME key VALUE value)""")
def run_params(spark, sf_dir):
    return L.run_parameters(runs(spark, sf_dir), "run_id", "batch", "steps", ["samples"])
