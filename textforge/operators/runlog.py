"""Run-event analytics: durations, blocks, time to target, evaluation schedule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textforge.operators.ordering import carried


def durations(events: DataFrame, start: Column, stop: Column, time_block: Column, by: list[str],
              order: list[str], ts: str = "ts_us") -> DataFrame:
    """Each start row with the time of the next stop of its run (null if none)."""
    paired = carried(events, by, time_block, order, F.when(stop, F.col(ts)), "stop_us", "min", forward=False)
    return paired.where(start).withColumn("duration_us", F.col("stop_us") - F.col(ts))


def block_steps(saves: DataFrame, by: list[str], step: str, step_block: Column) -> DataFrame:
    """First step and step count of the block that ends at each saved step."""
    seen = carried(saves, by, step_block, [step], F.col(step), "_prev", "max")
    prev = F.coalesce("_prev", F.lit(0))
    return (seen.withColumn("first_step", prev + 1).withColumn("step_count", F.col(step) - prev).drop("_prev"))


def time_to_target(results: DataFrame, by: list[str], target: float = 0.720) -> DataFrame:
    """First evaluation of each run whose accuracy reaches the target."""
    return results.where(F.col("acc") >= target).groupBy(*by).agg(
        F.min("step").alias("step"), F.min_by("ts_us", "step").alias("ts_us"))


def eval_interval(batch: Column) -> Column:
    """Samples between evaluations for a global batch size."""
    return (F.floor(F.lit(0.05) * (F.lit(230.23) * batch + F.lit(3000000.0)) / F.lit(25000.0)) * 25000).cast("long")


def eval_schedule(runs: DataFrame, batch: str, n_samples: str) -> DataFrame:
    """One row per evaluation point, from 0 samples on."""
    every = runs.withColumn("interval", eval_interval(F.col(batch)))
    return every.withColumn("at_samples", F.explode(F.sequence(F.lit(0).cast("long"), F.col(n_samples).cast("long"), F.col("interval"))))


def run_parameters(runs: DataFrame, run: str, batch: str, steps: str, others: list[str]) -> DataFrame:
    """One (run, key, value) row per parameter, with train_samples = batch * steps."""
    wide = runs.withColumn("train_samples", F.col(batch) * F.col(steps))
    return wide.unpivot([run], [batch, steps, "train_samples", *others], "key", "value")


def as_events(rows: DataFrame, kind: str) -> DataFrame:
    """Event rows of kind start, end or point for append_run_events."""
    return rows.withColumn("kind", F.lit(kind))
