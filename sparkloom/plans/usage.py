"""Usage and cost report with recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fx
from ..functions.numbers import budget_pct, budget_status
from ..operators.aggregates import job_stats, usage_rollup, usage_total
from ..operators.ordering import top_k


def usage_summary(usage: DataFrame, jobs: DataFrame, budget: float, days: int = 30) -> DataFrame:
    """One row: costs, job counts, budget share and status."""
    daily = usage_rollup(usage, "day", "service", "cost", "usage")
    costs = usage_total(daily, days)
    counts = job_stats(jobs, "status")
    both = costs.withColumn("_jobs", counts.select(F.struct("*")).scalar()).select("*", "_jobs.*").drop("_jobs")
    limit = F.lit(float(budget))
    return both.withColumns({"budget_pct": budget_pct("total_cost", limit), "budget_status": budget_status("total_cost", limit)})


def recommendations(summary: DataFrame) -> DataFrame:
    """Advice for what is over its threshold, general advice when nothing is."""
    c = F.col
    found = F.filter(F.array(
        F.when(c("average_daily_cost") > fx.COST_DAILY_ABOVE, F.concat(
            F.lit("High daily average cost ($"), F.format_string("%.2f", c("average_daily_cost")),
            F.lit("). Consider using smaller models or reducing training frequency."))),
        F.when(c("failure_rate") > fx.COST_FAILURE_RATE_ABOVE, F.concat(
            F.lit("High job failure rate ("), F.format_string("%.1f%%", c("failure_rate") * 100),
            F.lit("). Review training data quality and hyperparameters."))),
        F.when(c("running_jobs") > fx.COST_RUNNING_ABOVE, F.concat(
            F.lit("Multiple jobs running ("), c("running_jobs").cast("string"),
            F.lit("). Consider queuing jobs to avoid parallel costs."))),
    ), lambda m: m.isNotNull())
    general = F.array(*[F.lit(m) for m in fx.COST_GENERAL_ADVICE])
    return summary.select(F.posexplode(F.when(F.size(found) > 0, found).otherwise(general)).alias("position", "recommendation"))


def recent_jobs(jobs: DataFrame, k: int = 5) -> DataFrame:
    return top_k(jobs, [("creation_time", "desc"), ("name", "asc")], k)
