"""Budget allocation under per-channel limits, and what-if scenarios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_DOUBLE = "double"


def allocate_budget(
    roi: DataFrame,
    total: float = 100000.0,
    min_pct: float = 0.05,
    max_pct: float = 0.4,
    id_cols: Sequence[str] = (),
) -> DataFrame:
    """(ids, channel, budget, budget_pct, roi) by the sequential rule.

    Every channel starts at the minimum. The rest goes to channels with positive
    ROI, best first, in proportion to ROI; a channel that would pass the maximum
    is cut to it, and the cut part becomes the whole rest. What then remains is
    spread evenly. Since each step depends on the one before, a group's channels
    (one row each, no more than the configured list) are folded in ROI order.
    """
    low, high = float(total) * min_pct, float(total) * max_pct
    entry = F.struct(
        F.coalesce(-F.col("roi"), F.lit(float("inf"))).alias("rank"), F.col("channel"), F.col("roi")
    )
    ordered = roi.groupBy(*id_cols).agg(F.array_sort(F.collect_list(entry)).alias("_c"))

    positive = F.aggregate(
        "_c", F.lit(0.0), lambda acc, c: acc + F.when(c["roi"] > 0, c["roi"]).otherwise(0.0)
    )
    prepared = ordered.withColumns(
        {"_sum": positive, "_rest": F.lit(float(total)) - F.lit(low) * F.size("_c")}
    )

    def step(acc: Column, c: Column) -> Column:
        share = acc["rest"] * (c["roi"] / F.col("_sum"))
        reached = F.lit(low) + share
        takes = (F.col("_rest") > 0) & (c["roi"] > 0)
        over = reached > high
        budget = F.when(takes, F.when(over, F.lit(high)).otherwise(reached)).otherwise(F.lit(low))
        rest = F.when(takes, F.when(over, reached - high).otherwise(acc["rest"] - share)).otherwise(acc["rest"])
        row = F.struct(c["channel"].alias("channel"), c["roi"].alias("roi"), budget.alias("budget"))
        return F.struct(rest.alias("rest"), F.concat(acc["rows"], F.array(row)).alias("rows"))

    start = F.struct(
        F.col("_rest").alias("rest"),
        F.expr("CAST(array() AS array<struct<channel:string,roi:double,budget:double>>)").alias("rows"),
    )
    folded = prepared.withColumn("_f", F.aggregate("_c", start, step))
    even = F.col("_f.rest") / F.size("_c")
    spread = F.when(
        (F.col("_f.rest") > 0) & (F.col("budget") < high),
        F.col("budget") + F.least(even, F.lit(high) - F.col("budget")),
    ).otherwise(F.col("budget"))
    return (
        folded.select(*id_cols, "_f", "_c", F.inline("_f.rows"))
        .withColumn("budget", spread)
        .select(*id_cols, "channel", "budget", (F.col("budget") / F.lit(float(total)) * 100).alias("budget_pct"), "roi")
    )


def allocate_budget_conserving(
    roi: DataFrame,
    total: float = 100000.0,
    min_pct: float = 0.05,
    max_pct: float = 0.4,
    id_cols: Sequence[str] = (),
) -> DataFrame:
    """The same limits with nothing lost: budgets sum to the total whenever the limits allow it.

    Positive channels share what exceeds the minimum in proportion to ROI; those
    that would pass the maximum stop there and the others share their surplus.
    The stopped channels are a prefix in ROI order, so window sums suffice.
    """
    low, high = float(total) * min_pct, float(total) * max_pct
    room = high - low
    group = [F.col(c) for c in id_cols] or [F.lit(0)]
    whole = W.partitionBy(*group)
    order = whole.orderBy(F.desc_nulls_last("roi"), "channel")
    positive = F.col("roi") > 0
    value = F.when(positive, F.col("roi")).otherwise(0.0)
    ranked = roi.withColumns(
        {
            "_i": F.row_number().over(order),
            "_n": F.count("*").over(whole),
            "_p": F.count_if(positive).over(whole),
            "_tail": F.sum(value).over(order.rowsBetween(0, W.unboundedFollowing)),
        }
    ).withColumn("_rest", F.lit(float(total)) - F.col("_n") * low)
    reach = (F.col("_rest") - (F.col("_i") - 1) * room) * F.try_divide(value, F.col("_tail"))
    capped = ranked.withColumn("_cap", F.coalesce(positive & (reach > room), F.lit(False))).withColumns(
        {
            "_m": F.count_if("_cap").over(whole),
            "_open": F.sum(F.when(~F.col("_cap"), value).otherwise(0.0)).over(whole),
        }
    )
    shared = F.lit(low) + (F.col("_rest") - F.col("_m") * room) * F.try_divide(value, F.nullif(F.col("_open"), F.lit(0.0)))
    surplus = F.when(F.col("_p") == F.col("_m"), F.col("_rest") - F.col("_p") * room).otherwise(0.0)
    idle = F.lit(low) + F.coalesce(F.try_divide(surplus, F.col("_n") - F.col("_p")), F.lit(0.0))
    budget = (
        F.when(F.col("_rest") <= 0, F.lit(low))
        .when(F.col("_cap"), F.lit(high))
        .when(positive, shared)
        .otherwise(idle)
    )
    return capped.withColumn("budget", budget).select(
        *id_cols, "channel", "budget", (F.col("budget") / F.lit(float(total)) * 100).alias("budget_pct"), "roi"
    )


def total_budget(budget: DataFrame) -> DataFrame:
    return budget.agg(F.sum("budget").alias("total_budget"))


def default_allocation(budget: DataFrame, channels: Sequence[str]) -> DataFrame:
    """(channel, allocation_pct) of every listed channel: its budget share, else 100 / n."""
    n = len(channels)
    names = F.array(*[F.lit(c) for c in channels])
    listed = budget.sparkSession.range(1).select(F.explode(names).alias("channel"))
    share = F.coalesce(F.col("budget_pct"), F.lit(100.0 / n)).alias("allocation_pct")
    return listed.join(budget.select("channel", "budget_pct"), "channel", "left").select("channel", share)


def simulate_scenarios(scenarios: DataFrame, roi: DataFrame) -> DataFrame:
    """(scenario, channel, budget, budget_pct, roi, contribution) for many scenarios at once.

    ``scenarios`` has (scenario, channel, allocation_pct, total_budget), one row per
    channel; allocations are scaled to sum to 100. A channel without ROI returns 0.
    """
    per_scenario = W.partitionBy("scenario")
    sum_pct = F.sum("allocation_pct").over(per_scenario)
    pct = F.when(sum_pct > 0, F.col("allocation_pct") * (F.lit(100.0) / sum_pct)).otherwise(F.col("allocation_pct"))
    weighed = scenarios.withColumn("budget_pct", pct.cast(_DOUBLE)).withColumn(
        "budget", F.col("budget_pct") / 100 * F.col("total_budget")
    )
    return (
        weighed.join(roi.select("channel", "roi"), "channel", "left")
        .withColumn("roi", F.coalesce("roi", F.lit(0.0)))
        .select(
            "scenario", "channel", "budget", "budget_pct", "roi",
            (F.col("budget") * F.col("roi")).alias("contribution"),
        )
    )


def mean_baseline(contributions: DataFrame, n_days: int = 1) -> DataFrame:
    """One row, ``baseline``: the mean daily baseline, times the days the budget is for."""
    return contributions.agg((F.avg("baseline_contribution") * n_days).alias("baseline"))


def append_baseline(rows: DataFrame, baseline: DataFrame, name: str = "Baseline") -> DataFrame:
    """Add the baseline row (budget 0, ROI 0) to every scenario.

    It follows the last channel, doubled in place in the window over scenarios that the rows come
    from, so nothing below is run twice and sums add the baseline last.
    """
    values = ("channel", "budget", "budget_pct", "roi", "contribution")
    zero = F.lit(0.0)
    mean = baseline.select("baseline").scalar()
    own = F.struct(*[F.col(c) for c in values])
    extra = F.struct(F.lit(name).alias("channel"), zero.alias("budget"), zero.alias("budget_pct"), zero.alias("roi"), mean.alias("contribution"))
    by_channel = W.partitionBy("scenario").orderBy("channel")
    last = F.row_number().over(by_channel) == F.count(F.lit(1)).over(W.partitionBy("scenario"))
    doubled = rows.withColumn("_last", last).select("scenario", F.inline(F.when(F.col("_last"), F.array(own, extra)).otherwise(F.array(own))))
    return doubled.select(*rows.columns)


def drop_baseline(rows: DataFrame, name: str = "Baseline") -> DataFrame:
    return rows.filter(F.col("channel") != name)


def compare_scenarios(table: DataFrame, name: str = "Baseline") -> DataFrame:
    """(scenario, total_budget, marketing, total_sales, overall_roi) from the scenario table."""
    paid = F.col("channel") != name
    totals = table.groupBy("scenario").agg(
        F.sum("budget").alias("total_budget"),
        F.sum(F.when(paid, F.col("contribution")).otherwise(0.0)).alias("marketing"),
        F.sum("contribution").alias("total_sales"),
    )
    roi = F.when(F.col("total_budget") > 0, F.col("marketing") / F.col("total_budget")).otherwise(0.0)
    return totals.withColumn("overall_roi", roi)
