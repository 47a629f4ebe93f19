"""Report tables: small ordered results at the end of a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixlab.operators.attribution import long_form, mean_contribution, median_roi, roi_extremes
from mixlab.operators.profile import top_k


def report_metrics(metrics: DataFrame) -> DataFrame:
    """r2 to 4 places, the others to 2."""
    return metrics.select(
        F.round("r2", 4).alias("r2"),
        *[F.round(c, 2).alias(c) for c in ("rmse", "mae", "mape")],
    )


def report_contributions(contributions: DataFrame, channels: Sequence[str]) -> DataFrame:
    return mean_contribution(contributions, channels).orderBy(F.desc("mean_contribution"), "channel")


def report_roi(contributions: DataFrame, channels: Sequence[str]) -> DataFrame:
    return median_roi(contributions, channels, bounded=True).orderBy(F.desc_nulls_last("roi"), "channel")


def report_budget(budget: DataFrame) -> DataFrame:
    return budget.select("channel", "budget", "budget_pct", "roi").orderBy(F.desc("budget"), "channel")


def report_top_features(importance: DataFrame, k: int = 15) -> DataFrame:
    return top_k(importance, "importance", k, ["feature"])


def report_findings(contributions: DataFrame, channels: Sequence[str], n: int = 3) -> DataFrame:
    """One row: the n best and n worst channels, both listed by falling ROI, and the baseline's share."""
    sides = roi_extremes(median_roi(contributions, channels, bounded=True), n)

    def names(side: str):
        entry = F.struct((-F.col("roi")).alias("rank"), F.col("channel"))
        entries = F.collect_list(F.when(F.col("side") == side, entry))
        return F.array_join(F.transform(F.array_sort(entries), lambda e: e["channel"]), ", ")

    share = mean_contribution(contributions, channels).filter(F.col("channel") == "baseline")
    return sides.agg(names("best").alias("best"), names("worst").alias("worst")).withColumn(
        "baseline_share", share.select("share").scalar()
    )


def contributions_over_time(contributions: DataFrame, channels: Sequence[str]) -> DataFrame:
    return long_form(contributions, channels)


def contribution_composition(contributions: DataFrame, channels: Sequence[str]) -> DataFrame:
    """Baseline first, then the channels, per date."""
    parts = ["baseline", *channels]
    return contributions.select("date", *[F.col(f"{p}_contribution").alias(p) for p in parts]).orderBy("date")
