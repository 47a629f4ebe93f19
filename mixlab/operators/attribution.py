"""What each channel adds to the predicted revenue, and what it returns on its spend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mixlab.operators.quantiles import quantile_columns

BASELINE = "baseline"


def _ratio(a: Column, b: Column) -> Column:
    """a / b, NULL where b is 0."""
    return F.try_divide(a, F.nullif(b.cast("double"), F.lit(0.0)))


def roi(df: DataFrame, channels: Sequence[str]) -> DataFrame:
    """``{channel}_roi`` = contribution / spend, NULL on days without spend."""
    return df.withColumns(
        {f"{c}_roi": _ratio(F.col(f"{c}_contribution"), F.col(c)) for c in channels if c in df.columns}
    )


def baseline(df: DataFrame, channels: Sequence[str]) -> DataFrame:
    """What the channels leave of the prediction."""
    total = F.lit(0.0)
    for c in channels:
        total = total + F.col(f"{c}_contribution")
    return df.withColumn("baseline_contribution", F.col("predicted_revenue") - total)


def contribution_pct(df: DataFrame, channels: Sequence[str]) -> DataFrame:
    """``{part}_contribution_pct`` of the row's prediction, for each channel and the baseline."""
    predicted = F.col("predicted_revenue")
    return df.withColumns(
        {
            f"{p}_contribution_pct": _ratio(F.col(f"{p}_contribution"), predicted) * 100
            for p in (*channels, BASELINE)
        }
    )


def contributions(
    df: DataFrame,
    scorer,
    channels: Sequence[str],
    id_cols: Sequence[str] = (),
    target: str = "revenue",
) -> DataFrame:
    """The wide contribution table of a scored panel, one row per id and date.

    A channel counts when its ``{channel}_adstock`` is in the panel; its raw spend
    column stays as it is in the counterfactual.
    """
    present = [c for c in channels if f"{c}_adstock" in df.columns]
    effects = {f"{c}_contribution": f"{c}_adstock" for c in present}
    scored = scorer.effects(df, effects, "predicted_revenue").withColumn("actual_revenue", F.col(target))
    full = contribution_pct(baseline(roi(scored, present), present), present)
    columns = [*id_cols, "date", "actual_revenue", "predicted_revenue"]
    for c in present:
        columns += [f"{c}_contribution", f"{c}_roi"]
    columns.append("baseline_contribution")
    columns += [f"{p}_contribution_pct" for p in (*present, BASELINE)]
    return full.select(*[c for c in columns if c in full.columns])


def actual_vs_predicted(df: DataFrame, scorer, id_cols: Sequence[str] = (), target: str = "revenue") -> DataFrame:
    return scorer.predict(df, "predicted").select(
        *id_cols, "date", F.col(target).alias("actual"), "predicted"
    )


def strip_suffix(col: str = "channel", suffix: str = "_contribution") -> Column:
    return F.regexp_replace(F.col(col), f"{suffix}$", "")


def long_form(df: DataFrame, channels: Sequence[str], id_cols: Sequence[str] = ()) -> DataFrame:
    """(ids, date, channel, contribution) for the channels and the baseline."""
    wanted = [f"{p}_contribution" for p in (*channels, BASELINE)]
    long = df.unpivot([*id_cols, "date"], wanted, "channel", "contribution")
    return long.withColumn("channel", strip_suffix())


def mean_contribution(
    df: DataFrame, channels: Sequence[str], clip: bool = False, id_cols: Sequence[str] = ()
) -> DataFrame:
    """(ids, channel, mean_contribution, share): share is mean / mean prediction * 100,
    shown as at least 0 with ``clip``. All means come from one aggregate."""
    predicted = F.avg("predicted_revenue")
    rows = []
    for p in (*channels, BASELINE):
        mean = F.avg(f"{p}_contribution")
        share = _ratio(mean, predicted) * 100
        rows.append(
            F.struct(
                F.lit(p).alias("channel"),
                mean.alias("mean_contribution"),
                (F.greatest(F.lit(0.0), share) if clip else share).alias("share"),
            )
        )
    return df.groupBy(*id_cols).agg(F.array(*rows).alias("rows")).select(*id_cols, F.inline("rows"))


def median_roi(
    df: DataFrame, channels: Sequence[str], id_cols: Sequence[str] = (), bounded: bool = False
) -> DataFrame:
    """(ids, channel, roi): median daily ROI, days without spend ignored.

    ``bounded`` says that each group holds one series, one row per date, so that one
    task can hold it; without it the median takes the spread-out route.
    """
    present = [c for c in channels if f"{c}_roi" in df.columns]
    medians = quantile_columns(df, [f"{c}_roi" for c in present], {"median": 0.5}, id_cols, bounded=bounded)
    rows = [F.struct(F.lit(c).alias("channel"), F.col(f"{c}_roi_median").alias("roi")) for c in present]
    return medians.select(*id_cols, F.inline(F.array(*rows)))


def weekly(
    df: DataFrame, channels: Sequence[str], mode: str = "year_week", id_cols: Sequence[str] = ()
) -> DataFrame:
    """Mean contributions per week with the week's first date.

    "year_week" groups by calendar year and ISO week (so 1 January may land in
    week 52 of its own year); "trunc" groups by the week's Monday.
    """
    means = [F.avg(f"{p}_contribution").alias(f"{p}_contribution") for p in (*channels, BASELINE)]
    if mode == "trunc":
        week = [F.date_trunc("week", "date").cast("date").alias("week_start")]
    else:
        week = [F.year("date").alias("year"), F.weekofyear("date").alias("week")]
    return df.groupBy(*id_cols, *week).agg(F.min("date").alias("date"), *means)


def roi_extremes(df: DataFrame, n: int = 3, id_cols: Sequence[str] = ()) -> DataFrame:
    """(ids, side, position, channel, roi): the n best and n worst channels."""
    best = W.partitionBy(*id_cols).orderBy(F.desc_nulls_last("roi"), "channel")
    worst = W.partitionBy(*id_cols).orderBy(F.asc_nulls_last("roi"), F.desc("channel"))
    ranked = df.withColumns({"_best": F.row_number().over(best), "_worst": F.row_number().over(worst)})
    sides = F.array(
        F.struct(F.lit("best").alias("side"), F.col("_best").alias("position")),
        F.struct(F.lit("worst").alias("side"), F.col("_worst").alias("position")),
    )
    return ranked.select(*id_cols, "channel", "roi", F.inline(sides)).filter(F.col("position") <= n)


def best_channel(df: DataFrame, id_cols: Sequence[str] = ()) -> DataFrame:
    """(ids, channel, roi) of the highest ROI; equal values go to the first name."""
    first = F.min_by(F.struct("channel", "roi"), F.struct(-F.col("roi"), F.col("channel")))
    return df.filter(F.col("roi").isNotNull()).groupBy(*id_cols).agg(first.alias("best")).select(*id_cols, "best.*")
