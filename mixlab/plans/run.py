"""A whole run: from transactions to metrics, contributions and a budget."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixlab.config import MixConfig
from mixlab.operators.attribution import contributions, median_roi
from mixlab.operators.budget import allocate_budget
from mixlab.operators.features import holidays, lag_features, rolling_features, seasonality
from mixlab.operators.leafwise import Boosting, gain_importance, train_leafwise
from mixlab.operators.model import cross_validate, evaluate, feature_columns, importance, param_search, train_gbt, train_linear
from mixlab.operators.panel import finish_panel, join_spend, pivot_spend, time_split
from mixlab.operators.prep import (
    date_range,
    exclude_returns,
    fill_missing,
    iqr_outliers,
    line_amount,
    parse_date,
    standardize,
    zero_fill,
)
from mixlab.operators.profile import daily_sales
from mixlab.operators.simulate import simulate_external, simulate_spend
from mixlab.session import stage


@dataclass(frozen=True)
class MixResult:
    panel: DataFrame
    train: DataFrame
    test: DataFrame | None
    metrics: DataFrame | None
    importance: DataFrame | None
    contributions: DataFrame
    roi: DataFrame
    budget: DataFrame
    validation: DataFrame | None = None
    channel_params: dict | None = None


def clean_transactions(transactions: DataFrame, config: MixConfig) -> DataFrame:
    """Dated lines with their amount, returns and dates outside the range left out."""
    dated = parse_date(transactions, "InvoiceDate")
    kept = date_range(dated, config.start_date, config.end_date, "InvoiceDate")
    return line_amount(exclude_returns(kept, config.include_returns))


def sales_features(sales: DataFrame, config: MixConfig) -> DataFrame:
    """Outliers out, gaps filled, calendar and holiday columns as configured."""
    if config.remove_outliers:
        sales = iqr_outliers(sales, "revenue", config.outlier_threshold, bounded=True)
    sales = fill_missing(sales, config.fill_strategy, bounded=True)
    if config.seasonality:
        sales = seasonality(sales)
    return holidays(sales) if config.holidays else sales


def spend_features(spend: DataFrame, config: MixConfig) -> tuple[DataFrame, list[str]]:
    """Lag and rolling columns of the long spend, and their names."""
    out = spend
    if config.lags:
        out = lag_features(out, ["spend"], config.lags, ["channel"])
    if config.windows:
        out = rolling_features(out, ["spend"], config.windows, ["channel"])
    return out, [c for c in out.columns if c not in spend.columns]


def tuned_params(base: DataFrame, config: MixConfig, max_lag: int = 10) -> dict:
    """The channels' parameters with the best grid point of each, over the days that train.

    A channel whose spend never varies keeps its own. The driver sees one row per channel.
    """
    days = time_split(base, config.train_end_date)[0] if config.train_end_date else base
    best = param_search(zero_fill(days, ["date"]), config.channels, config.tuning_grid, max_lag=max_lag)
    found = {
        r["channel"]: {"decay_rate": r["decay_rate"], "max_lag": max_lag, "saturation_type": "hill", "k": r["k"], "S": r["S"]}
        for r in best.collect()
    }
    return {**config.channel_params, **found}


def normalized(panel: DataFrame, names: list[str], config: MixConfig) -> DataFrame:
    """Features that belong to no channel as deviations from their mean, 0 where they never vary.

    Spend and its transforms stay as they are: contributions compare them with no spend.
    """
    controls = [c for c in names if not any(c == ch or c.startswith(f"{ch}_") for ch in config.channels)]
    scaled = standardize(panel, controls)
    return scaled.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in controls})


def run_mix(
    transactions: DataFrame | None,
    config: MixConfig,
    spend: DataFrame | None = None,
    external: DataFrame | None = None,
    trees: bool | str = True,
    max_iter: int | None = None,
    carry_features: bool = False,
    exclude: tuple[str, ...] = (),
    sales: DataFrame | None = None,
) -> MixResult:
    """Run the analysis of one store's daily series, from invoice lines or from ready daily ``sales``.

    Missing spend or external factors are simulated over the sales calendar. The
    transactions are read once: daily sales are staged, and so is the panel,
    which the model reads many times. ``carry_features`` takes the lag and
    rolling columns of the spend into the panel; ``exclude`` keeps columns (such
    as same-day outcomes) out of the model. The boosting rounds are those of the
    configuration unless ``max_iter`` is given; trees grow best leaf first, or by Spark ML with
    ``trees="levels"``, and with False the model is linear. Without a training end all days train and
    there are no test metrics. As configured, the channels' parameters are tuned on the training
    days, features are normalised, and linear models are validated over expanding folds of the training days.
    """
    if (sales is None) == (transactions is None):
        raise ValueError("give either transactions or sales")
    if sales is None:
        sales = daily_sales(clean_transactions(transactions, config))
    sales = stage(date_range(sales, config.start_date, config.end_date))
    dates = sales.select("date")
    if spend is None:
        spend = simulate_spend(dates, config.channels, seed=config.seed)
    if external is None:
        external = simulate_external(dates, seed=config.seed)
    spend, extra = spend_features(spend, config)
    carry = extra if carry_features else ()
    base = join_spend(sales_features(sales, config), pivot_spend(spend, config.channels, carry=carry))
    params = config.channel_params
    if config.tuning:
        base = stage(base)
        params = tuned_params(base, config)
    panel = stage(finish_panel(base, config.channels, params, external))
    names = feature_columns(panel, exclude=exclude)
    if config.normalize:
        panel = stage(normalized(panel, names, config))
    if config.train_end_date:
        train, test = time_split(panel, config.train_end_date, config.test_start_date)
    else:
        train, test = panel, None
    if trees == "levels":
        scorer = train_gbt(train, names, max_iter=max_iter or config.rounds, seed=config.seed)
        weights = importance(panel.sparkSession, scorer)
    elif trees:
        scorer = train_leafwise(train, names, how=Boosting(rounds=max_iter or config.rounds, seed=config.seed))
        weights = gain_importance(scorer)
    else:
        scorer, weights = train_linear(train, names), None
    scored = stage(contributions(panel, scorer, config.channels))
    roi = median_roi(scored, config.channels, bounded=True)
    return MixResult(
        panel=panel,
        train=train,
        test=test,
        metrics=None if test is None else evaluate(scorer.predict(test)),
        importance=weights,
        contributions=scored,
        roi=roi,
        budget=allocate_budget(roi, config.budget, config.min_pct, config.max_pct),
        validation=cross_validate(train, names, k=config.folds) if config.validate else None,
        channel_params=params,
    )
