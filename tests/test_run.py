"""The run follows its configuration: tuning, normalising, folds."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from mixlab.config import CHANNEL_PARAMS, MixConfig
from mixlab.plans.run import run_mix, tuned_params

START = dt.date(2011, 1, 1)
RAW = {
    "data": {"train_end_date": "2011-03-31"},
    "preprocessing": {"normalize_features": True, "remove_outliers": False},
    "feature_engineering": {"create_lag_features": False, "create_rolling_features": False},
    "modeling": {
        "validation_strategy": "time_series_split",
        "num_validation_folds": 4,
        "hyperparameter_tuning": True,
        "tuning_grid": {"decay_rate": [0.2, 0.6], "k": [0.5, 1.5], "S": [50.0, 500.0]},
    },
    "marketing_channels": ["tv", "radio"],
}


@pytest.fixture(scope="module")
def inputs(spark):
    """Revenue follows the carry-over of tv at 0.6 through a Hill curve with k 1.5 and S 50; radio never varies."""
    spend, sales, earlier = [], [], []
    for i in range(150):
        day, tv = START + dt.timedelta(i), float((i * 37) % 101)
        earlier = [tv, *earlier][:10]
        x = sum(v * 0.6**lag for lag, v in enumerate(earlier))
        spend += [(day, "tv", tv), (day, "radio", 5.0)]
        sales.append((day, 100.0 + 1000.0 * x**1.5 / (x**1.5 + 50.0**1.5), i % 9, i % 4))
    return (
        spark.createDataFrame(sales, "date DATE, revenue DOUBLE, transactions LONG, unique_customers LONG"),
        spark.createDataFrame(spend, "date DATE, channel STRING, spend DOUBLE"),
    )


def test_switches_are_read():
    config = MixConfig.from_dict(RAW)
    assert (config.normalize, config.validate, config.folds, config.tuning) == (True, True, 4, True)
    plain = MixConfig.from_dict({})
    assert not (plain.normalize or plain.validate or plain.tuning)


def test_run_tunes_normalises_and_validates(inputs):
    sales, spend = inputs
    config = MixConfig.from_dict(RAW)
    out = run_mix(None, config, spend=spend, trees=False, sales=sales)
    tv = out.channel_params["tv"]
    assert (tv["decay_rate"], tv["k"], tv["S"]) == (0.6, 1.5, 50.0)
    assert [r["fold"] for r in out.validation.orderBy("fold").collect()] == [0, 1, 2, 3]
    mean, deviation, raw = out.panel.agg(F.avg("transactions"), F.stddev_samp("transactions"), F.max("tv")).first()
    assert math.isclose(mean, 0, abs_tol=1e-9) and deviation == pytest.approx(1) and raw == 100.0
    assert {r["channel"] for r in out.budget.collect()} == {"tv", "radio"}


def test_without_switches_nothing_is_done(inputs):
    sales, spend = inputs
    raw = {**RAW, "preprocessing": {"remove_outliers": False}, "modeling": {}}
    out = run_mix(None, MixConfig.from_dict(raw), spend=spend, trees=False, sales=sales)
    assert out.validation is None and out.channel_params == CHANNEL_PARAMS
    assert out.panel.agg(F.max("transactions")).first()[0] == 8


def test_tuning_looks_at_training_days_only(spark, inputs):
    sales, spend = inputs
    from mixlab.operators.panel import join_spend, pivot_spend

    config = MixConfig.from_dict(RAW)
    base = join_spend(sales, pivot_spend(spend, config.channels))
    spoiled = base.withColumn("revenue", F.when(F.col("date") > "2011-03-31", -F.col("tv")).otherwise(F.col("revenue")))
    assert tuned_params(spoiled, config) == tuned_params(base, config)
