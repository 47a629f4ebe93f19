"""Every registered query against its SQL check, on the smallest tables."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from check_queries import compare, connect
from mixlab.plans import catalog

ORACLE = catalog.ORACLE
QUERIES = catalog.QUERIES
UNCHECKED = sorted(set(QUERIES) - set(ORACLE))


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, folder, con, name):
    got = QUERIES[name](spark, folder).toArrow()
    assert got.num_rows > 0
    assert compare(got, con.sql(ORACLE[name]).to_arrow_table()) == []


def test_all_are_registered():
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


def test_only_models_lack_sql():
    assert UNCHECKED == [
        "channel_contributions_gbt",
        "contributions_leafwise",
        "feature_importance",
        "gain_importance",
        "report_top_features",
        "report_top_features_gain",
        "top_features",
        "top_features_gain",
        "train_gbt",
        "train_leafwise",
        "train_leafwise_by",
    ]


def test_entry_allocates_every_channel(spark):
    rows = entry(spark).collect()
    assert {r["channel"] for r in rows} == set(catalog.CHANNELS)
    assert all(5.0 - 1e-9 <= r["budget_pct"] <= 40.0 + 1e-9 for r in rows)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


PLAIN = [
    "daily_sales", "daily_sales_distinct", "customer_frequency", "sales_by_weekday", "quartiles",
    "fill_median", "interpolate", "rolling_features", "channel_transform", "build_panel",
    "correlation_matrix", "param_search", "channel_contributions", "allocate_budget",
    "allocate_budget_conserving", "simulate_scenarios", "simulate_spend", "time_folds",
]


@pytest.mark.parametrize("name", PLAIN)
def test_plan_stays_in_spark(spark, folder, name):
    plan = _plan(QUERIES[name](spark, folder))
    for node in ("BatchEvalPython", "ArrowEvalPython", "InPandas", "CartesianProduct", "NestedLoopJoin"):
        assert node not in plan, node


def test_panel_reads_lines_once_and_only_needed_columns(spark, folder):
    plan = _plan(catalog.median_roi(spark, folder))
    scans = re.findall(r"FileScan parquet \[(l_orderkey[^\]]*)\]", plan.split("Initial Plan")[0])
    assert len(scans) == 1
    assert "l_tax" not in scans[0] and "l_shipdate" not in scans[0]


def test_unneeded_dimensions_are_not_joined(spark, folder):
    plan = _plan(QUERIES["returns_rate"](spark, folder))
    assert "Join" not in plan and plan.count("FileScan parquet") == 1


def test_date_filter_reaches_the_order_scan(spark, folder):
    plan = _plan(QUERIES["date_range"](spark, folder))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "o_orderdate" in line)
    pushed = scan[scan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed


def test_one_window_for_all_spend_features(spark, folder):
    from mixlab.operators.features import lag_features, rolling_features
    from mixlab.sources.retail import spend_view

    spend = spend_view(spark, folder)
    both = rolling_features(lag_features(spend, ["spend"], (1, 7), ["channel"]), ["spend"], (7, 14), ["channel"])
    plan = _plan(both)
    assert len(re.findall(r"Window \[", plan)) == 1
    assert plan.count("hashpartitioning(channel") == 1


def test_boosted_trees_learn(spark, folder):
    rows = {r["part"]: r for r in QUERIES["train_gbt"](spark, folder).collect()}
    assert rows["train"]["r2"] > 0


def test_importance_sums_to_one(spark, folder):
    row = QUERIES["feature_importance"](spark, folder).agg(F.sum("importance"), F.count("*")).first()
    assert row[0] == pytest.approx(1.0)
    assert row[1] == len(catalog._FEATURES)


def test_tree_contributions_and_baseline_make_the_prediction(spark, folder):
    df = QUERIES["channel_contributions_gbt"](spark, folder)
    parts = sum((F.col(c) for c in catalog.PARTS), F.lit(0.0))
    worst = df.select(F.max(F.abs(F.col("predicted_revenue") - parts))).first()[0]
    assert worst < 1e-6


def test_leafwise_trees_learn_and_add_up(spark, folder):
    rows = {r["part"]: r for r in QUERIES["train_leafwise"](spark, folder).collect()}
    assert rows["train"]["r2"] > 0.5
    df = QUERIES["contributions_leafwise"](spark, folder)
    parts = sum((F.col(c) for c in catalog.PARTS), F.lit(0.0))
    assert df.select(F.max(F.abs(F.col("predicted_revenue") - parts))).first()[0] < 1e-6


def test_gain_ranks_every_feature(spark, folder):
    every = {r["feature"]: r["importance"] for r in QUERIES["gain_importance"](spark, folder).collect()}
    assert set(every) == set(catalog._FEATURES) and min(every.values()) >= 0
    top = QUERIES["top_features_gain"](spark, folder).collect()
    assert [r["feature"] for r in top] == sorted(every, key=lambda f: (-every[f], f))[:20]


def test_entities_have_trees_of_their_own(spark, folder):
    rows = QUERIES["train_leafwise_by"](spark, folder).collect()
    assert {(r["Country"], r["channel"]) for r in rows} and {r["part"] for r in rows} <= {"train", "test"}


def test_cross_validation_scores_each_fold(spark, folder):
    rows = QUERIES["cross_validate"](spark, folder).collect()
    assert sorted(r["fold"] for r in rows) == [0, 1, 2]
    assert all(r["rmse"] > 0 for r in rows)
