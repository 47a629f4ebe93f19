import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mixlab.config import CHANNELS, MixConfig
from mixlab.functions.carryover import adstock_weights, geometric_weights, saturate, weibull_weights
from mixlab.operators import attribution as at
from mixlab.operators import budget as bu
from mixlab.operators import features as fe
from mixlab.operators import model as mo
from mixlab.operators import panel as pa
from mixlab.operators import prep as pr
from mixlab.operators import profile as pf
from mixlab.operators import simulate as si
from mixlab.operators.channels import adstock, channel_transform
from mixlab.plans import reports as rp
from mixlab.plans.run import run_mix
from mixlab.session import shared_dir
from mixlab.sources import files

DAY = dt.date(2010, 12, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def series(spark, values, **more):
    rows = [(day(i), None if v is None else float(v), *more.values()) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "date DATE, v DOUBLE" + "".join(f", {k} STRING" for k in more))


def in_order(df, col, *keys):
    return [r[col] for r in df.orderBy(*(keys or ("date",))).collect()]


@pytest.fixture(scope="module")
def invoices(spark):
    rows = [
        (1, DAY, "A", 10, 2.5, "C1", "UK"),
        (2, DAY, "B", 5, 3.0, "C2", "FR"),
        (3, day(1), "A", -2, 2.5, "C1", "UK"),
        (4, day(1), "C", 8, 1.0, "C3", "DE"),
    ]
    schema = (
        "InvoiceNo LONG, InvoiceDate DATE, Description STRING, Quantity LONG, "
        "UnitPrice DOUBLE, CustomerID STRING, Country STRING"
    )
    return pr.line_amount(spark.createDataFrame(rows, schema))


# ---- sales and profiles ----


def test_daily_sales_of_four_lines(invoices):
    rows = pf.daily_sales(invoices).orderBy("date").collect()
    assert rows[0].asDict() == {"date": DAY, "revenue": 40.0, "transactions": 2, "unique_customers": 2}
    assert rows[1].asDict() == {"date": day(1), "revenue": 3.0, "transactions": 2, "unique_customers": 2}


def test_returns_are_dropped_only_on_request(invoices):
    assert pr.exclude_returns(invoices).count() == 3
    assert pr.exclude_returns(invoices, include=True).count() == 4
    rate = pf.returns_rate(invoices).first()
    assert (rate["n_lines"], rate["n_returns"], rate["returns_pct"]) == (4, 1, 25.0)


def test_plain_and_distinct_counts_differ(spark):
    rows = [("1", DAY, "C1", 1.0), ("1", DAY, "C1", 2.0), ("2", DAY, None, 3.0)]
    df = spark.createDataFrame(rows, "InvoiceNo STRING, InvoiceDate DATE, CustomerID STRING, TotalAmount DOUBLE")
    plain, once = pf.daily_sales(df).first(), pf.daily_sales(df, distinct=True).first()
    assert (plain["transactions"], plain["unique_customers"]) == (3, 2)
    assert (once["transactions"], once["unique_customers"]) == (2, 1)
    assert pf.daily_sales(df, distinct=True, approx=True).first()["transactions"] == 2


def test_weekdays_without_sales_stay(invoices):
    rows = pf.sales_by_weekday(invoices).orderBy("weekday").collect()
    assert [r["day_name"] for r in rows][:3] == ["Monday", "Tuesday", "Wednesday"]
    assert [r["revenue"] for r in rows] == [None, None, 40.0, 3.0, None, None, None]


def test_histogram_keeps_empty_bins_and_the_top_edge(spark):
    df = spark.createDataFrame([(v,) for v in (-5.0, 0.0, 9.9, 10.0, 99.0, 250.0, None)], "v DOUBLE")
    rows = pf.histogram(df, "v", 0, 100, 10).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [3, 1, 0, 0, 0, 0, 0, 0, 0, 2]


def test_describe_and_nulls(spark):
    df = spark.createDataFrame([(1.0, "b"), (3.0, None), (None, "a")], "x DOUBLE, t STRING")
    rows = {r["column"]: r for r in pf.describe_long(df).collect()}
    assert (rows["x"]["count"], rows["x"]["mean"], rows["x"]["min"], rows["x"]["max"]) == (2, 2.0, 1.0, 3.0)
    assert rows["x"]["stddev"] == pytest.approx(math.sqrt(2))
    assert (rows["t"]["count"], rows["t"]["min_text"], rows["t"]["mean"]) == (2, "a", None)
    assert {r["column"]: r["nulls"] for r in pf.null_counts(df).collect()} == {"x": 1, "t": 1}


def test_correlation_is_symmetric_with_unit_diagonal(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(60, 3))
    data[:, 1] += data[:, 0]
    df = spark.createDataFrame([(*map(float, r), 1.0) for r in data], "a DOUBLE, b DOUBLE, c DOUBLE, k DOUBLE")
    got = {(r["x"], r["y"]): r["corr"] for r in pf.correlation(df, ["a", "b", "c", "k"]).collect()}
    assert len(got) == 16
    want = np.corrcoef(data.T)
    for i, x in enumerate("abc"):
        for j, y in enumerate("abc"):
            assert got[x, y] == pytest.approx(want[i, j])
    assert got["a", "k"] is None and got["k", "k"] is None


# ---- cleaning ----


def test_interpolation_takes_the_midpoint(spark):
    df = series(spark, [None, 1, None, None, 4, None])
    assert in_order(pr.interpolate(df, ["v"]), "v") == [None, 1.0, 2.5, 2.5, 4.0, None]


def test_interpolation_stays_inside_its_series(spark):
    df = series(spark, [1, None, 3], g="a").unionByName(series(spark, [None, 8, None], g="b"))
    assert in_order(pr.interpolate(df, ["v"], ["g"]), "v", "g", "date") == [1.0, 2.0, 3.0, None, 8.0, None]


def test_mean_fill_does_not_cut_integers(spark):
    df = spark.createDataFrame([(2,), (3,), (None,)], "n INT")
    assert sorted(r["n"] for r in pr.fill_missing(df, "mean").collect()) == [2.0, 2.5, 3.0]


@pytest.mark.parametrize("bounded", [True, False])
def test_median_fill_per_group(spark, bounded):
    rows = [("a", 1.0), ("a", 2.0), ("a", 9.0), ("a", None), ("b", None), ("c", 5.0)]
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE")
    out = pr.fill_missing(df, "median", ["v"], ["g"], bounded=bounded)
    assert sorted((r["g"], r["v"]) for r in out.collect() if r["v"] is not None) == [
        ("a", 1.0), ("a", 2.0), ("a", 2.0), ("a", 9.0), ("c", 5.0)
    ]
    assert out.count() == 6


def test_unknown_fill_method_changes_nothing(spark):
    df = series(spark, [1, None])
    assert pr.fill_missing(df, "none").collect() == df.collect()


def test_imputer_skips_long_and_decimal(spark):
    df = spark.createDataFrame([], "a DOUBLE, b INT, c FLOAT, d LONG, e DECIMAL(8,2), f STRING, g SHORT")
    assert pr.numeric_columns(df) == ["a", "b", "c"]
    assert pr.numeric_columns(df, all_numeric=True) == ["a", "b", "c", "d", "e", "g"]


def test_dirty_dates_become_null(spark):
    df = spark.createDataFrame([("2011-01-05",), ("soon",), (None,)], "d STRING")
    assert [r["d"] for r in pr.parse_date(df, "d", "yyyy-MM-dd").collect()] == [dt.date(2011, 1, 5), None, None]


def test_date_range_needs_both_bounds(spark):
    df = series(spark, range(5))
    assert pr.date_range(df, str(day(1)), str(day(3))).count() == 3
    assert pr.date_range(df, str(day(1)), None).count() == 5


def test_standardize_gives_unit_series(spark):
    out = pr.standardize(series(spark, [1, 2, 3, 4]), ["v"]).agg(F.avg("v"), F.stddev("v")).first()
    assert out[0] == pytest.approx(0) and out[1] == pytest.approx(1)
    assert in_order(pr.standardize(series(spark, [2, 2]), ["v"]), "v") == [None, None]


def test_zero_fill_leaves_keys_and_text(spark):
    df = spark.createDataFrame([(None, None, None)], "date DATE, n INT, t STRING")
    assert tuple(pr.zero_fill(df).first()) == (None, 0, None)


# ---- features and carry-over ----


def test_lags_start_null_and_windows_shrink(spark):
    df = fe.rolling_features(fe.lag_features(series(spark, [1, 2, 3, 4]), ["v"], [2]), ["v"], [2])
    assert in_order(df, "v_lag_2") == [None, None, 1.0, 2.0]
    assert in_order(df, "v_sum_2d") == [1.0, 3.0, 6.0, 9.0]
    assert in_order(df, "v_max_2d") == [1.0, 2.0, 3.0, 4.0]
    exact = fe.rolling_features(series(spark, [1, 2, 3, 4]), ["v"], [2], frame="w")
    assert in_order(exact, "v_sum_2d") == [1.0, 3.0, 5.0, 7.0]


def test_day_windows_look_at_dates_not_rows(spark):
    df = spark.createDataFrame([(day(0), 1.0), (day(5), 2.0), (day(6), 3.0)], "date DATE, v DOUBLE")
    assert in_order(fe.rolling_features(df, ["v"], [3], frame="days"), "v_sum_3d") == [1.0, 2.0, 5.0]


def test_holiday_flags(spark):
    df = spark.createDataFrame([(dt.date(2011, 7, 14),), (dt.date(2011, 7, 15),)], "date DATE")
    rows = fe.holidays(df).orderBy("date").collect()
    assert (rows[0]["is_bastille_day"], rows[0]["is_christmas_day"], rows[0]["is_holiday"]) == (1, 0, 1)
    assert rows[1]["is_holiday"] == 0
    assert len(df.columns) + 9 == len(fe.holidays(df).columns)


def test_impulse_returns_the_weights(spark):
    for weights in (geometric_weights(0.6, 5), weibull_weights(2, 7, 30)):
        n = len(weights) + 3
        df = adstock(series(spark, [1] + [0] * (n - 1)), "v", weights)
        assert in_order(df, "adstock") == pytest.approx(weights + [0.0] * 3)


def test_weibull_weights():
    weights = weibull_weights()
    assert sum(weights) == pytest.approx(1)
    assert weights[:3] == pytest.approx([0, 0.04012855, 0.07549081], abs=1e-8)
    assert adstock_weights("weibull", max_lag=5) == weibull_weights(max_lag=5)
    with pytest.raises(ValueError):
        weibull_weights(shape=0.5)


def test_adstock_is_linear_and_bounded(spark):
    rng = np.random.default_rng(5)
    x, y = rng.exponential(10, 80), rng.exponential(10, 80)
    w = geometric_weights(0.7, 10)
    a, b, both = (np.array(in_order(adstock(series(spark, v), "v", w), "adstock")) for v in (x, y, 2 * x + y))
    assert both == pytest.approx(2 * a + b)
    assert a.sum() <= x.sum() * (1 - 0.7**10) / 0.3 + 1e-9
    want = [sum(w[lag] * x[t - lag] for lag in range(10) if t >= lag) for t in range(80)]
    assert a == pytest.approx(want)


def test_saturation_points(spark):
    df = spark.createDataFrame([(0.0,), (50.0,), (1e9,)], "x DOUBLE")

    def at_points(kind, k=0.7):
        return [r[0] for r in df.select(saturate(F.col("x"), kind, k, 50)).collect()]

    hill = at_points("hill")
    assert hill[:2] == [0.0, pytest.approx(0.5)] and 0.99 < hill[2] < 1
    assert at_points("exp")[:2] == [0.0, pytest.approx(1 - math.exp(-0.7))]
    assert at_points("logistic")[1] == 0.5
    assert at_points("other") == [0.0, 50.0, 1e9]


def test_channel_transform_skips_absent_channels(spark):
    df = series(spark, [100, 0, 0]).withColumnRenamed("v", "tv")
    out = channel_transform(df, ["tv", "radio"], {"tv": {"decay_rate": 0.5, "saturation_type": "none"}})
    assert out.columns == ["date", "tv", "tv_adstock"]
    assert in_order(out, "tv_adstock") == [100.0, 50.0, 25.0]


# ---- simulation ----


def test_noise_depends_on_the_row_only(spark):
    dates = series(spark, range(40)).select("date")
    one = si.simulate_spend(dates.repartition(1), CHANNELS).orderBy("date", "channel").collect()
    many = si.simulate_spend(dates.repartition(7), CHANNELS).orderBy("date", "channel").collect()
    assert one == many
    other = si.simulate_spend(dates, CHANNELS, seed=1).orderBy("date", "channel").collect()
    assert one != other


def test_spend_noise_stays_in_its_band(spark):
    dates = series(spark, range(60)).select("date")
    clean = si.simulate_spend(dates, CHANNELS, noise=0).withColumnRenamed("spend", "clean")
    ratio = si.simulate_spend(dates, CHANNELS).join(clean, ["date", "channel"]).select(
        F.min(F.col("spend") / F.col("clean")), F.max(F.col("spend") / F.col("clean"))
    ).first()
    assert 0.899 < ratio[0] < 0.95 and 1.05 < ratio[1] < 1.101


def test_external_noise_has_the_right_spread(spark):
    dates = spark.range(3000).select(F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("date"))
    clean = si.simulate_external(dates, noise=0).select("date", F.col("gdp_growth").alias("clean"))
    spread = si.simulate_external(dates).join(clean, "date").select(F.stddev(F.col("gdp_growth") - F.col("clean"))).first()[0]
    assert spread == pytest.approx(0.1, rel=0.1)


def test_demo_transactions_stay_in_range(spark):
    rows = si.demo_transactions(series(spark, range(50)).select("date"), per_day=4).collect()
    assert len(rows) == 200 and len({r["InvoiceNo"] for r in rows}) == 200
    assert {r["Quantity"] for r in rows} <= set(range(1, 10))
    assert all(10 <= r["UnitPrice"] < 100 and 10000 <= r["CustomerID"] < 99999 for r in rows)


# ---- panel and splits ----


@pytest.fixture(scope="module")
def small_panel(spark):
    days = series(spark, range(120)).select("date")
    spend = si.simulate_spend(days, CHANNELS)
    # revenue that truly depends on the channels
    wide = pa.pivot_spend(spend, CHANNELS)
    sales = wide.select(
        "date",
        (F.lit(1000.0) + 3 * F.col("tv") + F.col("radio")).alias("revenue"),
        F.lit(5).cast("long").alias("transactions"),
    )
    return pa.build_panel(sales, spend, CHANNELS, MixConfig().channel_params, si.simulate_external(days)).cache()


def test_panel_has_one_row_per_day(small_panel):
    assert small_panel.count() == 120
    assert [c for c in small_panel.columns if c.endswith("_adstock")] == [f"{c}_adstock" for c in CHANNELS]
    nulls = {r["column"]: r["nulls"] for r in pf.null_counts(small_panel).collect()}
    assert set(nulls.values()) == {0}


def test_one_pass_panel_equals_the_join(spark, folder):
    from mixlab.plans import catalog as ca

    joined = pa.join_spend(ca.sales(spark, folder), ca.wide(spark, folder)).orderBy("date").collect()
    lines = ca.lines(spark, folder, *ca.SALES_COLUMNS, "channel", "spend")
    assert pa.sales_with_spend(lines, ca.CHANNELS).orderBy("date").collect() == joined


def test_panel_per_entity_keeps_series_apart(spark):
    rows = [("x", day(i), 10.0) for i in range(3)] + [("y", day(i), 0.0) for i in range(3)]
    sales = spark.createDataFrame(rows, "store STRING, date DATE, revenue DOUBLE")
    spend = sales.select("store", "date", F.lit("tv").alias("channel"), F.col("revenue").alias("spend"))
    out = pa.build_panel(sales, spend, ["tv"], {"tv": {"decay_rate": 0.5, "saturation_type": "none"}}, id_cols=["store"])
    assert in_order(out, "tv_adstock", "store", "date") == [10.0, 15.0, 17.5, 0.0, 0.0, 0.0]


def test_clashing_external_columns_get_a_prefix(spark):
    own = series(spark, [1]).withColumn("is_holiday", F.lit(1))
    out = pa.join_external(own, series(spark, [2]).select("date", F.lit(0).alias("is_holiday")))
    assert out.columns == ["date", "v", "is_holiday", "ext_is_holiday"]


def test_carried_features_are_pivoted(spark):
    spend = fe.lag_features(
        si.simulate_spend(series(spark, range(3)).select("date"), ["tv", "radio"]), ["spend"], [1], ["channel"]
    )
    out = pa.pivot_spend(spend, ["tv", "radio"], carry=["spend_lag_1"])
    assert out.columns == ["date", "tv", "tv_spend_lag_1", "radio", "radio_spend_lag_1"]
    assert in_order(out, "tv_spend_lag_1")[1:] == in_order(out, "tv")[:2]


def test_splits_cover_the_panel(small_panel):
    train, test = pa.time_split(small_panel, str(day(79)))
    assert (train.count(), test.count()) == (80, 40)
    _, late = pa.time_split(small_panel, str(day(79)), str(day(90)))
    assert late.count() == 30
    left, right = pa.random_split(small_panel, ["date"])
    assert left.count() + right.count() == 120
    again, _ = pa.random_split(small_panel.repartition(9), ["date"])
    assert sorted(in_order(left, "date")) == sorted(in_order(again, "date"))


def test_time_folds_expand(spark):
    folds = pa.time_folds(series(spark, range(10)), 3)
    assert in_order(folds, "fold") == [-1] * 4 + [0, 0, 1, 1, 2, 2]
    assert set(in_order(pa.time_folds(series(spark, range(3)), 3), "fold")) == {-1}


# ---- models and attribution ----


def test_linear_fit_matches_least_squares(small_panel):
    names = ["tv", "radio_adstock", "day_of_week_sin"]
    fitted = mo.train_linear(small_panel, names)
    pdf = small_panel.toPandas()
    x = np.column_stack([np.ones(len(pdf)), pdf[names].to_numpy()])
    want = np.linalg.lstsq(x, pdf["revenue"].to_numpy(), rcond=None)[0]
    assert fitted.intercept == pytest.approx(want[0], rel=1e-6)
    assert [fitted.coefs[n] for n in names] == pytest.approx(list(want[1:]), rel=1e-6)


def test_metrics_match_their_formulas(spark):
    y, p = np.array([1.0, 2.0, 4.0, 8.0]), np.array([1.5, 2.0, 3.0, 9.0])
    df = spark.createDataFrame(list(zip(y.tolist(), p.tolist())), "revenue DOUBLE, prediction DOUBLE")
    row = mo.evaluate(df).first()
    assert row["rmse"] == pytest.approx(math.sqrt(((y - p) ** 2).mean()))
    assert row["mae"] == pytest.approx(abs(y - p).mean())
    assert row["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert row["mape"] == pytest.approx((abs((y - p) / (y + 1))).mean() * 100)


def test_contributions_add_up_and_roi_is_null_without_spend(small_panel):
    scorer = mo.train_linear(small_panel, ["tv_adstock", "radio_adstock"])
    zeroed = small_panel.withColumn("tv", F.when(F.col("date") == DAY, 0.0).otherwise(F.col("tv")))
    out = at.contributions(zeroed, scorer, CHANNELS)
    parts = sum((F.col(f"{p}_contribution") for p in (*CHANNELS, "baseline")), F.lit(0.0))
    assert out.select(F.max(F.abs(parts - F.col("predicted_revenue")))).first()[0] < 1e-6
    assert out.filter("tv_roi IS NULL").count() == 1
    assert out.select(F.max(F.abs("email_contribution"))).first()[0] == 0


def test_tree_effects_equal_separate_scoring(small_panel):
    names = ["tv_adstock", "radio_adstock", "day_of_week"]
    scorer = mo.train_gbt(small_panel, names, max_iter=3)
    got = at.contributions(small_panel, scorer, ["tv", "radio"]).orderBy("date").collect()
    whole = in_order(scorer.predict(small_panel), "prediction")
    without = in_order(scorer.predict(small_panel.withColumn("tv_adstock", F.lit(0.0))), "prediction")
    assert [r["tv_contribution"] for r in got] == pytest.approx([a - b for a, b in zip(whole, without)])
    weights = {r["feature"]: r["importance"] for r in mo.importance(small_panel.sparkSession, scorer).collect()}
    for name, weight in weights.items():
        if weight == 0 and name.endswith("_adstock"):
            assert all(r[name.replace("_adstock", "_contribution")] == 0 for r in got)


def test_param_search_recovers_the_generating_point(spark):
    rng = np.random.default_rng(2)
    spend = rng.exponential(3000, 150)
    w = geometric_weights(0.5, 10)
    carried = np.array([sum(w[k] * spend[t - k] for k in range(10) if t >= k) for t in range(150)])
    revenue = 5000 * carried**0.8 / (carried**0.8 + 2000.0**0.8)
    rows = [(day(i), float(revenue[i]), float(spend[i])) for i in range(150)]
    df = spark.createDataFrame(rows, "date DATE, revenue DOUBLE, tv DOUBLE")
    best = mo.param_search(df, ["tv"], {"decay_rate": (0.3, 0.5, 0.7), "k": (0.5, 0.8), "S": (2000.0, 9000.0)}).first()
    assert (best["decay_rate"], best["k"], best["S"]) == (0.5, 0.8, 2000.0)
    assert best["r2"] == pytest.approx(1.0)


def test_week_modes_differ_at_new_year(spark):
    df = spark.createDataFrame(
        [(dt.date(2010, 12, 31), 1.0, 2.0), (dt.date(2011, 1, 1), 3.0, 4.0)],
        "date DATE, tv_contribution DOUBLE, baseline_contribution DOUBLE",
    )
    calendar = at.weekly(df, ["tv"]).orderBy("year").collect()
    assert [(r["year"], r["week"]) for r in calendar] == [(2010, 52), (2011, 52)]
    assert at.weekly(df, ["tv"], "trunc").count() == 1


def test_roi_medians_ignore_missing_days_on_both_routes(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None), (None, None), (8.0, None)], "tv_roi DOUBLE, radio_roi DOUBLE")
    for bounded in (True, False):
        got = {r["channel"]: r["roi"] for r in at.median_roi(df, ["tv", "radio"], bounded=bounded).collect()}
        assert got == {"tv": 3.0, "radio": None}


# ---- budget ----

# The published ROIs and the allocation of 100,000 between 5 % and 40 %.
PUBLISHED = {
    "tv": (3.606191063461723, 40000.0),
    "display": (-0.00567009449204496, 9285.714285714286),
    "email": (-0.013588888975610622, 9285.714285714286),
    "print": (-0.053681479940761605, 9285.714285714286),
    "search": (-0.11135569938212199, 9285.714285714286),
    "social_media": (-0.6258249768493506, 9285.714285714286),
    "radio": (-2.9787233019758266, 9285.714285714286),
}
SEVERAL = {"a": 3.0, "b": 2.5, "c": 1.0, "d": 0.5, "e": -1.0}


def roi_frame(spark, values):
    return spark.createDataFrame(list(values.items()), "channel STRING, roi DOUBLE")


def budgets(df):
    return {r["channel"]: r["budget"] for r in df.collect()}


def test_published_allocation(spark):
    got = bu.allocate_budget(roi_frame(spark, {c: v[0] for c, v in PUBLISHED.items()}))
    assert budgets(got) == pytest.approx({c: v[1] for c, v in PUBLISHED.items()})
    assert bu.total_budget(got).first()[0] == pytest.approx(95714.2857142857)
    assert rp.report_budget(got).first()["channel"] == "tv"


def test_allocation_with_several_positive_channels(spark):
    assert budgets(bu.allocate_budget(roi_frame(spark, SEVERAL))) == pytest.approx(
        {"a": 40000, "b": 24691.79508538109, "c": 13321.532694710537, "d": 11072.46980424823, "e": 9385.6726364015}
    )


def test_conserving_allocation(spark):
    assert budgets(bu.allocate_budget_conserving(roi_frame(spark, SEVERAL))) == pytest.approx(
        {"a": 37142.857142857, "b": 31785.714285714, "c": 15714.285714286, "d": 10357.142857143, "e": 5000}
    )


def _by_hand(rois, total, low, high):
    """The sequential rule in plain numbers, for comparison."""
    order = sorted(rois, key=lambda c: (-rois[c], c))
    out = dict.fromkeys(order, low)
    rest = total - low * len(order)
    pool = sum(rois[c] for c in order if rois[c] > 0)
    if rest > 0:
        for c in order:
            if pool > 0 and rois[c] > 0:
                share = rest * (rois[c] / pool)
                out[c] += share
                if out[c] > high:
                    rest, out[c] = out[c] - high, high
                else:
                    rest -= share
        if rest > 0:
            even = rest / len(order)
            out = {c: b + min(even, high - b) if b < high else b for c, b in out.items()}
    return out


def test_many_groups_at_once(spark):
    rng = np.random.default_rng(11)
    cases = {
        str(g): {f"c{i}": float(v) for i, v in enumerate(rng.normal(0.5, 1.5, rng.integers(3, 9)))}
        for g in range(200)
    }
    rows = [(g, c, v) for g, case in cases.items() for c, v in case.items()]
    df = spark.createDataFrame(rows, "g STRING, channel STRING, roi DOUBLE")
    for r in bu.allocate_budget(df, id_cols=["g"]).collect():
        cases[r["g"]].setdefault("want", _by_hand({c: v for c, v in cases[r["g"]].items() if c != "want"}, 1e5, 5e3, 4e4))
        assert r["budget"] == pytest.approx(cases[r["g"]]["want"][r["channel"]])
    safe = bu.allocate_budget_conserving(df, id_cols=["g"]).cache()
    assert safe.filter("budget < 5000 - 1e-6 OR budget > 40000 + 1e-6").count() == 0
    sums = safe.groupBy("g").agg(F.sum("budget").alias("t")).select(F.max(F.abs(F.col("t") - 1e5))).first()[0]
    assert sums < 1e-6


def test_missing_roi_gets_the_minimum_share(spark):
    got = budgets(bu.allocate_budget(roi_frame(spark, {"a": 1.0, "b": None, "c": 0.5})))
    assert set(got) == {"a", "b", "c"} and got["a"] == 40000.0


def test_scenarios_are_scaled_and_unknown_channels_return_nothing(spark):
    rows = [("s", "tv", 30.0, 1000.0), ("s", "radio", 30.0, 1000.0), ("z", "tv", 0.0, 1000.0), ("s", "new", 40.0, 1000.0)]
    wanted = spark.createDataFrame(rows, "scenario STRING, channel STRING, allocation_pct DOUBLE, total_budget DOUBLE")
    table = bu.simulate_scenarios(wanted, roi_frame(spark, {"tv": 2.0, "radio": -1.0}))
    daily = spark.createDataFrame([(10.0,), (20.0,)], "baseline_contribution DOUBLE")
    full = bu.append_baseline(table, bu.mean_baseline(daily, n_days=2))
    got = {(r["scenario"], r["channel"]): r for r in full.collect()}
    assert got["s", "tv"]["contribution"] == pytest.approx(600) and got["s", "new"]["roi"] == 0
    assert got["s", "Baseline"]["contribution"] == 30.0
    totals = {r["scenario"]: r for r in bu.compare_scenarios(full).collect()}
    assert totals["s"]["total_sales"] == pytest.approx(330) and totals["s"]["overall_roi"] == pytest.approx(0.3)
    assert totals["z"]["overall_roi"] == 0
    assert bu.drop_baseline(full).count() == table.count()


def test_default_allocation_without_budget_is_even(spark):
    none = spark.createDataFrame([], files.BUDGET)
    got = {r["channel"]: r["allocation_pct"] for r in bu.default_allocation(none, ["a", "b"]).collect()}
    assert got == {"a": 50.0, "b": 50.0}


# ---- files, settings, whole run ----


def test_missing_external_file_is_empty(spark, tmp_path):
    df = files.external_or_empty(spark, str(tmp_path / "none.csv"))
    assert df.count() == 0 and df.columns == ["date", "gdp", "unemployment", "consumer_confidence"]


def test_results_round_trip(spark, tmp_path, small_panel):
    scored = at.contributions(small_panel, mo.train_linear(small_panel, ["tv_adstock"]), CHANNELS)
    budget = bu.allocate_budget(at.median_roi(scored, CHANNELS))
    metrics = spark.createDataFrame([(1.5, 2.5, 0.5, 3.5)], files.METRICS)
    files.save_results(scored, budget, metrics, str(tmp_path / "out"))
    a, b, c = files.load_results(spark, str(tmp_path / "out"), CHANNELS)
    assert a.columns == scored.columns
    assert a.orderBy("date").collect() == scored.orderBy("date").collect()
    assert budgets(b) == budgets(budget) and c.first() == metrics.first()


def test_partitioned_parquet_round_trip(spark, tmp_path):
    df = spark.range(300).select((F.col("id") % 3 == 0).cast("string").alias("hot"), "id")
    files.write_parquet(df, str(tmp_path / "p"), ["hot"])
    assert sorted(r["id"] for r in files.scan_parquet(spark, str(tmp_path / "p")).collect()) == list(range(300))


def test_csv_scan_with_and_without_schema(spark, tmp_path):
    files.write_csv(series(spark, [1, 2]), str(tmp_path / "c"))
    typed = files.scan_csv(spark, str(tmp_path / "c"), "date DATE, v DOUBLE")
    guessed = files.scan_csv(spark, str(tmp_path / "c"))
    assert typed.dtypes == [("date", "date"), ("v", "double")]
    assert sorted(typed.collect()) == sorted(guessed.collect())


def test_settings_from_json():
    config = MixConfig.from_dict(
        {
            "data": {"include_returns": False, "start_date": "2010-12-01"},
            "feature_engineering": {"create_lag_features": False, "rolling_windows": [3]},
            "marketing_channels": ["tv"],
            "optimization": {"budget_constraint": 5},
        }
    )
    assert (config.include_returns, config.lags, config.windows) == (False, None, (3,))
    assert (config.channels, config.budget, config.max_pct) == (("tv",), 5.0, 0.4)


def test_shared_folder_is_the_sessions(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (named or shared_dir(spark))
    assert spark.sparkContext.getCheckpointDir()


def test_constant_inputs_do_not_stop_the_fits(spark):
    df = series(spark, [1, 2, 3]).select("date", F.col("v").alias("revenue"), F.lit(4.0).alias("tv"), F.lit(0.0).alias("radio"))
    row = mo.simple_linear(df, ["tv"]).first()
    assert row["slope"] is None
    got = {r["feature"]: r["corr"] for r in pf.target_correlation(df, "revenue", ["tv", "revenue"]).collect()}
    assert got["tv"] is None and got["revenue"] == pytest.approx(1)
    grid = {"decay_rate": (0.0, 0.5), "k": (0.5,), "S": (10.0,)}
    assert [r["channel"] for r in mo.param_search(df, ["tv", "radio"], grid).collect()] == ["tv"]


@pytest.mark.parametrize("trees", [True, False, "levels"])
def test_whole_run(spark, trees):
    lines = si.demo_transactions(series(spark, range(150)).select("date"), per_day=5)
    config = MixConfig(
        include_returns=False,
        start_date=str(day(0)),
        end_date=str(day(139)),
        train_end_date=str(day(99)),
        lags=(1,),
        windows=(3,),
    )
    out = run_mix(lines, config, trees=trees, max_iter=2, carry_features=bool(trees), exclude=("transactions",))
    assert out.panel.count() == out.train.count() + out.test.count() <= 140
    assert {r["channel"] for r in out.budget.collect()} == set(CHANNELS)
    assert out.metrics.first()["rmse"] > 0
    assert {"is_holiday", "ext_is_holiday", "quarter"} <= set(out.panel.columns)
    assert ("tv_spend_lag_1" in out.panel.columns) == bool(trees)
    if trees:
        names = {r["feature"] for r in out.importance.collect()}
        assert "transactions" not in names and "tv_adstock" in names
    findings = rp.report_findings(out.contributions, CHANNELS).first()
    assert len(findings["best"].split(", ")) == len(findings["worst"].split(", ")) == 3


def test_loaders_apply_the_settings(spark, tmp_path):
    from mixlab.sources import loaders

    lines = (
        "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
        "1,A,Cup,2,2010-12-01 08:26:00,1.5,7,UK\n"
        "2,B,Mug,-1,2010-12-01 09:00:00,2.0,,UK\n"
        "3,C,Pot,4,2010-12-02 23:59:00,2.5,8,FR\n"
        "4,C,Pot,4,2010-12-03 00:00:00,2.5,8,FR\n"
    )
    path = tmp_path / "retail.csv"
    path.write_text(lines)
    config = MixConfig(include_returns=False, start_date="2010-12-01", end_date="2010-12-02")
    rows = loaders.load_retail(spark, str(path), config).orderBy("InvoiceNo").collect()
    assert [(r["InvoiceNo"], r["TotalAmount"], r["InvoiceTs"].hour) for r in rows] == [("1", 3.0, 8), ("3", 10.0, 23)]
    assert loaders.load_retail(spark, str(path)).count() == 4

    spend = tmp_path / "spend.csv"
    spend.write_text("date,channel,spend\n2010-12-01,tv,5\n2011-01-01,tv,6\n")
    assert loaders.load_marketing(spark, str(spend), config).count() == 1
    sales = tmp_path / "sales.csv"
    sales.write_text("date,revenue\n2010-12-02,5.5\n")
    assert loaders.load_sales(spark, str(sales), config).first()["revenue"] == 5.5
    assert loaders.load_external(spark, str(tmp_path / "none.csv")).count() == 0


def test_csv_follows_the_header(spark, tmp_path):
    from mixlab.sources import loaders

    path = tmp_path / "sales.csv"
    path.write_text("date,transactions,revenue\n2010-12-02,5,100.5\n12/3/2010 8:26,6,200.5\n")
    rows = loaders.load_sales(spark, str(path)).orderBy("date").collect()
    assert [(str(r["date"]), r["revenue"], r["transactions"]) for r in rows] == [("2010-12-02", 100.5, 5), ("2010-12-03", 200.5, 6)]
    path.write_text("date,transactions\n2010-12-02,5\n")
    with pytest.raises(ValueError, match="revenue"):
        loaders.load_sales(spark, str(path))
    retail = tmp_path / "retail.csv"
    retail.write_text(
        "Country,CustomerID,UnitPrice,InvoiceDate,Quantity,Description,StockCode,InvoiceNo\n"
        "UK,17850.0,2.55,12/1/2010 8:26,6,Cup,A,1\nUK,,abc,12/1/2010 9:00,1.5,Mug,B,2\nUK,7,3,oops,2,Mug,B,3\n"
    )
    first = loaders.load_retail(spark, str(retail)).filter("InvoiceNo = '1'").first()
    assert (first["CustomerID"], str(first["TotalAmount"]), first["InvoiceTs"].hour) == (17850, "15.3000", 8)
    bad = {r["column"]: r["rejected"] for r in files.rejected_values(spark, str(retail), files.TRANSACTIONS).collect()}
    assert {c: n for c, n in bad.items() if n} == {"UnitPrice": 1, "Quantity": 1, "InvoiceDate": 1}


def test_unlisted_channels_are_never_dropped(spark):
    df = series(spark, [1, 2]).select("date", F.lit("tv").alias("channel"), F.col("v").alias("spend"))
    wider = df.unionByName(df.withColumn("channel", F.lit("billboard"))).unionByName(df.withColumn("channel", F.lit(None)))
    with pytest.raises(Exception, match="unlisted channel"):
        pa.pivot_spend(wider, ["tv"]).collect()
    carried = pa.pivot_spend(wider, ["tv"], others="carry").orderBy("date").collect()
    assert [(r["tv"], r[pa.OTHERS]) for r in carried] == [(1.0, 2.0), (2.0, 4.0)]


def test_mean_of_decimals_does_not_depend_on_the_order(spark):
    values = [0.1, 0.2, 0.3, None, 12345678.9, 0.7]
    df = series(spark, values).withColumn("v", F.col("v").cast("decimal(12,4)"))
    filled = {r["v"] for r in pr.fill_missing(df, "mean", ["v"]).filter("date = '%s'" % day(3)).collect()}
    assert filled == {float(12345680.2) / 5}
    assert filled == {r["v"] for r in pr.fill_missing(df.orderBy(F.desc("date")), "mean", ["v"]).filter("date = '%s'" % day(3)).collect()}


def test_saturation_refuses_and_guards(spark):
    from mixlab.functions.carryover import saturate

    for kind in ("hill", "exp"):
        with pytest.raises(ValueError):
            saturate(F.col("v"), kind, 0.5, 0)
    row = series(spark, [-4.0]).select(saturate(F.col("v"), "hill", 0.5, 10).alias("h"), saturate(F.col("v"), "exp", 0.5, 10).alias("e")).first()
    assert (row["h"], row["e"]) == (0.0, 0.0)


def test_describe_takes_every_type(spark):
    df = spark.createDataFrame([("2010-01-01", 1, True), ("2011-01-01", 3, None)], "d string, n int, b boolean").withColumn("d", F.to_date("d"))
    rows = {r["column"]: r for r in pf.describe_long(df).collect()}
    assert (rows["d"]["min_text"], rows["d"]["max_text"], rows["n"]["mean"], rows["b"]["count"]) == ("2010-01-01", "2011-01-01", 2.0, 1)


def test_ids_are_no_features(spark):
    df = spark.createDataFrame([(1, 2.0, 3, "x")], "StockCode long, revenue double, tv int, note string")
    assert mo.feature_columns(df, exclude=["StockCode"]) == ["tv"]


def test_no_test_metrics_without_a_split(spark):
    lines = si.demo_transactions(series(spark, range(40)).select("date"), per_day=3)
    out = run_mix(lines, MixConfig(lags=None, windows=None), trees=False, exclude=("transactions",))
    assert out.test is None and out.metrics is None and out.budget.count() == len(CHANNELS)


def test_model_is_saved_and_loaded(spark, monkeypatch):
    df = series(spark, [1, 5, 2, 8, 3, 9, 4, 7]).select("date", F.col("v").alias("revenue"), (F.col("v") * 2).alias("tv"))
    first = mo.saved_gbt(df, ["tv"], max_iter=3).predict(df).collect()
    monkeypatch.setattr(mo, "train_gbt", None)
    assert mo.saved_gbt(df, ["tv"], max_iter=3).predict(df).collect() == first


def test_stages_can_be_released(spark):
    from mixlab import session

    held, session._staged[:] = list(session._staged), []
    df = session.stage(series(spark, [1]))
    assert df.count() == 1 and session.release_stages(spark) == 1 and session.release_stages(spark) == 0
    session._staged[:] = held


def test_run_from_daily_sales(spark):
    daily = si.simulate_spend(series(spark, range(60)).select("date"), ["x"]).select("date", F.col("spend").alias("revenue"))
    config = MixConfig(lags=None, windows=None, train_end_date=str(day(40)))
    out = run_mix(None, config, trees=False, sales=daily)
    assert out.metrics.first()["rmse"] >= 0 and out.budget.count() == len(CHANNELS)
    with pytest.raises(ValueError):
        run_mix(daily, config, sales=daily)


def test_shared_gbt_tells_repeated_rows_and_ends_with_the_application(spark):
    rows = [(float(i), float(i % 7)) for i in range(40)]
    one, other = (spark.createDataFrame(rows + extra, "tv double, revenue double") for extra in ([(5.0, 90.0)] * 2, [(30.0, 1.0)] * 2))
    first = mo.saved_gbt(one, ["tv"], max_iter=2)
    assert mo.saved_gbt(one, ["tv"], max_iter=2) is first
    again = mo.saved_gbt(other, ["tv"], max_iter=2)
    assert again is not first and again.predict(one).collect() != first.predict(one).collect()
    assert mo.saved_gbt(one, ["tv"], max_iter=2, max_depth=1) is not first


def test_weibull_without_weight_is_refused():
    from mixlab.functions.carryover import weibull_weights

    with pytest.raises(ValueError):
        weibull_weights(shape=2.0, max_lag=1)
    assert weibull_weights(shape=1.0, max_lag=1) == [1.0]


def test_boosting_keeps_no_node_ids_and_fits_the_same_trees(spark):
    rows = spark.range(60).selectExpr("cast(id % 7 as double) AS a", "cast(id % 11 as double) AS b", "cast((id * 37) % 53 as double) AS revenue")
    assert not mo._gbt(3, 3, 1).getCacheNodeIds()
    own = mo.train_gbt(rows, ["a", "b"], max_iter=3, max_depth=3, seed=1)
    kept = mo.TreeScorer(mo._gbt(3, 3, 1).setCacheNodeIds(True).fit(mo._training_rows(rows, ["a", "b"], "revenue")), ["a", "b"])
    found, wanted = ([r["prediction"] for r in s.predict(rows).orderBy("a", "b", "revenue").collect()] for s in (own, kept))
    assert found == pytest.approx(wanted, rel=1e-9) and len(set(found)) > 1
