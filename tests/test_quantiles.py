import numpy as np
import pytest

from mixlab.operators.prep import iqr_outliers, outlier_counts
from mixlab.operators.quantiles import exact_quantiles, quantile_columns

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]


def _frame(spark, groups):
    rows = [(g, float(v) if v is not None else None) for g, vs in groups.items() for v in vs]
    return spark.createDataFrame(rows, "g STRING, v DOUBLE").repartition(5)


def _check(spark, groups, id_cols):
    df = _frame(spark, groups)
    if not id_cols:
        groups = {"all": [v for vs in groups.values() for v in vs]}
    got = {
        (r["g"] if id_cols else "all"): r["quantiles"]
        for r in exact_quantiles(df, ["v"], PROBS, id_cols).collect()
    }
    for g, vs in groups.items():
        kept = [v for v in vs if v is not None and v == v]
        if kept:
            assert got[g] == pytest.approx(list(np.quantile(kept, PROBS)), rel=1e-12, abs=1e-12)
        else:
            assert g not in got


@pytest.mark.parametrize("id_cols", [[], ["g"]])
def test_random_skewed_and_repeated_values(spark, id_cols):
    rng = np.random.default_rng(7)
    _check(
        spark,
        {
            "hot": [5.0] * 3000 + list(rng.lognormal(0, 3, 1000)),
            "wide": list(rng.normal(0, 1e6, 900)),
            "tiny": [3.0],
            "pair": [1.0, 2.0],
            "constant": [4.0] * 50,
            "gaps": [None, 1.0, float("nan"), 9.0, None],
            "empty": [None, None],
            "negative": [-1.0, -2.0, -3.5, 0.0],
        },
        id_cols,
    )


def test_many_random_groups(spark):
    rng = np.random.default_rng(1)
    _check(spark, {str(i): list(rng.integers(0, 40, rng.integers(1, 60))) for i in range(60)}, ["g"])


def test_bounded_and_spread_routes_agree(spark):
    rng = np.random.default_rng(3)
    df = _frame(spark, {g: list(rng.exponential(10, 400)) for g in "abc"})
    spread = quantile_columns(df, ["v"], {"q1": 0.25, "med": 0.5}, ["g"]).orderBy("g").collect()
    held = quantile_columns(df, ["v"], {"q1": 0.25, "med": 0.5}, ["g"], bounded=True).orderBy("g").collect()
    for a, b in zip(spread, held):
        assert list(a) == pytest.approx(list(b))


def test_several_columns_at_once(spark):
    df = spark.range(101).selectExpr("CAST(id AS DOUBLE) AS a", "CAST(id * 2 AS INT) AS b")
    row = quantile_columns(df, ["a", "b"], {"med": 0.5}).first()
    assert (row["a_med"], row["b_med"]) == (50.0, 100.0)


def test_sketch_option(spark):
    df = spark.range(1001).selectExpr("CAST(id AS DOUBLE) AS a")
    assert quantile_columns(df, ["a"], {"med": 0.5}, exact=False).first()["a_med"] == pytest.approx(500, abs=1)


def test_outliers_and_missing_values_go(spark):
    df = _frame(spark, {"x": [*range(1, 21), 1000, None]})
    kept = sorted(r["v"] for r in iqr_outliers(df, "v").collect())
    assert kept == [float(i) for i in range(1, 21)]
    counts = outlier_counts(df, "v").first()
    assert (counts["n_rows"], counts["n_kept"], counts["n_removed"]) == (22, 20, 2)
    grouped = outlier_counts(df, "v", id_cols=["g"]).first()
    assert grouped["n_removed"] == 2


@pytest.mark.parametrize("most", [1, 20, 10**6])
def test_slices_are_cut_again_until_they_are_small(spark, most):
    """Nearly all mass in one narrow range, beside hot values and far outliers."""
    rng = np.random.default_rng(11)
    dense = list(1.0 + rng.random(6000) * 1e-9) + [1.0 + 5e-10] * 2000 + [-1e12, 1e12, 0.0, -0.0]
    groups = {"dense": dense, "hot": [2.0] * 3000 + [1.0, 3.0], "few": [1.0, 2.0, 4.0]}
    got = {r["g"]: r["quantiles"] for r in exact_quantiles(_frame(spark, groups), ["v"], PROBS, ["g"], most=most).collect()}
    for g, vs in groups.items():
        assert got[g] == pytest.approx(list(np.quantile(vs, PROBS)), rel=1e-15, abs=1e-15)
    whole = exact_quantiles(_frame(spark, groups), ["v"], PROBS, most=most).first()["quantiles"]
    assert whole == pytest.approx(list(np.quantile([v for vs in groups.values() for v in vs], PROBS)), rel=1e-15)


def test_the_input_is_read_once(spark, folder):
    from mixlab.plans import catalog

    rows = catalog.lines(spark, folder, "InvoiceDate", "TotalAmount")
    plan = exact_quantiles(rows, ["TotalAmount"], [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" not in plan
