import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from mixlab.operators import gram as gr
from mixlab.operators import model as mo
from mixlab.operators import panel as pa
from mixlab.plans.catalog import QUERIES

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    out = []
    for e in range(4):
        x = rng.normal(size=(60 + 20 * e, 3)) * [1, 40, 900] + [0, 1e5, 7]
        y = 5 * e + x @ [2.0, -1.5, 0.25] + rng.normal(size=len(x))
        days = [datetime.date(2020, 1, 1) + datetime.timedelta(days=i) for i in range(len(x))]
        out += [(f"e{e}", d, *map(float, v), float(t)) for d, v, t in zip(days, x, y)]
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "e string, date date, a double, b double, c double, revenue double").repartition(5)


def exact(rows, names=3):
    x = np.array([[1.0, *r[2 : 2 + names]] for r in rows])
    y = np.array([r[5] for r in rows])
    # Centred, so that the large mean of b costs no digits.
    mx, my = x[:, 1:].mean(0), y.mean()
    slopes = np.linalg.lstsq(x[:, 1:] - mx, y - my, rcond=None)[0]
    return my - slopes @ mx, slopes


def test_fits_match_least_squares_per_entity(frame, rows):
    for r in gr.train_linear_by(frame, NAMES, ["e"]).collect():
        mine = [x for x in rows if x[0] == r["e"]]
        intercept, slopes = exact(mine)
        assert r["n"] == len(mine)
        assert r["slopes"] == pytest.approx(list(slopes), rel=1e-9)
        assert r["intercept"] == pytest.approx(intercept, rel=1e-7)
        assert 0.999 < r["r2"] <= 1


def test_merged_blocks_are_the_block_of_all_rows(frame):
    columns = [*NAMES, "revenue"]
    monthly = gr.gram_blocks(frame.withColumn("m", F.month("date")), columns, ["e", "m"])
    merged = {r["e"]: r for r in gr.merge_blocks(monthly, 4, ["e"]).collect()}
    for r in gr.gram_blocks(frame, columns, ["e"]).collect():
        other = merged[r["e"]]
        assert other["n"] == r["n"] and other["means"] == pytest.approx(r["means"], rel=1e-12)
        assert other["moments"] == pytest.approx(r["moments"], rel=1e-6, abs=1e-3)


def test_errors_come_from_blocks_alone(frame, rows):
    folds = pa.fold_rows(frame, 3, ["e"])
    got = {(r["e"], r["fold"]): r for r in gr.cross_validate_by(folds, NAMES, ["e"]).collect()}
    assert len(got) == 12
    for e in range(4):
        mine = [x for x in rows if x[0] == f"e{e}"]
        part = len(mine) // 4
        start = len(mine) - 3 * part
        for k in range(3):
            train, test = mine[: start + k * part], mine[start + k * part : start + (k + 1) * part]
            intercept, slopes = exact(train)
            error = np.array([t[5] - intercept - np.dot(slopes, t[2:5]) for t in test])
            r = got[f"e{e}", k]
            assert (r["n_train"], r["n"]) == (len(train), len(test))
            assert r["rmse"] == pytest.approx(np.sqrt((error**2).mean()), rel=1e-5)


def test_odd_columns(spark, frame):
    """Constant and repeated columns get slope 0; rows with a null or NaN are left out; entities without rows vanish."""
    wide = frame.withColumns({"one": F.lit(1.0), "twice": F.col("a") * 2})
    odd = wide.unionByName(
        spark.createDataFrame(
            [("e0", None, None, 1.0, 1.0, 1.0, 1.0, 1.0), ("e0", None, float("nan"), 1.0, 1.0, 1.0, 1.0, 1.0), ("none", None, None, 1.0, 1.0, 1.0, 1.0, 1.0), (None, None, 1.0, 1.0, 1.0, 9.0, 1.0, 1.0)],
            wide.schema,
        )
    )
    got = {r["e"]: r for r in gr.train_linear_by(odd, ["a", "one", "twice", "b", "c"], ["e"]).collect()}
    plain = {r["e"]: r for r in gr.train_linear_by(frame, NAMES, ["e"]).collect()}
    assert set(got) == {*plain, None}
    for e, r in plain.items():
        s = got[e]["slopes"]
        assert s[1] == s[2] == 0.0 and [s[0], s[3], s[4]] == pytest.approx(r["slopes"], rel=1e-9)
    assert got[None]["slopes"] == [0.0] * 5 and got[None]["intercept"] == 9.0 and got[None]["r2"] is None
    assert gr.train_linear_by(odd.limit(0), NAMES, ["e"]).collect() == []


def test_scores_meet_their_entity(spark, frame):
    fits = gr.train_linear_by(frame, NAMES, ["e"])
    scored = gr.score_by(frame.withColumn("slopes", F.lit("clash")), fits, NAMES, ["e"])
    assert scored.filter("abs(prediction - revenue) > 6").count() == 0
    assert scored.columns == [*frame.columns, "slopes", "prediction"]
    other = spark.createDataFrame([("new", None, 1.0, 1.0, 1.0, 1.0)], frame.schema)
    assert gr.score_by(other, fits, NAMES, ["e"]).first()["prediction"] is None


def test_linear_model_without_rows(frame):
    fit = mo.train_linear(frame.limit(0), NAMES)
    assert fit.intercept == 0.0 and set(fit.coefs.values()) == {0.0}


def test_cross_validation_by_id_and_by_learner(frame):
    by = {(r["e"], r["fold"]): r["rmse"] for r in mo.cross_validate(frame, NAMES, k=2, id_cols=["e"]).collect()}
    assert len(by) == 8
    one = frame.filter("e = 'e2'")
    own = {r["fold"]: r["rmse"] for r in mo.cross_validate(one, NAMES, k=2).collect()}
    slow = {r["fold"]: r["rmse"] for r in mo.cross_validate(one, NAMES, k=2, fit=mo.train_linear).collect()}
    assert own == pytest.approx(slow, rel=1e-6) and own[0] == pytest.approx(by["e2", 0], rel=1e-6)
    with pytest.raises(ValueError):
        mo.cross_validate(frame, NAMES, fit=mo.train_linear, id_cols=["e"])


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_scan_of_the_lines(spark, folder):
    plan = _plan(QUERIES["train_linear_by"](spark, folder))
    assert plan.split("Initial Plan")[0].count("FileScan parquet [l_orderkey") == 1
    assert "Python" not in plan and "CartesianProduct" not in plan
    folds = _plan(gr.cross_validate_by(spark.createDataFrame([], "fold int, x double, revenue double"), ["x"]))
    assert folds.count("Scan") <= 1 and "Python" not in folds
