"""Trees grown best leaf first, against a plain search over all thresholds of all leaves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mixlab.operators import attribution as at
from mixlab.operators import leafwise as lw

PLAIN = lw.Boosting(rounds=6, leaves=5, step=0.3, feature_part=1.0, row_part=1.0, least_rows=3, bins=1000)


def series(seed, n=90):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 12, n).astype(float), rng.normal(size=n).round(2)
    c = rng.integers(0, 2, n).astype(float)
    return np.stack([a, b, c], axis=1), 3 * (a > 6) + 2 * np.sin(3 * b) * c + rng.normal(scale=0.1, size=n)


def naive(x, y, how):
    """Predictions of boosting that tries every threshold of every feature in every leaf."""
    fitted = np.full(len(y), y.mean())
    for _ in range(how.rounds):
        residual, leaves = y - fitted, [np.arange(len(y))]
        while len(leaves) < how.leaves:
            best = (1e-9, None, None, None)
            for i, rows in enumerate(leaves):
                whole = residual[rows].sum() ** 2 / len(rows)
                for j in range(x.shape[1]):
                    for t in np.unique(x[rows, j])[:-1]:
                        goes = x[rows, j] <= t
                        if min(goes.sum(), (~goes).sum()) < how.least_rows:
                            continue
                        parts = rows[goes], rows[~goes]
                        gain = sum(residual[p].sum() ** 2 / len(p) for p in parts) - whole
                        if gain > best[0] + 1e-9:
                            best = (gain, i, *parts)
            if best[1] is None:
                break
            leaves[best[1] : best[1] + 1] = best[2:]
        for rows in leaves:
            fitted[rows] += how.step * residual[rows].mean()
    return fitted


def frame(spark, data):
    rows = [(e, i, *map(float, xs), float(t)) for e, (x, y) in data.items() for i, (xs, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "e STRING, i INT, a DOUBLE, b DOUBLE, c DOUBLE, revenue DOUBLE")


def predictions(df):
    return [r["prediction"] for r in df.orderBy("i").collect()]


def test_equals_the_plain_search(spark):
    x, y = series(1)
    df = frame(spark, {"one": (x, y)})
    scorer = lw.train_leafwise(df, ["a", "b", "c"], how=PLAIN)
    assert predictions(scorer.predict(df)) == pytest.approx(list(naive(x, y, PLAIN)), abs=1e-9)


def test_entities_are_fitted_by_themselves(spark):
    data = {e: series(seed) for seed, e in enumerate(["x", "y", None])}
    df = frame(spark, data)
    scorer = lw.train_leafwise(df, ["a", "b", "c"], id_cols=["e"], how=PLAIN)
    scored = scorer.predict(df.repartition(5))
    for e, (x, y) in data.items():
        assert predictions(scored.filter(F.col("e").eqNullSafe(e))) == pytest.approx(list(naive(x, y, PLAIN)), abs=1e-9)
    other = df.withColumn("e", F.lit("unknown"))
    assert set(predictions(scorer.predict(other))) == {None}


def test_partitions_do_not_change_drawn_trees(spark):
    df = frame(spark, {"one": series(2, 300)})
    how = lw.Boosting(rounds=12, leaves=6)
    trees = [lw.train_leafwise(part, ["a", "b", "c"], how=how).trees for part in (df.coalesce(1), df.repartition(7))]
    first, second = (sorted(t.collect(), key=lambda r: (r["tree"], r["node"])) for t in trees)
    assert first == second
    assert max(r["rows"] for r in first if r["tree"] > 0) == 240


def test_gain_and_tree_shapes(spark):
    x, y = series(3, 200)
    df = frame(spark, {"one": (x, y)}).withColumn("same", F.lit(7.0))
    scorer = lw.train_leafwise(df, ["a", "b", "c", "same"], how=PLAIN)
    got = {r["feature"]: r for r in lw.gain_importance(scorer).collect()}
    assert got["same"]["importance"] == 0 and got["same"]["splits"] == 0
    assert got["a"]["importance"] > got["b"]["importance"] > 0
    per_tree = scorer.trees.filter("tree > 0").groupBy("tree").agg(
        F.count(F.when(F.col("feature").isNull(), 1)).alias("leaves"), F.count("feature").alias("splits")
    )
    assert all(r["leaves"] == r["splits"] + 1 <= PLAIN.leaves for r in per_tree.collect())
    # With a step of 1 a tree's gains are what it takes off the squared error.
    full = lw.train_leafwise(df, ["a", "b", "c"], how=lw.Boosting(rounds=3, leaves=4, step=1.0, feature_part=1.0, row_part=1.0))
    left = sum((np.array(predictions(full.predict(df))) - y) ** 2)
    assert full.trees.agg(F.sum("gain")).first()[0] == pytest.approx(sum((y - y.mean()) ** 2) - left)


def test_effects_equal_separate_scoring(spark):
    df = frame(spark, {"one": series(4)}).withColumnsRenamed({"a": "tv_adstock", "b": "radio_adstock"}).withColumn("date", F.col("i"))
    for ids in ([], ["e"]):
        scorer = lw.train_leafwise(df, ["tv_adstock", "radio_adstock"], id_cols=ids, how=PLAIN)
        got = at.contributions(df, scorer, ["tv", "radio"], ids).orderBy("date").collect()
        whole, without = predictions(scorer.predict(df)), predictions(scorer.predict(df.withColumn("tv_adstock", F.lit(0.0))))
        assert [r["tv_contribution"] for r in got] == pytest.approx([p - q for p, q in zip(whole, without)])
        for r in got:
            assert r["tv_contribution"] + r["radio_contribution"] + r["baseline_contribution"] == pytest.approx(r["predicted_revenue"])


def test_many_values_fall_into_bins(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 3))
    y = np.where(x[:, 1] > 0.5, 4.0, 0.0)
    df = frame(spark, {"one": (x, y)})
    scorer = lw.train_leafwise(df, ["a", "b", "c"], how=lw.Boosting(rounds=60))
    error = np.array(predictions(scorer.predict(df))) - y
    assert np.sqrt((error**2).mean()) < 0.4
    split = scorer.trees.filter("tree = 1 AND node = 0").first()
    assert split["feature"] == "b" and split["threshold"] == pytest.approx(0.5, abs=0.05)


def test_missing_values_go_left_and_odd_rows(spark):
    x, y = series(6, 60)
    x[:30, 1], y[:30] = np.nan, y[:30] + 50
    df = frame(spark, {"one": (x, y)})
    odd = df.withColumn("b", F.when(F.isnan("b"), F.when(F.col("i") % 3 == 0, F.lit(float("inf"))).when(F.col("i") % 3 == 1, F.col("b"))).otherwise(F.col("b")))
    how = lw.Boosting(rounds=1, leaves=2, feature_part=1.0, row_part=1.0, step=1.0)
    extra = odd.limit(1).withColumn("revenue", F.lit(None).cast("double")).unionByName(odd.limit(1).withColumn("revenue", F.lit(float("nan"))))
    scorer = lw.train_leafwise(odd.unionByName(extra), ["a", "b", "c"], how=how)
    root = scorer.trees.filter("tree = 1 AND node = 0").first()
    assert (root["feature"], root["threshold"], root["rows"]) == ("b", float("-inf"), 60)
    assert predictions(scorer.predict(odd))[:30] == pytest.approx([y[:30].mean()] * 30)
    # A clashing column stays, an earlier prediction is replaced.
    again = scorer.predict(odd.withColumn("tree", F.lit(1)).withColumn("prediction", F.lit(9.0)))
    assert "tree" in again.columns and 9.0 not in predictions(again)


def test_no_rows_few_rows_and_refusals(spark, monkeypatch):
    df = frame(spark, {"one": series(7, 5)})
    for ids in ([], ["e"]):
        empty = lw.train_leafwise(df.limit(0), ["a", "b"], id_cols=ids)
        assert empty.trees.count() == 0 and set(predictions(empty.predict(df))) == {None}
    few = lw.train_leafwise(df, ["a", "b"], how=lw.Boosting(rounds=3))
    assert few.trees.filter("feature IS NOT NULL").count() == 0
    with pytest.raises(ValueError):
        lw.train_leafwise(df.withColumnRenamed("e", "tree"), ["a"], id_cols=["tree"])
    with pytest.raises(ValueError):
        lw.train_leafwise(df, [])
    monkeypatch.setattr(lw, "MOST_CELLS", 4)
    with pytest.raises(ValueError, match="more than one task"):
        lw.train_leafwise(df, ["a"])
