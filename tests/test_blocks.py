import datetime
import random

import pytest
from pyspark.sql import functions as F

from mixlab.functions.carryover import channel_weights
from mixlab.operators import blocks as bl
from mixlab.operators import features as fe
from mixlab.operators import panel as pa
from mixlab.operators import simulate as si
from mixlab.operators.channels import adstock, channel_transform

START = datetime.date(1999, 11, 1)


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(1)
    rows = [(s, START + datetime.timedelta(days=d), rng.random() * 100, rng.random()) for s in ("x", "y", None) for d in range(0, 700) if rng.random() < (0.9 if s == "x" else 0.2)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "s string, date date, tv double, radio double").repartition(4)


def ordered(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


@pytest.mark.parametrize("days", [1, 7, 90, 10000])
def test_positions_count_every_row(series, days):
    got = bl.positions(series, "at", ["s"], days=days, total="length").collect()
    for s in ("x", "y", None):
        mine = sorted((r["date"], r["at"], r["length"]) for r in got if r["s"] == s)
        assert [m[1] for m in mine] == list(range(len(mine))) and {m[2] for m in mine} == {len(mine)}
    whole = bl.positions(series.filter("s = 'x'"), "at", days=days).orderBy("date").collect()
    assert [r["at"] for r in whole] == list(range(len(whole)))


def test_positions_over_timestamps_and_nulls(spark):
    rows = [(datetime.datetime(2024, 1, 1, h % 24, h), h) for h in range(50)] + [(None, 99), (None, 98)]
    df = spark.createDataFrame(rows, "ts timestamp, n int")
    got = bl.positions(df, "at", order=["ts", "n"], days=0.1).orderBy("at").collect()
    assert [r["at"] for r in got] == list(range(52)) and [r["n"] for r in got[:2]] == [98, 99]
    assert bl.positions(df.limit(0), "at", order=["ts"]).collect() == []


@pytest.mark.parametrize("rows", [1, 4, 10, 97, 100000])
def test_carry_over_is_the_same_for_every_block_length(series, rows):
    weights = [1.0, 0.6, 0.3, 0.2, 0.1, 0.05]
    want = adstock(series, "tv", weights, ["s"])
    got = bl.in_blocks(series, lambda df, ids: adstock(df, "tv", weights, ids), 5, ["s"], rows=rows, days=50)
    assert got.columns == want.columns and ordered(got) == ordered(want)


@pytest.mark.parametrize("rows", [3, 64])
def test_channels_lags_and_windows_in_blocks(series, rows):
    one = series.filter("s = 'x'").drop("s")
    params = {"tv": {"decay_rate": 0.5, "max_lag": 6}, "radio": {"adstock_type": "weibull", "max_lag": 12, "saturation_type": "exp", "S": 2.0}}
    halo = max(len(channel_weights(p)) for p in params.values()) - 1

    def every(df, ids):
        return fe.rolling_features(fe.lag_features(channel_transform(df, ["tv", "radio"], params, ids), ["tv"], [1, 9], ids), ["radio"], [7], ids)

    got = bl.in_blocks(one, every, max(halo, 9, 7), rows=rows, days=30)
    a, b = got.orderBy("date").collect(), every(one, []).orderBy("date").collect()
    assert len(a) == len(b) and [r["date"] for r in a] == [r["date"] for r in b]
    for c in (c for c in one.columns if c != "date"):
        assert [r[c] for r in a] == [r[c] for r in b], c
    for c in ("tv_adstock", "radio_adstock", "tv_lag_1", "tv_lag_9", "radio_avg_7d", "radio_sum_7d", "radio_max_7d"):
        assert [r[c] or 0.0 for r in a] == pytest.approx([r[c] or 0.0 for r in b], rel=1e-12), c


def test_no_task_holds_a_series(series):
    df = bl.in_blocks(series.drop("s"), lambda d, ids: adstock(d, "tv", [1.0, 0.5], ids), 1, rows=50, days=30)
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    # The only exchange into one task carries the row counts of the spans.
    for at, line in enumerate(lines):
        assert "Python" not in line
        if "SinglePartition" in line:
            assert "HashAggregate" in lines[at + 1] and "count(1)" in lines[at + 1]
    windows = [line for line in lines if "Window [" in line and "lag(" in line]
    assert windows and all("_block" in line for line in windows)
    assert bl.in_blocks(series.limit(0), lambda d, ids: adstock(d, "tv", [1.0], ids), 0).collect() == []
    with pytest.raises(ValueError):
        bl.in_blocks(series, lambda d, ids: d, -1)


def test_folds_and_index_per_series(series):
    folds = pa.time_folds(series, 3, ["s"]).collect()
    for s in ("x", "y", None):
        mine = [r["fold"] for r in sorted((r for r in folds if r["s"] == s), key=lambda r: r["date"])]
        size = len(mine) // 4
        assert mine == [-1] * (len(mine) - 3 * size) + [k for k in range(3) for _ in range(size)]
    index = fe.series_index(series, ["s"])
    assert dict(index.dtypes)["series_index"] == "int"
    assert pa.fold_rows(series, 3, ["s"]).count() == series.count()


def test_simulated_spend_per_series(spark):
    dates = spark.createDataFrame([(s, START + datetime.timedelta(days=d)) for s in ("a", "b") for d in range(9)], "s string, date date")
    both = si.simulate_spend(dates, ["tv", "radio"], noise=0.0, id_cols=["s"])
    alone = si.simulate_spend(dates.filter("s = 'a'").drop("s"), ["tv", "radio"], noise=0.0)
    assert ordered(both.filter("s = 'b'"), "date", "channel", "spend") == ordered(alone, "date", "channel", "spend")
    noisy = si.simulate_spend(dates, ["tv"], id_cols=["s"]).groupBy("date").agg(F.countDistinct("spend").alias("n"))
    assert noisy.filter("n = 2").count() > 5
