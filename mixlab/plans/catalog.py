"""The registered queries: each operator run over the provided tables, with its SQL check.

A query rounds its doubles only to compare two engines; the operators do not round.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixlab.config import CHANNELS as MEDIA
from mixlab.config import BOOSTING_ROUNDS, DEFAULT_LAGS, DEFAULT_WINDOWS, IMPORTANCE_ROUNDS
from mixlab.functions.calendar import PROMO_DAYS, UK_HOLIDAYS, WEEKDAYS
from mixlab.functions.carryover import channel_weights, geometric_weights, saturate, weibull_weights
from mixlab.operators import attribution as at
from mixlab.operators import blocks as bl
from mixlab.operators import budget as bu
from mixlab.operators import features as fe
from mixlab.operators import gram as gr
from mixlab.operators import leafwise as lw
from mixlab.operators import model as mo
from mixlab.operators import panel as pa
from mixlab.operators import prep as pr
from mixlab.operators import profile as pf
from mixlab.operators import rollup as ru
from mixlab.operators import simulate as si
from mixlab.operators.channels import adstock, channel_transform
from mixlab.plans import reports as rp
from mixlab.plans.oracle import (
    FULL_CALENDAR,
    HOLIDAY_FLAGS,
    SHORT_CALENDAR,
    STEPS,
    adstock_sql,
    build,
    dates_sql,
    fitted_value,
    hill_sql,
    least_squares,
    number,
    rounds,
    total,
    uniform_sql,
)
from mixlab.plans.settings import (
    CHANNELS,
    GRID,
    MAX_PCT,
    MIN_PCT,
    PARAMS,
    RANGE,
    SCORER,
    SEED,
    TEST_START,
    TOTAL,
    TRAIN_END,
)
from mixlab.session import stage, staging_path
from mixlab.sources import files
from mixlab.sources.retail import hourly_view, order_layout, retail_view, spend_view, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

ADSTOCKS = [f"{c}_adstock" for c in CHANNELS]
PARTS = [f"{p}_contribution" for p in (*CHANNELS, "baseline")]


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def rounded(df: DataFrame, places: int, *cols: str) -> DataFrame:
    """Round the named columns, or every double."""
    names = cols or [c for c, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(c, places) for c in names})


# ---- shared inputs ---------------------------------------------------------


def lines(spark, d, *cols: str, between: tuple[str, str] | None = None, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """Invoice lines with ``cols``; TotalAmount on request."""
    if "TotalAmount" not in cols:
        return retail_view(spark, d, cols, between, tables)
    base = dict.fromkeys([*[c for c in cols if c != "TotalAmount"], "Quantity", "UnitPrice"])
    return pr.line_amount(retail_view(spark, d, base, between, tables)).select(*cols)


SALES_COLUMNS = ("InvoiceDate", "InvoiceNo", "CustomerID", "TotalAmount")


def sales(spark, d) -> DataFrame:
    return pf.daily_sales(lines(spark, d, *SALES_COLUMNS))


def country_sales(spark, d) -> DataFrame:
    return pf.daily_sales(lines(spark, d, "Country", *SALES_COLUMNS), id_cols=["Country"])


def days(spark, d) -> DataFrame:
    return pf.distinct_dates(lines(spark, d, "InvoiceDate"), "InvoiceDate")


def calendar(spark, d) -> DataFrame:
    """Every order date, read from the orders alone."""
    dates = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    return pf.distinct_dates(dates)


def external(spark, d) -> DataFrame:
    return si.simulate_external(calendar(spark, d), noise=0)


def wide(spark, d) -> DataFrame:
    return pa.pivot_spend(spend_view(spark, d), CHANNELS)


def country_wide(spark, d, exact: bool = False) -> DataFrame:
    rows = lines(spark, d, "Country", "InvoiceDate", "channel", "spend")
    return pa.pivot_spend(rows.withColumnRenamed("InvoiceDate", "date"), CHANNELS, ["Country"], exact=exact)


def panel_base(spark, d, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """Daily sales and spend per channel, in one pass over the lines."""
    return pa.sales_with_spend(lines(spark, d, *SALES_COLUMNS, "channel", "spend", tables=tables), CHANNELS)


def panel(spark, d) -> DataFrame:
    """The panel in one pass over the lines; the factors are expressions of its own dates."""
    return panel_of(panel_base(spark, d))


def panel_of(base: DataFrame) -> DataFrame:
    return pa.finish_panel(base.select("*", *si.external_columns(noise=0)), CHANNELS, PARAMS)


def contributions(spark, d) -> DataFrame:
    return at.contributions(panel(spark, d), SCORER, CHANNELS)


def median_roi(spark, d) -> DataFrame:
    return at.median_roi(contributions(spark, d), CHANNELS, bounded=True)


def allocation(spark, d) -> DataFrame:
    return bu.allocate_budget(median_roi(spark, d), TOTAL, MIN_PCT, MAX_PCT)


def day_scenarios(spend: DataFrame) -> DataFrame:
    """One scenario per day: that day's spend mix, applied to the whole budget."""
    return spend.select(
        F.col("date").cast("string").alias("scenario"),
        "channel",
        F.col("spend").alias("allocation_pct"),
        F.lit(TOTAL).alias("total_budget"),
    )


def scenarios(spark, d) -> DataFrame:
    return day_scenarios(spend_view(spark, d))


def simulated(spark, d) -> tuple[DataFrame, DataFrame]:
    """The simulated scenarios and the contributions they rest on; the lines are read once, for the staged days."""
    base = stage(panel_base(spark, d), "days")
    scored = stage(at.contributions(panel_of(base), SCORER, CHANNELS))
    mixes = day_scenarios(pa.long_spend(base, CHANNELS))
    return bu.simulate_scenarios(mixes, at.median_roi(scored, CHANNELS, bounded=True)), scored


def scenario_rows(spark, d) -> DataFrame:
    rows, scored = simulated(spark, d)
    return bu.append_baseline(rows, bu.mean_baseline(scored))


def features_of(df: DataFrame) -> list[str]:
    return mo.feature_columns(df)


def boosted(spark, d, rounds: int = BOOSTING_ROUNDS):
    """Trees fitted on the days before the split, and the panel they belong to."""
    data = stage(panel(spark, d))
    train, _ = pa.time_split(data, TRAIN_END)
    return mo.saved_gbt(train, features_of(data), max_iter=rounds, seed=SEED), data


# ---- sources and sinks -----------------------------------------------------

_ORDER_SQL = (
    "SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice FROM orders"
)


def _orders(spark, d) -> DataFrame:
    return table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_date"), "o_totalprice"
    )


@query("scan_csv", _ORDER_SQL)
def _scan_csv(spark, d):
    path = staging_path(spark, "orders-csv")
    files.write_csv(_orders(spark, d), path)
    return files.scan_csv(
        spark, path, "o_orderkey LONG, o_custkey LONG, order_date DATE, o_totalprice DOUBLE"
    )


@query(
    "scan_csv_by_header",
    "SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, "
    "o_orderstatus AS note FROM orders",
)
def _scan_csv_by_header(spark, d):
    """Other order, a further column, ids as 17850.0 and dates as 12/1/2010 8:26."""
    path = staging_path(spark, "orders-csv")
    orders = table(spark, d, "orders").select(
        F.col("o_orderstatus").alias("note"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"),
        F.date_format("o_orderdate", "M/d/yyyy H:mm").alias("order_date"),
        F.col("o_custkey").cast("double").alias("o_custkey"),
        "o_orderkey",
    )
    files.write_csv(orders, path)
    return files.scan_csv(spark, path, "o_orderkey LONG, o_custkey LONG, order_date DATE, o_totalprice DECIMAL(12,2)")


@query(
    "scan_csv_folder",
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS o_custkey, CAST(o_orderdate AS DATE) AS order_date, "
    "CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS note FROM orders",
)
def _scan_csv_folder(spark, d):
    """Three days' worth of files in one folder: other orders of columns, one column missing, one more."""
    path = staging_path(spark, "orders-folder")
    orders = table(spark, d, "orders").withColumn("order_date", F.date_format("o_orderdate", "M/d/yyyy H:mm"))
    kinds = {
        "O": ["o_orderkey", "o_custkey", "order_date"],
        "F": ["order_date", "o_orderkey"],
        "P": [F.col("o_orderpriority").alias("note"), "order_date", "o_custkey", "o_orderkey"],
    }
    for status, columns in kinds.items():
        orders.filter(F.col("o_orderstatus") == status).select(*columns).write.mode("append").option("header", True).csv(path)
    return files.scan_csv_folder(spark, path, "o_orderkey LONG, o_custkey LONG, order_date DATE")


@query(
    "csv_rejected",
    "SELECT 'o_orderkey' AS \"column\", CAST(0 AS BIGINT) AS rejected UNION ALL "
    "SELECT 'order_date', count(*) FILTER (o_orderstatus = 'O') FROM orders",
)
def _csv_rejected(spark, d):
    path = staging_path(spark, "orders-csv")
    day = F.when(F.col("o_orderstatus") == "O", "some day").otherwise(F.col("o_orderdate").cast("date").cast("string"))
    files.write_csv(table(spark, d, "orders").select("o_orderkey", day.alias("order_date")), path)
    return files.rejected_values(spark, path, "o_orderkey LONG, order_date DATE")


@query(
    "preview_rows",
    build("SELECT date, revenue, transactions, unique_customers FROM sales ORDER BY date LIMIT 5", "sales"),
)
def _preview_rows(spark, d):
    return files.preview_rows(sales(spark, d), 5, ["date"])


@query(
    "append_scenarios",
    build("SELECT scenario, channel, allocation_pct, total_budget FROM scenarios", "scenarios"),
)
def _append_scenarios(spark, d):
    """Scenarios of odd and of even years, saved one after the other and read back together."""
    path = staging_path(spark, "scenarios")
    rows = stage(scenarios(spark, d))
    odd = F.substring("scenario", 1, 4).cast("int") % 2 == 1
    files.append_parquet(rows.filter(odd), path)
    files.append_parquet(rows.filter(~odd), path)
    return files.scan_parquet(spark, path)


@query("write_csv", build("SELECT * FROM sales", "sales"))
def _write_csv(spark, d):
    path = staging_path(spark, "sales-csv")
    files.write_csv(sales(spark, d), path)
    return files.scan_csv(spark, path, "date DATE, revenue DOUBLE, transactions LONG, unique_customers LONG")


@query("write_parquet", build("SELECT * FROM country_sales", "country_sales"))
def _write_parquet(spark, d):
    path = staging_path(spark, "country-sales")
    files.write_parquet(country_sales(spark, d), path, ["Country"])
    return files.scan_parquet(spark, path)


@query("scan_parquet", build("SELECT date, revenue, economy, standard FROM joined", "joined"))
def _scan_parquet(spark, d):
    path = staging_path(spark, "panel")
    files.write_parquet(panel(spark, d), path)
    return files.scan_parquet(spark, path).select("date", "revenue", "economy", "standard")


_METRIC_SQL = (
    "sqrt(avg((revenue - predicted_revenue) * (revenue - predicted_revenue))) AS rmse, "
    "avg(abs(revenue - predicted_revenue)) AS mae, "
    "1.0e0 - sum((revenue - predicted_revenue) * (revenue - predicted_revenue)) "
    "/ (var_pop(revenue) * count(*)) AS r2, "
    "avg(abs((revenue - predicted_revenue) / (revenue + 1))) * 100 AS mape"
)
_METRICS = ("rmse", "mae", "r2", "mape")


def _metrics(spark, d) -> DataFrame:
    return mo.evaluate(SCORER.predict(panel(spark, d)))


@query(
    "write_metrics_json",
    build(f"SELECT {rounds(_METRICS, 6)} FROM (SELECT {_METRIC_SQL} FROM scored)", "scored"),
)
def _write_metrics_json(spark, d):
    path = staging_path(spark, "metrics")
    files.write_metrics_json(_metrics(spark, d), path)
    return rounded(spark.read.schema(files.METRICS).json(path), 6)


@query(
    "load_results",
    build(
        "SELECT date, round(predicted_revenue, 4) AS predicted_revenue, "
        "round(baseline_contribution, 4) AS baseline_contribution, round(economy_roi, 6) AS economy_roi, "
        "round((SELECT sum(budget) FROM allocation), 4) AS total_budget, "
        f"round((SELECT rmse FROM (SELECT {_METRIC_SQL} FROM scored)), 4) AS rmse FROM contributions",
        "contributions", "allocation",
    ),
)
def _load_results(spark, d):
    folder = staging_path(spark, "results")
    data = stage(panel(spark, d))
    scored = at.contributions(data, SCORER, CHANNELS)
    budget = bu.allocate_budget(at.median_roi(scored, CHANNELS, bounded=True), TOTAL, MIN_PCT, MAX_PCT)
    files.save_results(scored, budget, mo.evaluate(SCORER.predict(data)), folder)
    daily, budget, metrics = files.load_results(spark, folder, CHANNELS)
    return daily.select(
        "date",
        F.round("predicted_revenue", 4).alias("predicted_revenue"),
        F.round("baseline_contribution", 4).alias("baseline_contribution"),
        F.round("economy_roi", 6).alias("economy_roi"),
        F.round(bu.total_budget(budget).scalar(), 4).alias("total_budget"),
        F.round(metrics.select("rmse").scalar(), 4).alias("rmse"),
    )


@query(
    "external_or_empty",
    build(
        "SELECT date, revenue, 0.0e0 AS gdp, 0.0e0 AS unemployment, 0.0e0 AS consumer_confidence FROM sales",
        "sales",
    ),
)
def _external_or_empty(spark, d):
    missing = files.external_or_empty(spark, f"{d}/no_such_external.csv")
    return pr.zero_fill(pa.join_external(sales(spark, d).select("date", "revenue"), missing))


_SCHEMA_ROWS = (
    ("InvoiceNo", "string"), ("StockCode", "bigint"), ("Description", "string"), ("Quantity", "int"),
    ("InvoiceDate", "date"), ("UnitPrice", "decimal(10,2)"), ("CustomerID", "bigint"), ("Country", "string"),
)


@query(
    "preview_schema",
    build(
        " UNION ALL ".join(
            f"SELECT CAST({i} AS INTEGER) AS position, '{n}' AS name, '{t}' AS type, "
            f"count(*) FILTER ({n} IS NULL) AS nulls FROM retail"
            for i, (n, t) in enumerate(_SCHEMA_ROWS)
        ),
        "retail",
    ),
)
def _preview_schema(spark, d):
    view = retail_view(spark, d, [n for n, _ in _SCHEMA_ROWS])
    nulls = pf.null_counts(view).withColumnRenamed("column", "name")
    return files.preview_schema(view).join(nulls, "name")


# ---- projections and filters -----------------------------------------------


@query(
    "parse_date",
    "SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' "
    "ELSE strftime(o_orderdate, '%Y-%m-%d') END AS DATE) AS InvoiceDate FROM orders",
)
def _parse_date(spark, d):
    text = F.when(F.col("o_orderkey") % 97 == 0, "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    raw = table(spark, d, "orders").select("o_orderkey", text.alias("InvoiceDate"))
    return pr.parse_date(raw, "InvoiceDate", "yyyy-MM-dd")


@query(
    "line_amount",
    build("SELECT InvoiceNo, StockCode, Quantity, CAST(TotalAmount AS DOUBLE) AS TotalAmount FROM retail", "retail"),
)
def _line_amount(spark, d):
    rows = lines(spark, d, "InvoiceNo", "StockCode", "Quantity", "TotalAmount")
    return rows.withColumn("TotalAmount", F.col("TotalAmount").cast("double"))


@query(
    "zero_fill",
    build("SELECT date, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in CHANNELS) + " FROM wide", "wide"),
)
def _zero_fill(spark, d):
    return pr.zero_fill(wide(spark, d))


@query(
    "clip",
    build(
        "SELECT InvoiceNo, StockCode, least(greatest(CAST(TotalAmount AS DOUBLE), 0), 1000) AS TotalAmount FROM retail",
        "retail",
    ),
)
def _clip(spark, d):
    return pr.clip(lines(spark, d, "InvoiceNo", "StockCode", "TotalAmount"), "TotalAmount", 0, 1000)


@query(
    "strip_suffix",
    build(
        "SELECT regexp_replace(label, '_contribution$', '') AS channel, label, CAST(sum(Quantity) AS BIGINT) AS quantity "
        "FROM (SELECT channel || '_contribution' AS label, Quantity FROM retail) GROUP BY ALL",
        "retail",
    ),
)
def _strip_suffix(spark, d):
    labelled = lines(spark, d, "channel", "Quantity").withColumn("label", F.concat("channel", F.lit("_contribution")))
    totals = labelled.groupBy("label").agg(F.sum("Quantity").alias("quantity"))
    return totals.withColumn("channel", at.strip_suffix("label"))


@query("exclude_returns", build("SELECT InvoiceNo, StockCode, Quantity FROM retail WHERE Quantity > 0", "retail"))
def _exclude_returns(spark, d):
    return pr.exclude_returns(lines(spark, d, "InvoiceNo", "StockCode", "Quantity"))


@query(
    "date_range",
    build(f"SELECT * FROM sales WHERE date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'", "sales"),
)
def _date_range(spark, d):
    return pf.daily_sales(lines(spark, d, *SALES_COLUMNS, between=RANGE))


@query(
    "date_range_operator",
    build(f"SELECT * FROM country_sales WHERE date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'", "country_sales"),
)
def _date_range_operator(spark, d):
    return pr.date_range(country_sales(spark, d), *RANGE)


@query(
    "time_split",
    build(
        f"SELECT date, revenue, CASE WHEN date <= DATE '{TRAIN_END}' THEN 'train' ELSE 'test' END AS part FROM sales "
        f"WHERE date <= DATE '{TRAIN_END}' OR date >= DATE '{TEST_START}'",
        "sales",
    ),
)
def _time_split(spark, d):
    return pa.time_part(sales(spark, d).select("date", "revenue"), TRAIN_END, TEST_START)


@query(
    "returns_rate",
    build(
        "SELECT count(*) AS n_lines, count(*) FILTER (Quantity < 0) AS n_returns, "
        "round(count(*) FILTER (Quantity < 0) / count(*) * 100, 8) AS returns_pct FROM retail",
        "retail",
    ),
)
def _returns_rate(spark, d):
    return rounded(pf.returns_rate(lines(spark, d, "Quantity")), 8)


def _iqr_sql(source: str, col: str, t: float, keys: str = "") -> str:
    group = f"{keys}, " if keys else ""
    match = f"USING ({keys})" if keys else "ON true"
    by = f" GROUP BY {keys}" if keys else ""
    return (
        f"{source} s JOIN (SELECT {group}quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.75) AS q3 "
        f"FROM {source}{by}) q {match} WHERE {col} BETWEEN q1 - {number(t)} * (q3 - q1) AND q3 + {number(t)} * (q3 - q1)"
    )


@query(
    "iqr_outliers",
    build(
        "SELECT InvoiceNo, StockCode, TotalAmount FROM " + _iqr_sql("amounts", "TotalAmount", 0.5),
        "retail",
        amounts="SELECT InvoiceNo, StockCode, CAST(TotalAmount AS DOUBLE) AS TotalAmount FROM retail",
    ),
)
def _iqr_outliers(spark, d):
    amounts = lines(spark, d, "InvoiceNo", "StockCode", "TotalAmount")
    amounts = stage(amounts.withColumn("TotalAmount", F.col("TotalAmount").cast("double")))
    return pr.iqr_outliers(amounts, "TotalAmount", threshold=0.5)


@query(
    "iqr_outliers_by_country",
    build(
        "SELECT Country, date, revenue FROM " + _iqr_sql("country_sales", "revenue", 1.5, "Country"),
        "country_sales",
    ),
)
def _iqr_by_country(spark, d):
    kept = pr.iqr_outliers(country_sales(spark, d), "revenue", 1.5, ["Country"], bounded=True)
    return kept.select("Country", "date", "revenue")


@query(
    "outlier_counts",
    build(
        "SELECT n_rows, n_kept, n_rows - n_kept AS n_removed FROM (SELECT (SELECT count(*) FROM orders) AS n_rows, "
        "count(*) AS n_kept FROM " + _iqr_sql("orders", "o_totalprice", 0.4) + ")"
    ),
)
def _outlier_counts(spark, d):
    return pr.outlier_counts(table(spark, d, "orders"), "o_totalprice", threshold=0.4)


@query(
    "drop_baseline",
    build("SELECT scenario, channel, round(contribution, 4) AS contribution FROM scenario_rows WHERE channel <> 'Baseline'", "scenario_rows"),
)
def _drop_baseline(spark, d):
    return rounded(bu.drop_baseline(scenario_rows(spark, d)).select("scenario", "channel", "contribution"), 4)


# ---- joins -----------------------------------------------------------------


@query("join_sales_spend", build("SELECT * FROM country_sales JOIN country_wide USING (Country, date)", "country_sales", "country_wide"))
def _join_sales_spend(spark, d):
    return pa.join_spend(country_sales(spark, d), country_wide(spark, d), ["Country"])


_EXT = ("consumer_confidence", "gdp_growth", "unemployment")


@query(
    "join_external",
    build(
        f"SELECT date, revenue, is_holiday, ext_is_holiday, is_promo_event, {rounds(_EXT, 8)} FROM "
        "(SELECT s.date, revenue, CASE WHEN month(s.date) = 12 THEN 1 ELSE 0 END AS is_holiday, "
        "e.is_holiday AS ext_is_holiday, is_promo_event, consumer_confidence, gdp_growth, unemployment "
        "FROM sales s LEFT JOIN external e ON s.date = e.date)",
        "sales", "external",
    ),
)
def _join_external(spark, d):
    own = sales(spark, d).select(
        "date", "revenue", F.when(F.month("date") == 12, 1).otherwise(0).alias("is_holiday")
    )
    return rounded(pa.join_external(own, external(spark, d)), 8, *_EXT)


# ---- aggregations ----------------------------------------------------------


@query("daily_sales", build("SELECT * FROM sales", "sales"))
def _daily_sales(spark, d):
    return sales(spark, d)


@query(
    "daily_sales_distinct",
    build(
        "SELECT InvoiceDate AS date, CAST(sum(TotalAmount) AS DOUBLE) AS revenue, "
        "count(DISTINCT InvoiceNo) AS transactions, count(DISTINCT CustomerID) AS unique_customers FROM retail GROUP BY 1",
        "retail",
    ),
)
def _daily_sales_distinct(spark, d):
    return pf.daily_sales(lines(spark, d, *SALES_COLUMNS), distinct=True)


def _by_sql(dim: str, name: str, customers: bool = True, quantity: bool = False) -> str:
    return (
        f"SELECT {dim} AS {name}, CAST(sum(TotalAmount) AS DOUBLE) AS revenue, "
        + ("CAST(sum(Quantity) AS BIGINT) AS quantity, " if quantity else "")
        + "count(DISTINCT InvoiceNo) AS transactions"
        + (", count(DISTINCT CustomerID) AS unique_customers" if customers else "")
        + f" FROM retail WHERE {dim} IS NOT NULL GROUP BY 1"
    )


_LEVELS = {
    "day": ("CAST(InvoiceDate AS VARCHAR)", "string(InvoiceDate)"),
    "month": ("strftime(InvoiceDate, '%Y-%m')", "date_format(InvoiceDate, 'yyyy-MM')"),
    "weekday": ("CAST((dayofweek(InvoiceDate) + 6) % 7 AS VARCHAR)", "string(weekday(InvoiceDate))"),
    "country": ("Country", "Country"),
}


@query(
    "sales_rollup",
    build(
        " UNION ALL ".join(
            f"SELECT '{level}' AS level, {key} AS key, CAST(sum(TotalAmount) AS DOUBLE) AS revenue, CAST(sum(Quantity) AS BIGINT) AS quantity, "
            f"count(DISTINCT InvoiceNo) AS transactions, count(DISTINCT CustomerID) AS unique_customers FROM retail GROUP BY 2"
            for level, (key, _) in _LEVELS.items()
        ),
        "retail",
    ),
)
def _sales_rollup(spark, d):
    """Four reports with distinct invoices and customers from one pass over the lines."""
    rows = lines(spark, d, "Country", "Quantity", *SALES_COLUMNS)
    cube = ru.cube(rows, ["InvoiceDate", "Country"], {"revenue": "TotalAmount", "quantity": "Quantity"}, {"transactions": "InvoiceNo", "unique_customers": "CustomerID"})
    reports = [cube.by(key=F.expr(key)).select(F.lit(level).alias("level"), "*") for level, (_, key) in _LEVELS.items()]
    return reduce(DataFrame.unionByName, reports)


@query("sales_by_country", build(_by_sql("Country", "Country"), "retail"))
def _sales_by_country(spark, d):
    return pf.sales_by_country(lines(spark, d, "Country", "InvoiceNo", "CustomerID", "TotalAmount"))


_WEEK_SQL = (
    "SELECT CAST(w.weekday AS INTEGER) AS weekday, {cols}, w.day_name FROM "
    "(VALUES " + ", ".join(f"({i}, '{n}')" for i, n in enumerate(WEEKDAYS)) + ") w(weekday, day_name) "
    "LEFT JOIN ({inner}) s ON w.weekday = s.weekday"
)


@query(
    "sales_by_weekday",
    build(_WEEK_SQL.format(cols="revenue, transactions", inner=_by_sql("((dayofweek(InvoiceDate) + 6) % 7)", "weekday", False)), "retail"),
)
def _sales_by_weekday(spark, d):
    return pf.sales_by_weekday(lines(spark, d, "InvoiceDate", "InvoiceNo", "TotalAmount"))


@query(
    "category_order",
    build(
        _WEEK_SQL.format(
            cols="n",
            inner="SELECT (dayofweek(InvoiceDate) + 6) % 7 AS weekday, count(*) AS n FROM retail "
            "WHERE dayofweek(InvoiceDate) BETWEEN 1 AND 5 GROUP BY 1",
        ),
        "retail",
    ),
)
def _category_order(spark, d):
    rows = lines(spark, d, "InvoiceDate").select(F.weekday("InvoiceDate").alias("weekday"))
    working = rows.filter(F.col("weekday") < 5).groupBy("weekday").agg(F.count("*").alias("n"))
    return pf.weekday_order(working)


@query("sales_by_month", build(_by_sql("strftime(InvoiceDate, '%Y-%m')", "month"), "retail"))
def _sales_by_month(spark, d):
    return pf.sales_by_month(lines(spark, d, *SALES_COLUMNS))


_PRODUCT_SQL = _by_sql("Description", "Description", False, True)
_COUNTRY_SQL = _by_sql("Country", "Country")


@query("sales_by_product", build(_PRODUCT_SQL, "retail"))
def _sales_by_product(spark, d):
    return pf.sales_by_product(lines(spark, d, "Description", "InvoiceNo", "Quantity", "TotalAmount"))


@query(
    "sales_by_hour",
    "SELECT CAST(hour(ts) AS INTEGER) AS hour, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS revenue, "
    "count(DISTINCT event_id) AS transactions FROM events GROUP BY 1",
)
def _sales_by_hour(spark, d):
    return pf.sales_by_hour(hourly_view(spark, d))


_CUSTOMER_SQL = (
    "SELECT CustomerID, count(DISTINCT InvoiceNo) AS num_transactions, CAST(sum(TotalAmount) AS DOUBLE) AS total_spend, "
    "min(InvoiceDate) AS first_purchase, max(InvoiceDate) AS last_purchase, "
    "CAST(date_diff('day', min(InvoiceDate), max(InvoiceDate)) AS INTEGER) AS days_between_purchases "
    "FROM retail WHERE CustomerID IS NOT NULL GROUP BY 1"
)


def _customers(spark, d) -> DataFrame:
    return pf.customer_frequency(lines(spark, d, "CustomerID", *[c for c in SALES_COLUMNS if c != "CustomerID"]))


@query("customer_frequency", build(_CUSTOMER_SQL, "retail"))
def _customer_frequency(spark, d):
    return _customers(spark, d)


def _histogram_sql(source: str, col: str, lo: int, hi: int, bins: int) -> str:
    width = number((hi - lo) / bins)
    return (
        f"SELECT b.bin, {number(lo)} + b.bin * {width} AS bin_start, {number(lo)} + (b.bin + 1) * {width} AS bin_end, "
        f"coalesce(n, 0) AS n FROM (SELECT CAST(range AS INTEGER) AS bin FROM range({bins})) b LEFT JOIN "
        f"(SELECT least(CAST(floor((greatest({number(lo)}, least({number(hi)}, CAST({col} AS DOUBLE))) - {number(lo)}) / {width}) AS INTEGER), "
        f"{bins - 1}) AS bin, count(*) AS n FROM {source} WHERE {col} IS NOT NULL GROUP BY 1) c ON b.bin = c.bin"
    )


@query("histogram", build(_histogram_sql("retail", "TotalAmount", 0, 1000, 50), "retail"))
def _histogram(spark, d):
    return pf.histogram(lines(spark, d, "TotalAmount"), "TotalAmount", 0, 1000, 50)


@query(
    "histogram_visits",
    build(_histogram_sql(f"({_CUSTOMER_SQL})", "num_transactions", 0, 20, 20), "retail"),
)
def _histogram_visits(spark, d):
    return pf.histogram(_customers(spark, d), "num_transactions", 0, 20, 20)


# Every column of the invoice lines; True where the bounds are text.
_DESCRIBED = {
    "InvoiceNo": True, "StockCode": False, "Description": True, "Quantity": False, "InvoiceDate": True,
    "UnitPrice": False, "CustomerID": False, "Country": True, "channel": True, "spend": False, "TotalAmount": False,
}


def _describe_sql(col: str, text: bool) -> str:
    if text:
        nothing = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in ("mean", "stddev", "min", "max"))
        return f"SELECT '{col}' AS \"column\", count({col}) AS count, {nothing}, CAST(min({col}) AS VARCHAR) AS min_text, CAST(max({col}) AS VARCHAR) AS max_text FROM retail"
    v = f"CAST({col} AS DOUBLE)"
    return (
        f"SELECT '{col}' AS \"column\", count({col}) AS count, round(avg({v}), 6) AS mean, round(stddev_samp({v}), 6) AS stddev, "
        f"min({v}) AS min, max({v}) AS max, CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text FROM retail"
    )


@query("describe", build(" UNION ALL ".join(_describe_sql(c, t) for c, t in _DESCRIBED.items()), "retail"))
def _describe(spark, d):
    return rounded(pf.describe_long(lines(spark, d, *_DESCRIBED)), 6, "mean", "stddev")


_NULLED = ("InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country")


@query(
    "null_counts",
    build(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM retail" for c in _NULLED), "retail"),
)
def _null_counts(spark, d):
    return pf.null_counts(retail_view(spark, d, _NULLED))


@query(
    "row_counts",
    build(
        "SELECT 'transactions' AS stage, count(*) AS n_rows, CAST(4 AS INTEGER) AS n_columns FROM retail "
        "UNION ALL SELECT 'daily_sales', count(*), 4 FROM sales UNION ALL SELECT 'spend', count(*), 3 FROM spend",
        "sales", "spend",
    ),
)
def _row_counts(spark, d):
    """The groups of the daily tables are counted from the lines, which are read once."""
    rows = lines(spark, d, "InvoiceDate", "channel")
    counts = pf.grain_counts(rows, {"daily_sales": ["InvoiceDate"], "spend": ["InvoiceDate", "channel"]}, "transactions")
    widths = {"transactions": 4, "daily_sales": 4, "spend": 3}
    stages = [F.struct(F.lit(n).alias("stage"), F.col(n).alias("n_rows"), F.lit(w).alias("n_columns")) for n, w in widths.items()]
    return counts.select(F.inline(F.array(*stages)))


@query(
    "row_counts_by_frame",
    build("SELECT 'daily_sales' AS stage, count(*) AS n_rows, CAST(4 AS INTEGER) AS n_columns FROM sales UNION ALL SELECT 'spend', count(*), 3 FROM spend", "sales", "spend"),
)
def _row_counts_by_frame(spark, d):
    return pf.row_counts({"daily_sales": sales(spark, d), "spend": spend_view(spark, d)})


@query("pivot_spend", build("SELECT * FROM wide", "wide"))
def _pivot_spend(spark, d):
    return wide(spark, d)


@query("distinct_dates", build("SELECT date FROM days", "days"))
def _distinct_dates(spark, d):
    return days(spark, d)


@query(
    "quartiles",
    "SELECT round(quantile_cont(o_totalprice, 0.25), 6) AS q1, round(median(o_totalprice), 6) AS median, "
    "round(quantile_cont(o_totalprice, 0.75), 6) AS q3 FROM orders",
)
def _quartiles(spark, d):
    return rounded(pf.quartiles(table(spark, d, "orders"), "o_totalprice"), 6)


@query(
    "quartiles_by_channel",
    build(
        "SELECT channel, round(quantile_cont(v, 0.25), 6) AS q1, round(median(v), 6) AS median, round(quantile_cont(v, 0.75), 6) AS q3 "
        "FROM (SELECT channel, CAST(TotalAmount AS DOUBLE) AS v FROM retail) GROUP BY 1",
        "retail",
    ),
)
def _quartiles_by_channel(spark, d):
    return rounded(pf.quartiles(stage(lines(spark, d, "channel", "TotalAmount")), "TotalAmount", ["channel"]), 6)


def _fill_sql(fill: str) -> str:
    return build(
        "SELECT Country, date, " + ", ".join(
            f"round(coalesce({c}, {fill.format(c=c)}), 6) AS {c}" for c in CHANNELS
        ) + " FROM country_wide",
        "country_wide",
    )


_MEAN_SQL = (
    "CAST(sum(CAST({c} AS DECIMAL(27,4))) OVER (PARTITION BY Country) AS DOUBLE) / count({c}) OVER (PARTITION BY Country)"
)


@query("fill_mean", _fill_sql(_MEAN_SQL))
def _fill_mean(spark, d):
    return rounded(pr.fill_missing(country_wide(spark, d, exact=True), "mean", CHANNELS, ["Country"], bounded=True), 6)


@query("fill_median", _fill_sql("median({c}) OVER (PARTITION BY Country)"))
def _fill_median(spark, d):
    return rounded(pr.fill_missing(country_wide(spark, d), "median", CHANNELS, ["Country"], bounded=True), 6)


_CORRELATED = ["revenue", *CHANNELS, *ADSTOCKS, *_EXT]


def _corr_sql(x: str, y: str) -> str:
    return f"CASE WHEN isnan(corr({x}, {y})) THEN NULL ELSE round(corr({x}, {y}), 8) END"


@query(
    "correlation_matrix",
    build(
        "SELECT a.name AS x, b.name AS y, CASE WHEN isnan(corr(a.v, b.v)) THEN NULL ELSE round(corr(a.v, b.v), 8) END AS corr "
        "FROM cells a JOIN cells b ON a.date = b.date GROUP BY 1, 2",
        "panel",
        cells=" UNION ALL ".join(f"SELECT date, '{c}' AS name, CAST({c} AS DOUBLE) AS v FROM panel" for c in _CORRELATED),
    ),
)
def _correlation_matrix(spark, d):
    return rounded(pf.correlation(panel(spark, d), _CORRELATED), 8)


@query(
    "target_correlation",
    build(
        " UNION ALL ".join(f"SELECT '{c}' AS feature, {_corr_sql(c, 'revenue')} AS corr FROM panel" for c in _CORRELATED),
        "panel",
    ),
)
def _target_correlation(spark, d):
    return rounded(pf.target_correlation(panel(spark, d), "revenue", _CORRELATED), 8).orderBy(
        F.desc_nulls_last("corr"), "feature"
    )


@query(
    "mean_contribution",
    build(f"SELECT channel, {rounds(['mean_contribution', 'share'], 6)} FROM shares", "shares"),
)
def _mean_contribution(spark, d):
    return rounded(at.mean_contribution(contributions(spark, d), CHANNELS), 6)


@query(
    "mean_contribution_clipped",
    build("SELECT channel, round(mean_contribution, 6) AS mean_contribution, round(greatest(0, share), 6) AS share FROM shares", "shares"),
)
def _mean_contribution_clipped(spark, d):
    return rounded(at.mean_contribution(contributions(spark, d), CHANNELS, clip=True), 6)


@query("median_roi", build("SELECT channel, round(roi, 8) AS roi FROM roi", "roi"))
def _median_roi(spark, d):
    return rounded(median_roi(spark, d), 8)


def _weekly_sql(keys: str) -> str:
    means = ", ".join(f"round(avg({p}), 6) AS {p}" for p in PARTS)
    return build(f"SELECT {keys}, min(date) AS date, {means} FROM contributions GROUP BY ALL", "contributions")


@query("weekly_contributions", _weekly_sql("CAST(year(date) AS INTEGER) AS year, CAST(week(date) AS INTEGER) AS week"))
def _weekly_contributions(spark, d):
    return rounded(at.weekly(contributions(spark, d), CHANNELS), 6)


@query("weekly_contributions_trunc", _weekly_sql("CAST(date_trunc('week', date) AS DATE) AS week_start"))
def _weekly_contributions_trunc(spark, d):
    return rounded(at.weekly(contributions(spark, d), CHANNELS, "trunc"), 6)


@query("total_budget", build("SELECT round(sum(budget), 6) AS total_budget FROM allocation", "allocation"))
def _total_budget(spark, d):
    return rounded(bu.total_budget(allocation(spark, d)), 6)


# ---- windows and carry-over ------------------------------------------------


@query(
    "lag_features",
    build(
        "SELECT date, channel, spend, " + ", ".join(f"lag(spend, {n}) OVER w AS spend_lag_{n}" for n in DEFAULT_LAGS)
        + " FROM spend WINDOW w AS (PARTITION BY channel ORDER BY date)",
        "spend",
    ),
)
def _lag_features(spark, d):
    return fe.lag_features(spend_view(spark, d), ["spend"], DEFAULT_LAGS, ["channel"])


def _rolling_sql(frame) -> str:
    parts = []
    for size in DEFAULT_WINDOWS:
        for fn, places in (("avg", 8), ("sum", 4), ("max", 4)):
            parts.append(
                f"round({fn}(spend) OVER (PARTITION BY channel ORDER BY date {frame(size)}), {places}) AS spend_{fn}_{size}d"
            )
    return build(f"SELECT date, channel, spend, {', '.join(parts)} FROM spend", "spend")


def _round_rolling(df: DataFrame) -> DataFrame:
    means = [c for c in df.columns if "_avg_" in c]
    sums = [c for c in df.columns if "_sum_" in c or "_max_" in c]
    return rounded(rounded(df, 8, *means), 4, *sums)


@query("rolling_features", _rolling_sql(lambda n: f"ROWS BETWEEN {n} PRECEDING AND CURRENT ROW"))
def _rolling_features(spark, d):
    return _round_rolling(fe.rolling_features(spend_view(spark, d), ["spend"], DEFAULT_WINDOWS, ["channel"]))


@query(
    "rolling_features_days",
    _rolling_sql(lambda n: f"RANGE BETWEEN INTERVAL {n - 1} DAYS PRECEDING AND CURRENT ROW"),
)
def _rolling_features_days(spark, d):
    return _round_rolling(fe.rolling_features(spend_view(spark, d), ["spend"], DEFAULT_WINDOWS, ["channel"], "days"))


@query(
    "interpolate",
    build(
        "SELECT Country, date, " + ", ".join(
            f"round(coalesce({c}, (last_value({c} IGNORE NULLS) OVER p + first_value({c} IGNORE NULLS) OVER f) / 2), 6) AS {c}"
            for c in CHANNELS
        ) + " FROM country_wide WINDOW p AS (PARTITION BY Country ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), "
        "f AS (PARTITION BY Country ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)",
        "country_wide",
    ),
)
def _interpolate(spark, d):
    return rounded(pr.fill_missing(country_wide(spark, d), "interpolate", CHANNELS, ["Country"]), 6)


# Exact decimals times short weights often end in 5, where engines round differently. Both
# sides add the same doubles in the same order, so these two are compared unrounded.
_LONG_WINDOW = "(PARTITION BY channel ORDER BY date)"


@query(
    "adstock_geometric",
    build(f"SELECT date, channel, {adstock_sql('spend', geometric_weights(), _LONG_WINDOW)} AS adstock FROM spend", "spend"),
)
def _adstock_geometric(spark, d):
    carried = adstock(spend_view(spark, d), "spend", geometric_weights(), ["channel"])
    return carried.select("date", "channel", "adstock")


@query(
    "adstock_weibull",
    build(f"SELECT date, channel, {adstock_sql('spend', weibull_weights(), _LONG_WINDOW)} AS adstock FROM spend", "spend"),
)
def _adstock_weibull(spark, d):
    carried = adstock(spend_view(spark, d), "spend", weibull_weights(), ["channel"])
    return carried.select("date", "channel", "adstock")


@query(
    "series_index",
    build(
        "SELECT Country, date, CAST(row_number() OVER (PARTITION BY Country ORDER BY date) - 1 AS INTEGER) AS series_index FROM country_sales",
        "country_sales",
    ),
)
def _series_index(spark, d):
    return fe.series_index(country_sales(spark, d).select("Country", "date"), ["Country"])


_MIXED = {
    "economy": {"adstock_type": "weibull", "max_lag": 20, "saturation_type": "exp", "k": 2.0, "S": 9000},
    "large": {"saturation_type": "logistic", "k": 0.0002, "S": 8000},
    "medium": {"saturation_type": "linear", "decay_rate": 0.4},
}


def _mixed_sql() -> str:
    w = "(PARTITION BY Country ORDER BY date)"
    economy = adstock_sql("economy", weibull_weights(max_lag=20), w)
    large = adstock_sql("large", geometric_weights(), w)
    medium = adstock_sql("medium", geometric_weights(0.4), w)
    promo = f"({adstock_sql('promo', geometric_weights(), w)})"
    return build(
        f"SELECT Country, date, round(1.0e0 - exp(-2.0e0 * ({economy}) / 9.0e3), 8) AS economy_adstock, "
        f"round(1.0e0 / (1.0e0 + exp(-2.0e-4 * (({large}) - 8.0e3))), 8) AS large_adstock, "
        f"round({medium}, 6) AS medium_adstock, round({hill_sql(promo, 0.5, 10000)}, 8) AS promo_adstock FROM country_wide",
        "country_wide",
    )


_EVENT_WEIGHTS = geometric_weights(0.6, 8)


@query(
    "carry_over_in_blocks",
    f"SELECT event_id, round({adstock_sql('value', _EVENT_WEIGHTS, 'w')}, 8) AS adstock, "
    "round(avg(value) OVER (ORDER BY ts, event_id ROWS 7 PRECEDING), 8) AS value_avg_7d FROM events WINDOW w AS (ORDER BY ts, event_id)",
)
def _carry_over_in_blocks(spark, d):
    """All events as one series, cut into blocks: carry-over and a rolling mean over rows."""

    def both(rows, ids):
        keyed = rows.withColumn("_order", F.struct("ts", "event_id"))
        carried = adstock(keyed, "value", _EVENT_WEIGHTS, ids, "_order")
        return fe.rolling_features(carried, ["value"], [7], ids, date_col="_order")

    events = table(spark, d, "events").select("event_id", "ts", "value")
    out = bl.in_blocks(events, both, 7, order=["ts", "event_id"], rows=5000, days=1)
    return rounded(out.select("event_id", "adstock", "value_avg_7d"), 8)


@query(
    "channel_transform_in_blocks",
    build(f"SELECT date, {rounds(ADSTOCKS, 8)} FROM panel", "panel"),
)
def _channel_transform_in_blocks(spark, d):
    daily = stage(pr.zero_fill(wide(spark, d), ["date"]))
    halo = max(len(channel_weights(p)) for p in PARAMS.values()) - 1
    out = bl.in_blocks(daily, lambda rows, ids: channel_transform(rows, CHANNELS, PARAMS, ids), halo, rows=200, days=100)
    return rounded(out.select("date", *ADSTOCKS), 8)


@query("channel_transform", _mixed_sql())
def _channel_transform(spark, d):
    out = channel_transform(country_wide(spark, d), list(_MIXED) + ["promo", "absent"], _MIXED, ["Country"])
    names = [f"{c}_adstock" for c in (*_MIXED, "promo")]
    return rounded(rounded(out.select("Country", "date", *names), 6, "medium_adstock"), 8, *[n for n in names if n != "medium_adstock"])


# ---- sort, limit, top-k ----------------------------------------------------


@query("order_by_date", build("SELECT * FROM sales ORDER BY date", "sales"))
def _order_by_date(spark, d):
    return sales(spark, d).orderBy("date")


@query("top_countries", build(f"SELECT * FROM ({_COUNTRY_SQL}) ORDER BY revenue DESC, Country LIMIT 10", "retail"))
def _top_countries(spark, d):
    return pf.top_k(QUERIES["sales_by_country"](spark, d), "revenue", 10, ["Country"])


@query("top_products", build(f"SELECT * FROM ({_PRODUCT_SQL}) ORDER BY revenue DESC, Description LIMIT 15", "retail"))
def _top_products(spark, d):
    return pf.top_k(QUERIES["sales_by_product"](spark, d), "revenue", 15, ["Description"])


@query("top_customers", build(f"SELECT * FROM ({_CUSTOMER_SQL}) ORDER BY total_spend DESC, CustomerID LIMIT 10", "retail"))
def _top_customers(spark, d):
    return pf.top_k(_customers(spark, d), "total_spend", 10, ["CustomerID"])


@query("top_features")
def _top_features(spark, d):
    scorer, _ = boosted(spark, d, IMPORTANCE_ROUNDS)
    return pf.top_k(mo.importance(spark, scorer), "importance", 20, ["feature"])


@query(
    "roi_extremes",
    build(
        "SELECT side, CAST(position AS INTEGER) AS position, channel, round(roi, 8) AS roi FROM ("
        "SELECT 'best' AS side, row_number() OVER (ORDER BY roi DESC NULLS LAST, channel) AS position, channel, roi FROM roi UNION ALL "
        "SELECT 'worst', row_number() OVER (ORDER BY roi ASC NULLS LAST, channel DESC), channel, roi FROM roi) WHERE position <= 3",
        "roi",
    ),
)
def _roi_extremes(spark, d):
    return rounded(at.roi_extremes(median_roi(spark, d)), 8)


@query("best_channel", build("SELECT channel, round(roi, 8) AS roi FROM roi ORDER BY roi DESC NULLS LAST, channel LIMIT 1", "roi"))
def _best_channel(spark, d):
    return rounded(at.best_channel(median_roi(spark, d)), 8)


# ---- set operations and reshape --------------------------------------------


@query(
    "union_channels",
    build(" UNION ALL ".join(f"SELECT date, '{c}' AS channel, {c} AS spend FROM wide" for c in CHANNELS), "wide"),
)
def _union_channels(spark, d):
    return wide(spark, d).unpivot(["date"], list(CHANNELS), "channel", "spend")


_SCENARIO_VALUES = ("budget", "budget_pct", "roi", "contribution")


@query("append_baseline", build(f"SELECT scenario, channel, {rounds(_SCENARIO_VALUES, 6)} FROM scenario_rows", "scenario_rows"))
def _append_baseline(spark, d):
    return rounded(scenario_rows(spark, d), 6)


@query("unpivot_contributions", build("SELECT date, channel, round(contribution, 6) AS contribution FROM long", "long"))
def _unpivot_contributions(spark, d):
    return rounded(at.long_form(contributions(spark, d), CHANNELS), 6)


# ---- calendar --------------------------------------------------------------

_CYCLIC = ("day_of_week_sin", "day_of_week_cos", "month_sin", "month_cos")
_SHORT_NAMES = ("day_of_week", "day_of_month", "month", "quarter", "year", "is_weekend")


@query(
    "seasonality_features",
    build(f"SELECT date, revenue, {', '.join(_SHORT_NAMES)}, {rounds(_CYCLIC, 8)} FROM (SELECT date, revenue, {SHORT_CALENDAR} FROM sales)", "sales"),
)
def _seasonality_features(spark, d):
    return rounded(fe.seasonality(sales(spark, d).select("date", "revenue")), 8, *_CYCLIC)


@query(
    "panel_calendar",
    build(f"SELECT date, revenue, day_of_week, month, is_weekend, {rounds(_CYCLIC, 8)} FROM (SELECT date, revenue, {FULL_CALENDAR} FROM sales)", "sales"),
)
def _panel_calendar(spark, d):
    return rounded(fe.panel_calendar(sales(spark, d).select("date", "revenue")), 8, *_CYCLIC)


@query(
    "holiday_features",
    build(
        "SELECT date, revenue, " + ", ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END AS {n}" for n, c in HOLIDAY_FLAGS)
        + f", CASE WHEN {' OR '.join(f'({c})' for _, c in HOLIDAY_FLAGS)} THEN 1 ELSE 0 END AS is_holiday FROM sales",
        "sales",
    ),
)
def _holiday_features(spark, d):
    return fe.holidays(sales(spark, d).select("date", "revenue"))


# The order dates end before the dated lists begin, so these two move the sales by whole years.
_SHIFTED = "(SELECT CAST(date + INTERVAL 12 YEARS AS DATE) AS date, revenue FROM sales)"


def _shifted_sales(spark, d) -> DataFrame:
    return sales(spark, d).select(F.add_months("date", 144).alias("date"), "revenue")


@query("holiday_calendar_dates", build(f"SELECT date, revenue, {dates_sql(UK_HOLIDAYS)} AS is_holiday FROM {_SHIFTED}", "sales"))
def _holiday_calendar_dates(spark, d):
    return fe.holiday_calendar(_shifted_sales(spark, d))


@query("promo_calendar", build(f"SELECT date, revenue, {dates_sql(PROMO_DAYS)} AS is_promo_event FROM {_SHIFTED}", "sales"))
def _promo_calendar(spark, d):
    return fe.promo_calendar(_shifted_sales(spark, d))


@query(
    "standardize",
    build(
        "SELECT Country, date, round((revenue - avg(revenue) OVER w) / nullif(stddev_samp(revenue) OVER w, 0), 8) AS revenue, "
        "round((transactions - avg(transactions) OVER w) / nullif(stddev_samp(transactions) OVER w, 0), 8) AS transactions "
        "FROM country_sales WINDOW w AS (PARTITION BY Country)",
        "country_sales",
    ),
)
def _standardize(spark, d):
    rows = country_sales(spark, d).select("Country", "date", "revenue", "transactions")
    return rounded(pr.standardize(rows, ["revenue", "transactions"], ["Country"], bounded=True), 8)


# ---- simulation ------------------------------------------------------------


@query("simulate_spend", build("SELECT date, channel, round(clean, 2) AS spend FROM simulated_spend", "simulated_spend"))
def _simulate_spend(spark, d):
    return si.simulate_spend(days(spark, d), MEDIA, noise=0)


_SPEND_DRAW = uniform_sql("concat_ws('|', date, channel)", SEED, "spend")


@query(
    "simulate_spend_noise",
    build(f"SELECT date, channel, round(clean * (9.0e-1 + 2.0e-1 * {_SPEND_DRAW}), 2) AS spend FROM simulated_spend", "simulated_spend"),
)
def _simulate_spend_noise(spark, d):
    return si.simulate_spend(days(spark, d), MEDIA, noise=0.1, seed=SEED)


@query("simulate_external", build(f"SELECT date, {rounds(_EXT, 8)}, is_holiday, is_promo_event FROM external", "external"))
def _simulate_external(spark, d):
    return rounded(si.simulate_external(days(spark, d), noise=0), 8, *_EXT)


def _normal_sql(tag: str) -> str:
    radius = uniform_sql("date", SEED, f"{tag}/r")
    angle = uniform_sql("date", SEED, f"{tag}/a")
    return f"sqrt(-2.0e0 * ln(1.0e0 - {radius})) * cos({number(2 * math.pi)} * {angle})"


@query(
    "simulate_external_noise",
    build(
        f"SELECT date, round(consumer_confidence + {_normal_sql('confidence')}, 8) AS consumer_confidence, "
        f"round(gdp_growth + 1.0e-1 * {_normal_sql('growth')}, 8) AS gdp_growth, "
        f"round(unemployment + 5.0e-2 * {_normal_sql('unemployment')}, 8) AS unemployment, is_holiday, is_promo_event FROM external",
        "external",
    ),
)
def _simulate_external_noise(spark, d):
    return rounded(si.simulate_external(days(spark, d), seed=SEED), 8, *_EXT)


def _demo_sql() -> str:
    def draw(tag: str) -> str:
        return uniform_sql("concat_ws('|', date, n)", SEED, tag)

    def pick(tag: str, values) -> str:
        listed = ", ".join(f"'{v}'" for v in values)
        return f"(ARRAY[{listed}])[CAST(floor({draw(tag)} * {len(values)}) AS INTEGER) + 1]"

    label = "strftime(date, '%Y%m%d') || '-' || n"
    price = f"(1.0e1 + 9.0e1 * {draw('price')})"
    quantity = f"CAST(1 + floor({draw('quantity')} * 9) AS INTEGER)"
    return build(
        f"SELECT date AS InvoiceDate, 'demo-' || {label} AS InvoiceNo, {pick('stock', si.DEMO_CODES)} AS StockCode, "
        f"'Item ' || {label} AS Description, {quantity} AS Quantity, round({price}, 8) AS UnitPrice, "
        f"CAST(10000 + floor({draw('customer')} * 89999) AS BIGINT) AS CustomerID, "
        f"{pick('country', si.DEMO_COUNTRIES)} AS Country, round({quantity} * {price}, 8) AS TotalPrice "
        "FROM days CROSS JOIN (VALUES (0), (1), (2)) AS t(n)",
        "days",
    )


@query("demo_transactions", _demo_sql())
def _demo_transactions(spark, d):
    return rounded(si.demo_transactions(days(spark, d), per_day=3, seed=SEED), 8)


# ---- saturation ------------------------------------------------------------


def _saturation(kind: str, sql: str) -> None:
    @query(f"saturate_{kind}", build(f"SELECT date, channel, round({sql}, 8) AS saturated FROM spend", "spend"))
    def _run(spark, d):
        rows = spend_view(spark, d)
        return rows.select("date", "channel", F.round(saturate(F.col("spend"), kind, 0.0005 if kind == "logistic" else 0.5), 8).alias("saturated"))


_saturation("hill", hill_sql("spend", 0.5, 10000))
_saturation("exp", "1.0e0 - exp(-5.0e-1 * spend / 1.0e4)")
_saturation("logistic", "1.0e0 / (1.0e0 + exp(-5.0e-4 * (spend - 1.0e4)))")
_saturation("none", "spend")


# ---- panel, model, attribution ---------------------------------------------

_PANEL_EXACT = ("revenue", "transactions", "unique_customers", *CHANNELS, "is_holiday", "is_promo_event", "day_of_week", "month", "is_weekend")


@query(
    "build_panel",
    build(f"SELECT date, {', '.join(_PANEL_EXACT)}, {rounds([*_EXT, *ADSTOCKS, *_CYCLIC], 8)} FROM panel", "panel"),
)
def _build_panel(spark, d):
    full = pa.build_panel(sales(spark, d), spend_view(spark, d), CHANNELS, PARAMS, external(spark, d))
    return rounded(full, 8, *_EXT, *ADSTOCKS, *_CYCLIC)


@query(
    "build_panel_one_pass",
    build(f"SELECT date, {', '.join(_PANEL_EXACT)}, {rounds([*_EXT, *ADSTOCKS, *_CYCLIC], 8)} FROM panel", "panel"),
)
def _build_panel_one_pass(spark, d):
    return rounded(panel(spark, d), 8, *_EXT, *ADSTOCKS, *_CYCLIC)


@query(
    "build_panel_bucketed",
    build(f"SELECT date, {', '.join(_PANEL_EXACT)}, {rounds([*_EXT, *ADSTOCKS, *_CYCLIC], 8)} FROM panel", "panel"),
)
def _build_panel_bucketed(spark, d):
    """Over lines and orders laid out by order key, which meet without an exchange."""
    base = panel_base(spark, d, order_layout(spark, d, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return rounded(panel_of(base), 8, *_EXT, *ADSTOCKS, *_CYCLIC)


_FEATURES = [c for c in (*_PANEL_EXACT, *_EXT, *ADSTOCKS, *_CYCLIC) if c != "revenue"]


@query(
    "assemble_features",
    build(
        f"SELECT date, revenue, CAST({len(_FEATURES)} AS INTEGER) AS n_features, round({total(_FEATURES)}, 4) AS feature_sum FROM panel",
        "panel",
    ),
)
def _assemble_features(spark, d):
    vectors = mo.assemble(panel(spark, d)).withColumn("values", vector_to_array("features"))
    summed = F.aggregate("values", F.lit(0.0), lambda acc, v: acc + v)
    return vectors.select(
        "date", "revenue", F.size("values").alias("n_features"), F.round(summed, 4).alias("feature_sum")
    )


@query("train_gbt")
def _train_gbt(spark, d):
    scorer, data = boosted(spark, d)
    return mo.evaluate(pa.time_part(scorer.predict(data), TRAIN_END), by=["part"])


@query(
    "train_linear",
    build(
        " UNION ALL ".join(
            f"SELECT '{a}' AS feature, round(regr_slope(revenue, {a}), 3) AS slope, "
            f"round(regr_intercept(revenue, {a}), 3) AS intercept, round(regr_r2(revenue, {a}), 8) AS r2 FROM panel"
            for a in ADSTOCKS
        ),
        "panel",
    ),
)
def _train_linear(spark, d):
    # Slopes reach 1e7 on nearly saturated channels, so three places are eleven digits.
    fits = mo.simple_linear(panel(spark, d), ADSTOCKS)
    return rounded(rounded(fits, 3, "slope", "intercept"), 8, "r2")


_FIT_SPLIT = {"train_rows": f"SELECT * FROM panel WHERE date <= DATE '{TRAIN_END}'"}
_FIT_STEPS = _FIT_SPLIT | least_squares("fit", "train_rows", ADSTOCKS)


def fitted(spark, d, features=ADSTOCKS):
    """Least squares on the features over the training days, and the staged panel."""
    data = stage(panel(spark, d))
    train, _ = pa.time_split(data, TRAIN_END)
    return mo.train_linear(train, features), data


def fitted_allocation(spark, d, channels) -> DataFrame:
    """From lines through a fitted model to the budget of the channels."""
    scorer, data = fitted(spark, d, [f"{c}_adstock" for c in channels])
    roi = at.median_roi(at.contributions(data, scorer, channels), channels, bounded=True)
    return bu.allocate_budget(roi, TOTAL, MIN_PCT, MAX_PCT)


@query(
    "train_linear_fit",
    build(
        "SELECT 'intercept' AS feature, round(b0, 2) AS coefficient FROM fit"
        + "".join(f" UNION ALL SELECT '{f}', round(b{i + 1}, 2) FROM fit" for i, f in enumerate(ADSTOCKS)),
        "panel",
        **_FIT_STEPS,
    ),
)
def _train_linear_fit(spark, d):
    scorer, _ = fitted(spark, d)
    rows = [("intercept", scorer.intercept), *scorer.coefs.items()]
    return rounded(spark.createDataFrame(rows, "feature string, coefficient double"), 2)


_SCORE_STEP = {
    "scores": f"SELECT p.*, {fitted_value(ADSTOCKS)} AS prediction, "
    + ", ".join(f"b{i + 1} * {c}_adstock AS {c}_effect" for i, c in enumerate(CHANNELS))
    + " FROM panel p, fit"
}


@query(
    "evaluate_fitted",
    build(
        "SELECT round(sqrt(avg((revenue - prediction) * (revenue - prediction))), 3) AS rmse, "
        f"round(avg(abs(revenue - prediction)), 3) AS mae FROM scores WHERE date > DATE '{TRAIN_END}'",
        "panel",
        **_FIT_STEPS,
        **_SCORE_STEP,
    ),
)
def _evaluate_fitted(spark, d):
    scorer, data = fitted(spark, d)
    _, test = pa.time_split(data, TRAIN_END)
    return rounded(mo.evaluate(scorer.predict(test)).select("rmse", "mae"), 3)


@query(
    "contributions_fitted",
    build(
        "SELECT date, round(prediction, 2) AS predicted_revenue, "
        + ", ".join(f"round({c}_effect, 2) AS {c}_contribution" for c in CHANNELS)
        + f", round(prediction - ({total(f'{c}_effect' for c in CHANNELS)}), 2) AS baseline_contribution FROM scores",
        "panel",
        **_FIT_STEPS,
        **_SCORE_STEP,
    ),
)
def _contributions_fitted(spark, d):
    scorer, data = fitted(spark, d)
    scored = at.contributions(data, scorer, CHANNELS)
    return rounded(scored.select("date", "predicted_revenue", *PARTS), 2)


def _fitted_roi_sql() -> str:
    """The allocation's SQL with the ROI of the fitted model in place of the fixed one."""
    steps = ", ".join(f"{name} AS ({sql})" for name, sql in (_FIT_STEPS | _SCORE_STEP).items())
    roi = " UNION ALL ".join(f"SELECT '{c}' AS channel, median({c}_effect / nullif({c}, 0)) AS roi FROM scores" for c in CHANNELS)
    whole = build(f"SELECT channel, {rounds(('budget', 'budget_pct'), 2)}, round(roi, 6) AS roi FROM allocation", "allocation")
    assert STEPS["roi"][1] in whole
    return whole.replace(STEPS["roi"][1], f"WITH {steps} {roi}")


@query("allocate_budget_fitted", _fitted_roi_sql())
def _allocate_budget_fitted(spark, d):
    return rounded(rounded(fitted_allocation(spark, d, CHANNELS), 2, "budget", "budget_pct"), 6, "roi")


_ALL_INPUTS = ["transactions", *ADSTOCKS, *_EXT, *_CYCLIC]


def _metrics_sql(rows: str, by: str = "") -> str:
    """rmse, mae, r2 and mape of (revenue, prediction) rows, per group if one is named."""
    error = "(revenue - prediction)"
    return (
        f"SELECT {by + ', ' if by else ''}round(sqrt(avg({error} * {error})), 3) AS rmse, round(avg(abs({error})), 3) AS mae, "
        f"round(1 - sum({error} * {error}) / nullif(var_pop(revenue) * count(*), 0), 6) AS r2, "
        f"round(avg(abs({error} / nullif(revenue + 1, 0))) * 100, 6) AS mape FROM {rows}" + (f" GROUP BY {by}" if by else "")
    )


def _round_metrics(df: DataFrame) -> DataFrame:
    return rounded(rounded(df, 3, "rmse", "mae"), 6, "r2", "mape")


@query(
    "train_linear_all_features",
    build(
        _metrics_sql(f"(SELECT revenue, {fitted_value(_ALL_INPUTS)} AS prediction FROM panel, fit WHERE date > DATE '{TRAIN_END}')"),
        "panel",
        **_FIT_SPLIT,
        **least_squares("fit", "train_rows", _ALL_INPUTS),
    ),
)
def _train_linear_all(spark, d):
    data = stage(panel(spark, d))
    train, test = pa.time_split(data, TRAIN_END)
    return _round_metrics(mo.evaluate(mo.train_linear(train, _ALL_INPUTS).predict(test)))


# One entity is a country and a part type.
_ENTITY = ["Country", "channel"]
_ENTITY_INPUTS = ["spend_adstock", "transactions", "is_weekend"]


def entities(spark, d) -> DataFrame:
    """Daily revenue, transactions, carried-over spend and weekend flag of every (Country, channel)."""
    rows = lines(spark, d, *_ENTITY, "InvoiceDate", "InvoiceNo", "TotalAmount", "spend")
    daily = rows.groupBy(*_ENTITY, F.col("InvoiceDate").alias("date")).agg(
        F.sum("TotalAmount").cast("double").alias("revenue"), F.count("InvoiceNo").alias("transactions"), F.sum("spend").cast("double").alias("spend")
    )
    return fe.panel_calendar(adstock(daily, "spend", geometric_weights(0.5, 5), _ENTITY, name="spend_adstock"))


@query(
    "train_linear_by",
    build(
        "SELECT Country, channel, n, round(b0, 2) AS intercept, "
        + ", ".join(f"round(b{i + 1}, 4) AS {c}_slope" for i, c in enumerate(_ENTITY_INPUTS))
        + " FROM fit",
        "entities",
        **least_squares("fit", "entities", _ENTITY_INPUTS, by=_ENTITY),
    ),
)
def _train_linear_by(spark, d):
    fits = gr.train_linear_by(entities(spark, d), _ENTITY_INPUTS, _ENTITY)
    slopes = [F.round(F.get("slopes", F.lit(i)), 4).alias(f"{c}_slope") for i, c in enumerate(_ENTITY_INPUTS)]
    return fits.select(*_ENTITY, "n", F.round("intercept", 2).alias("intercept"), *slopes)


def _folds_sql(rows: str, k: int, by: str = "") -> dict[str, str]:
    """``tested``: the rows with their fold; ``train_rows``: those before each fold, under its number."""
    over = f"PARTITION BY {by}" if by else ""
    keys = f"{by}, date" if by else "date"
    ranked = (
        f"SELECT {keys}, row_number() OVER ({over} ORDER BY date) - 1 AS r, count(*) OVER ({over}) AS n, count(*) OVER ({over}) // {k + 1} AS m "
        f"FROM (SELECT DISTINCT {keys} FROM {rows})"
    )
    fold = f"CASE WHEN m > 0 AND r >= n - {k} * m THEN CAST(floor((r - (n - {k} * m)) / m) AS INTEGER) ELSE -1 END"
    return {
        "folds": f"SELECT {keys}, {fold} AS fold FROM ({ranked})",
        "tested": f"SELECT p.*, f.fold FROM {rows} p JOIN folds f USING ({keys})",
        "train_rows": f"SELECT t.* EXCLUDE (fold), CAST(g.fold AS INTEGER) AS fold FROM tested t JOIN range(0, {k}) g(fold) ON t.fold < g.fold",
    }


@query(
    "cross_validate_by",
    build(
        "SELECT t.Country, t.channel, t.fold, any_value(f.n) AS n_train, count(*) AS n, "
        f"round(sqrt(avg(power(revenue - ({fitted_value(_ENTITY_INPUTS)}), 2))), 3) AS rmse, "
        f"round(1 - sum(power(revenue - ({fitted_value(_ENTITY_INPUTS)}), 2)) / nullif(var_pop(revenue) * count(*), 0), 6) AS r2 "
        "FROM tested t JOIN fit f USING (Country, channel, fold) GROUP BY t.Country, t.channel, t.fold",
        "entities",
        **_folds_sql("entities", 3, "Country, channel"),
        **least_squares("fit", "train_rows", _ENTITY_INPUTS, by=[*_ENTITY, "fold"]),
    ),
)
def _cross_validate_by(spark, d):
    rows = pa.fold_rows(stage(entities(spark, d)), 3, _ENTITY)
    return rounded(rounded(gr.cross_validate_by(rows, _ENTITY_INPUTS, _ENTITY), 3, "rmse"), 6, "r2")


@query("feature_importance")
def _feature_importance(spark, d):
    scorer, _ = boosted(spark, d, IMPORTANCE_ROUNDS)
    return mo.importance(spark, scorer)


def leafwise(spark, d, rounds: int = BOOSTING_ROUNDS):
    """Best-first trees fitted on the days before the split, and the panel they belong to."""
    data = stage(panel(spark, d))
    train, _ = pa.time_split(data, TRAIN_END)
    return lw.train_leafwise(train, features_of(data), how=lw.Boosting(rounds=rounds, seed=SEED)), data


@query("train_leafwise")
def _train_leafwise(spark, d):
    scorer, data = leafwise(spark, d)
    return mo.evaluate(pa.time_part(scorer.predict(data), TRAIN_END), by=["part"])


@query("gain_importance")
def _gain_importance(spark, d):
    scorer, _ = leafwise(spark, d, IMPORTANCE_ROUNDS)
    return lw.gain_importance(scorer)


@query("top_features_gain")
def _top_features_gain(spark, d):
    return pf.top_k(_gain_importance(spark, d), "importance", 20, ["feature"])


@query("contributions_leafwise")
def _contributions_leafwise(spark, d):
    scorer, data = leafwise(spark, d)
    return at.contributions(data, scorer, CHANNELS)


@query("train_leafwise_by")
def _train_leafwise_by(spark, d):
    rows = stage(entities(spark, d))
    train, _ = pa.time_split(rows, TRAIN_END)
    scorer = lw.train_leafwise(train, _ENTITY_INPUTS, id_cols=_ENTITY, how=lw.Boosting(rounds=IMPORTANCE_ROUNDS, seed=SEED))
    scored = scorer.predict(rows).filter(F.col("prediction").isNotNull())
    return mo.evaluate(pa.time_part(scored, TRAIN_END), by=[*_ENTITY, "part"])


# The first split of the first tree: every threshold of every feature, by running sums.
_LEAST, _STEP = 20, 0.05
_SPLIT_STEPS = {
    "centred": "SELECT *, revenue - avg(revenue) OVER w AS r, count(*) OVER w AS n FROM entities WINDOW w AS (PARTITION BY Country, channel)",
    "tall": " UNION ALL ".join(
        f"SELECT Country, channel, n, {i} AS place, '{c}' AS feature, CAST({c} AS DOUBLE) AS v, r FROM centred" for i, c in enumerate(_ENTITY_INPUTS)
    ),
    "sums": "SELECT Country, channel, n, place, feature, v, sum(r) AS s, count(*) AS c FROM tall GROUP BY ALL",
    "running": "SELECT *, sum(s) OVER w AS ls, sum(c) OVER w AS lc, sum(s) OVER e AS ts, lead(v) OVER w AS following FROM sums "
    "WINDOW w AS (PARTITION BY Country, channel, place ORDER BY v), e AS (PARTITION BY Country, channel, place)",
    "cuts": "SELECT *, ls * ls / lc + (ts - ls) * (ts - ls) / (n - lc) - ts * ts / n AS gain FROM running "
    f"WHERE following IS NOT NULL AND lc >= {_LEAST} AND n - lc >= {_LEAST}",
    "best": "SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY Country, channel ORDER BY gain DESC, place, v) = 1",
}


@query(
    "leafwise_first_split",
    build(
        "SELECT Country, channel, n, CAST(lc AS BIGINT) AS left_rows, feature, round((v + following) / 2, 4) AS threshold, round(gain, 0) AS gain, "
        f"round({_STEP} * ls / lc, 3) AS left_value, round({_STEP} * (ts - ls) / (n - lc), 3) AS right_value FROM best",
        "entities",
        **_SPLIT_STEPS,
    ),
)
def _leafwise_first_split(spark, d):
    how = lw.Boosting(rounds=1, leaves=2, step=_STEP, feature_part=1.0, row_part=1.0, least_rows=_LEAST, bins=1_000_000)
    nodes = lw.train_leafwise(entities(spark, d), _ENTITY_INPUTS, id_cols=_ENTITY, how=how).trees.filter("tree = 1")
    of = [F.max(F.when(F.col("node") == node, F.col(c))).alias(name) for node, c, name in (
        (0, "rows", "n"), (1, "rows", "left_rows"), (0, "feature", "feature"), (0, "threshold", "threshold"),
        (0, "gain", "gain"), (1, "value", "left_value"), (2, "value", "right_value"),
    )]
    split = nodes.groupBy(*_ENTITY).agg(*of).filter("feature IS NOT NULL")
    return rounded(rounded(rounded(split, 4, "threshold"), 0, "gain"), 3, "left_value", "right_value")


@query("predict", build("SELECT date, revenue, round(predicted_revenue, 4) AS prediction FROM scored", "scored"))
def _predict(spark, d):
    return rounded(SCORER.predict(panel(spark, d)).select("date", "revenue", "prediction"), 4, "prediction")


@query("evaluate", build(f"SELECT {rounds(_METRICS, 6)} FROM (SELECT {_METRIC_SQL} FROM scored)", "scored"))
def _evaluate(spark, d):
    return rounded(_metrics(spark, d), 6)


@query(
    "random_split",
    build(f"SELECT date, revenue, CASE WHEN {uniform_sql('date', SEED, 'split')} < 8.0e-1 THEN 'train' ELSE 'test' END AS part FROM sales", "sales"),
)
def _random_split(spark, d):
    return pa.random_part(sales(spark, d).select("date", "revenue"), ["date"], 0.8, SEED)


_CONTRIB = ["predicted_revenue", *PARTS]
_PCTS = [f"{p}_pct" for p in PARTS]
_ROIS = [f"{c}_roi" for c in CHANNELS]


@query(
    "channel_contributions",
    build(f"SELECT date, actual_revenue, {rounds(_CONTRIB, 4)}, {rounds([*_ROIS, *_PCTS], 8)} FROM contributions", "contributions"),
)
def _channel_contributions(spark, d):
    return rounded(rounded(contributions(spark, d), 4, *_CONTRIB), 8, *_ROIS, *_PCTS)


@query("channel_contributions_gbt")
def _channel_contributions_gbt(spark, d):
    scorer, data = boosted(spark, d)
    return at.contributions(data, scorer, CHANNELS)


@query("channel_roi", build(f"SELECT date, {rounds(_ROIS, 8)} FROM contributions", "contributions"))
def _channel_roi(spark, d):
    return rounded(contributions(spark, d).select("date", *_ROIS), 8)


@query("baseline_contribution", build("SELECT date, round(baseline_contribution, 4) AS baseline_contribution FROM contributions", "contributions"))
def _baseline_contribution(spark, d):
    return rounded(contributions(spark, d).select("date", "baseline_contribution"), 4)


@query("contribution_pct", build(f"SELECT date, {rounds(_PCTS, 8)} FROM contributions", "contributions"))
def _contribution_pct(spark, d):
    return rounded(contributions(spark, d).select("date", *_PCTS), 8)


@query("actual_vs_predicted", build("SELECT date, revenue AS actual, round(predicted_revenue, 4) AS predicted FROM scored ORDER BY date", "scored"))
def _actual_vs_predicted(spark, d):
    return rounded(at.actual_vs_predicted(panel(spark, d), SCORER), 4, "predicted").orderBy("date")


@query("time_folds_by", build("SELECT * FROM folds", "country_sales", **{"folds": _folds_sql("country_sales", 4, "Country")["folds"]}))
def _time_folds_by(spark, d):
    return pa.time_folds(country_sales(spark, d).select("Country", "date"), 4, ["Country"])


@query(
    "time_folds",
    build(
        "SELECT date, CASE WHEN r >= n - 3 * m THEN CAST(floor((r - (n - 3 * m)) / m) AS INTEGER) ELSE -1 END AS fold FROM "
        "(SELECT date, row_number() OVER (ORDER BY date) - 1 AS r, count(*) OVER () AS n, count(*) OVER () // 4 AS m FROM days)",
        "days",
    ),
)
def _time_folds(spark, d):
    return pa.time_folds(days(spark, d), 3)


_CV_INPUTS = ["transactions", *ADSTOCKS]


@query(
    "cross_validate",
    build(
        _metrics_sql(f"(SELECT fold, revenue, {fitted_value(_CV_INPUTS)} AS prediction FROM tested JOIN fit USING (fold))", "fold"),
        "panel",
        **_folds_sql("panel", 3),
        **least_squares("fit", "train_rows", _CV_INPUTS, by=["fold"]),
    ),
)
def _cross_validate(spark, d):
    return _round_metrics(mo.cross_validate(panel(spark, d), _CV_INPUTS, k=3))


def _search_sql() -> str:
    series = " UNION ALL ".join(
        f"SELECT '{c}' AS channel, {number(decay)} AS decay_rate, revenue AS y, "
        f"{adstock_sql(c, geometric_weights(decay, 10), 'w')} AS x FROM joined WINDOW w AS (ORDER BY date)"
        for c in CHANNELS
        for decay in GRID["decay_rate"]
    )
    curves = ", ".join(f"({number(k)}, {number(s)})" for k in GRID["k"] for s in GRID["S"])
    return build(
        f"SELECT channel, decay_rate, k, S, round(r2, 8) AS r2 FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY channel ORDER BY r2 DESC, decay_rate, k, S) AS rn FROM (SELECT channel, decay_rate, k, S, "
        f"power(corr(power(x, k) / (power(x, k) + power(S, k)), y), 2) AS r2 FROM ({series}) "
        f"CROSS JOIN (VALUES {curves}) g(k, S) GROUP BY ALL) WHERE NOT isnan(r2)) WHERE rn = 1",
        "joined",
    )


@query("param_search", _search_sql())
def _param_search(spark, d):
    return rounded(mo.param_search(panel(spark, d), CHANNELS, GRID), 8, "r2")


# ---- budget and scenarios --------------------------------------------------

_BUDGET = f"SELECT channel, {rounds(['budget', 'budget_pct'], 6)}, round(roi, 8) AS roi FROM allocation"


def _round_budget(df: DataFrame) -> DataFrame:
    return rounded(rounded(df, 6, "budget", "budget_pct"), 8, "roi")


@query("allocate_budget", build(_BUDGET, "allocation"))
def _allocate_budget(spark, d):
    return _round_budget(allocation(spark, d))


def _conserving_sql() -> str:
    low, high, all_ = (number(v) for v in (TOTAL * MIN_PCT, TOTAL * MAX_PCT, TOTAL))
    room = number(TOTAL * MAX_PCT - TOTAL * MIN_PCT)
    return build(
        f"""SELECT channel, round(budget, 6) AS budget, round(budget / {all_} * 100, 6) AS budget_pct, round(roi, 8) AS roi FROM (
SELECT channel, roi, CASE WHEN rest <= 0 THEN {low} WHEN cap THEN {high}
  WHEN roi > 0 THEN {low} + (rest - m * {room}) * roi / open
  ELSE {low} + (CASE WHEN p = m THEN rest - p * {room} ELSE 0 END) / (n - p) END AS budget FROM (
SELECT *, count(*) FILTER (cap) OVER () AS m, sum(CASE WHEN NOT cap THEN v ELSE 0 END) OVER () AS open FROM (
SELECT *, roi > 0 AND (rest - (i - 1) * {room}) * v / tail > {room} AS cap FROM (
SELECT *, {all_} - n * {low} AS rest FROM (
SELECT channel, roi, CASE WHEN roi > 0 THEN roi ELSE 0 END AS v, row_number() OVER w AS i, count(*) OVER () AS n,
  count(*) FILTER (roi > 0) OVER () AS p,
  sum(CASE WHEN roi > 0 THEN roi ELSE 0 END) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS tail
FROM roi WINDOW w AS (ORDER BY roi DESC NULLS LAST, channel))))))""",
        "roi",
    )


@query("allocate_budget_conserving", _conserving_sql())
def _allocate_budget_conserving(spark, d):
    return _round_budget(bu.allocate_budget_conserving(median_roi(spark, d), TOTAL, MIN_PCT, MAX_PCT))


@query("simulate_scenarios", build(f"SELECT scenario, channel, {rounds(_SCENARIO_VALUES, 6)} FROM simulated", "simulated"))
def _simulate_scenarios(spark, d):
    return rounded(simulated(spark, d)[0], 6)


@query("scenario_table", build(f"SELECT scenario, channel, {rounds(_SCENARIO_VALUES, 6)} FROM scenario_rows", "scenario_rows"))
def _scenario_table(spark, d):
    return rounded(scenario_rows(spark, d), 6)


_COMPARED = ("total_budget", "marketing", "total_sales", "overall_roi")


@query(
    "compare_scenarios",
    build(
        f"SELECT scenario, {rounds(_COMPARED, 6)} FROM (SELECT scenario, sum(budget) AS total_budget, "
        "sum(CASE WHEN channel <> 'Baseline' THEN contribution ELSE 0 END) AS marketing, sum(contribution) AS total_sales, "
        "CASE WHEN sum(budget) > 0 THEN sum(CASE WHEN channel <> 'Baseline' THEN contribution ELSE 0 END) / sum(budget) ELSE 0 END AS overall_roi "
        "FROM scenario_rows GROUP BY 1)",
        "scenario_rows",
    ),
)
def _compare_scenarios(spark, d):
    return rounded(bu.compare_scenarios(scenario_rows(spark, d)), 6)


_LISTED = (*CHANNELS, "outdoor")


@query(
    "default_allocation",
    build(
        f"SELECT c.channel, round(coalesce(budget_pct, {number(100 / len(_LISTED))}), 6) AS allocation_pct FROM (VALUES "
        + ", ".join(f"('{c}')" for c in _LISTED) + ") c(channel) LEFT JOIN allocation a ON c.channel = a.channel",
        "allocation",
    ),
)
def _default_allocation(spark, d):
    return rounded(bu.default_allocation(allocation(spark, d), _LISTED), 6)


# ---- reports ---------------------------------------------------------------


@query(
    "report_metrics",
    build(f"SELECT round(r2, 4) AS r2, {rounds(['rmse', 'mae', 'mape'], 2)} FROM (SELECT {_METRIC_SQL} FROM scored)", "scored"),
)
def _report_metrics(spark, d):
    return rp.report_metrics(_metrics(spark, d))


@query("report_contributions", build(f"SELECT channel, {rounds(['mean_contribution', 'share'], 6)} FROM shares", "shares"))
def _report_contributions(spark, d):
    return rounded(rp.report_contributions(contributions(spark, d), CHANNELS), 6)


@query("report_roi", build("SELECT channel, round(roi, 8) AS roi FROM roi", "roi"))
def _report_roi(spark, d):
    return rounded(rp.report_roi(contributions(spark, d), CHANNELS), 8)


@query("report_budget", build(_BUDGET, "allocation"))
def _report_budget(spark, d):
    return _round_budget(rp.report_budget(allocation(spark, d)))


@query("report_top_features")
def _report_top_features(spark, d):
    scorer, _ = boosted(spark, d, IMPORTANCE_ROUNDS)
    return rp.report_top_features(mo.importance(spark, scorer))


@query("report_top_features_gain")
def _report_top_features_gain(spark, d):
    return rp.report_top_features(_gain_importance(spark, d))


@query(
    "report_findings",
    build(
        "SELECT (SELECT string_agg(channel, ', ' ORDER BY roi DESC, channel) FROM (SELECT * FROM roi ORDER BY roi DESC, channel LIMIT 3)) AS best, "
        "(SELECT string_agg(channel, ', ' ORDER BY roi DESC, channel) FROM (SELECT * FROM roi ORDER BY roi, channel DESC LIMIT 3)) AS worst, "
        "(SELECT round(share, 6) FROM shares WHERE channel = 'baseline') AS baseline_share",
        "roi", "shares",
    ),
)
def _report_findings(spark, d):
    return rounded(rp.report_findings(stage(contributions(spark, d)), CHANNELS), 6)


@query("contributions_over_time", build("SELECT date, channel, round(contribution, 6) AS contribution FROM long", "long"))
def _contributions_over_time(spark, d):
    return rounded(rp.contributions_over_time(contributions(spark, d), CHANNELS), 6)


@query(
    "contribution_composition",
    build("SELECT date, " + ", ".join(f"round({p}_contribution, 6) AS {p}" for p in ("baseline", *CHANNELS)) + " FROM contributions", "contributions"),
)
def _contribution_composition(spark, d):
    return rounded(rp.contribution_composition(contributions(spark, d), CHANNELS), 6)
