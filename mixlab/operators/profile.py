"""Daily sales, breakdowns and column profiles of the transactions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from mixlab.functions.calendar import WEEKDAYS
from mixlab.functions.stats import correlation_of
from mixlab.operators.prep import clipped
from mixlab.operators.quantiles import quantile_columns


def _money(col: str) -> Column:
    return F.sum(col).cast("double")


def daily_sales(
    df: DataFrame, distinct: bool = False, id_cols: Sequence[str] = (), approx: bool = False
) -> DataFrame:
    """(ids, date, revenue, transactions, unique_customers).

    By default both counts are plain: lines, and lines with a customer. With
    ``distinct`` they count invoices and customers once (``approx``: by sketch).
    """
    if distinct:
        counter = F.approx_count_distinct if approx else F.count_distinct
        transactions, customers = counter("InvoiceNo"), counter("CustomerID")
    else:
        transactions, customers = F.count("InvoiceNo"), F.count("CustomerID")
    return df.groupBy(*id_cols, F.col("InvoiceDate").alias("date")).agg(
        _money("TotalAmount").alias("revenue"),
        transactions.alias("transactions"),
        customers.alias("unique_customers"),
    )


def sales_by(df: DataFrame, dim: Column | str, name: str, customers: bool = True, quantity: bool = False) -> DataFrame:
    """Revenue and distinct invoices (and customers, quantity) per value of ``dim``; NULL is no group."""
    dim = F.col(dim) if isinstance(dim, str) else dim
    measures = [_money("TotalAmount").alias("revenue")]
    if quantity:
        measures.append(F.sum("Quantity").alias("quantity"))
    measures.append(F.count_distinct("InvoiceNo").alias("transactions"))
    if customers:
        measures.append(F.count_distinct("CustomerID").alias("unique_customers"))
    return df.filter(dim.isNotNull()).groupBy(dim.alias(name)).agg(*measures)


def sales_by_country(df: DataFrame) -> DataFrame:
    return sales_by(df, "Country", "Country")


def sales_by_month(df: DataFrame) -> DataFrame:
    return sales_by(df, F.date_format("InvoiceDate", "yyyy-MM"), "month")


def sales_by_product(df: DataFrame) -> DataFrame:
    return sales_by(df, "Description", "Description", customers=False, quantity=True)


def sales_by_hour(df: DataFrame) -> DataFrame:
    return sales_by(df, F.hour("InvoiceTs"), "hour", customers=False)


def weekday_order(df: DataFrame, number: str = "weekday") -> DataFrame:
    """All seven weekdays with their names, Monday first; days without rows keep NULLs."""
    spark = df.sparkSession
    names = F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), F.col(number) + 1)
    week = spark.range(7).select(F.col("id").cast("int").alias(number))
    return week.join(df, number, "left").withColumn("day_name", names)


def sales_by_weekday(df: DataFrame) -> DataFrame:
    """Revenue and distinct invoices per weekday (0 = Monday), all seven present."""
    return weekday_order(sales_by(df, F.weekday("InvoiceDate"), "weekday", customers=False))


def customer_frequency(df: DataFrame) -> DataFrame:
    """Per customer: distinct invoices, spend, first and last purchase, days between them."""
    return (
        df.filter(F.col("CustomerID").isNotNull())
        .groupBy("CustomerID")
        .agg(
            F.count_distinct("InvoiceNo").alias("num_transactions"),
            _money("TotalAmount").alias("total_spend"),
            F.min("InvoiceDate").alias("first_purchase"),
            F.max("InvoiceDate").alias("last_purchase"),
        )
        .withColumn("days_between_purchases", F.datediff("last_purchase", "first_purchase"))
    )


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int) -> DataFrame:
    """(bin, bin_start, bin_end, n): equal-width bins over the clipped value, empty bins as 0."""
    width = (hi - lo) / bins
    value = clipped(F.col(col).cast("double"), float(lo), float(hi))
    index = F.least(F.floor((value - F.lit(float(lo))) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.filter(F.col(col).isNotNull()).groupBy(index.alias("bin")).agg(F.count("*").alias("n"))
    edges = df.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"),
        (F.lit(float(lo)) + F.col("id") * F.lit(width)).alias("bin_start"),
        (F.lit(float(lo)) + (F.col("id") + 1) * F.lit(width)).alias("bin_end"),
    )
    return edges.join(counts, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def describe_long(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count, mean, stddev, min, max per column in one pass; columns that are no numbers
    (text, dates, times, flags) give their count and their bounds as text."""
    rows = []
    for c in cols or df.columns:
        text = not isinstance(df.schema[c].dataType, NumericType)
        number = F.lit(None).cast("double") if text else F.col(c).cast("double")
        words = F.col(c) if text else F.lit(None).cast("string")
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                F.avg(number).alias("mean"),
                F.stddev_samp(number).alias("stddev"),
                F.min(number).alias("min"),
                F.max(number).alias("max"),
                F.min(words).cast("string").alias("min_text"),
                F.max(words).cast("string").alias("max_text"),
            )
        )
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column in one pass."""
    rows = [
        F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("nulls"))
        for c in df.columns
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def returns_rate(df: DataFrame) -> DataFrame:
    """Lines, return lines and their percentage."""
    returns = F.count_if(F.col("Quantity") < 0)
    return df.agg(
        F.count("*").alias("n_lines"),
        returns.alias("n_returns"),
        (F.try_divide(returns, F.count("*")) * 100).alias("returns_pct"),
    )


def row_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """(stage, n_rows, n_columns) per named frame; nothing runs until it is read."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("stage"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in stages.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def grain_counts(df: DataFrame, grains: Mapping[str, Sequence[str]], lines: str = "lines") -> DataFrame:
    """One row: how many rows ``df`` has (``lines``) and how many groups at each grain, in one pass.

    ``grains`` go from coarse to fine, each with the keys of the one before it and more. Groups of
    the finest are counted with their rows in the map tasks, the coarser ones from those counts.
    """
    names, keys = list(grains), [list(k) for k in grains.values()]
    if any(not set(a) < set(b) for a, b in zip(keys, keys[1:])):
        raise ValueError("each grain has all keys of the one before it, and more")
    counts, known = df, {lines: F.count(F.lit(1))}
    for name, k in zip(reversed(names), reversed(keys)):
        counts = counts.groupBy(*k).agg(*[value.alias(n) for n, value in known.items()])
        known = {n: F.sum(n) for n in known} | {name: F.count(F.lit(1))}
    return counts.agg(*[F.coalesce(known[n], F.lit(0)).cast("long").alias(n) for n in (lines, *names)])


def distinct_dates(df: DataFrame, col: str = "date") -> DataFrame:
    return df.select(F.col(col).alias("date")).distinct()


def quartiles(
    df: DataFrame, col: str, id_cols: Sequence[str] = (), exact: bool = True, bounded: bool = False
) -> DataFrame:
    """(ids, q1, median, q3) of a column."""
    names = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    found = quantile_columns(df, [col], names, id_cols, exact, bounded)
    return found.select(*id_cols, *[F.col(f"{col}_{n}").alias(n) for n in names])


def correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x, y, corr) for every ordered pair of columns, each over the rows where both are present.

    A row is expanded into the pairs of the upper triangle inside its task and
    folded at once by a partial aggregate, so the shuffle carries one row per
    pair and task, and the code stays small however many columns there are.
    """
    name = F.array(*[F.lit(c) for c in cols])
    upper = (
        df.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("_v"))
        .select("_v", F.posexplode("_v").alias("_i", "_a"))
        .select("_i", "_a", F.posexplode(F.slice("_v", F.col("_i") + 1, len(cols))).alias("_j", "_b"))
        .groupBy("_i", "_j")
        .agg(correlation_of(F.col("_a"), F.col("_b")).alias("corr"))
        .select(F.get(name, "_i").alias("x"), F.get(name, F.col("_i") + F.col("_j")).alias("y"), "corr")
    )
    swapped = F.struct(F.col("y").alias("x"), F.col("x").alias("y"), "corr")
    both = F.array(F.struct("x", "y", "corr"), swapped)
    return upper.select(F.inline(F.when(F.col("x") == F.col("y"), F.slice(both, 1, 1)).otherwise(both)))


def target_correlation(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """(feature, corr) with the target."""
    rows = [F.struct(F.lit(c).alias("feature"), correlation_of(F.col(c), F.col(target)).alias("corr")) for c in cols]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def top_k(df: DataFrame, by: str, k: int, tie: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest ``by``; ``tie`` columns settle equal values."""
    return df.orderBy(F.col(by).desc_nulls_last(), *tie).limit(k)
