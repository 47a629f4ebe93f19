"""Dates, filters, outliers and missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegerType, NumericType

from mixlab.operators.facts import attach
from mixlab.operators.quantiles import quantile_columns


def parse_date(df: DataFrame, col: str, fmt: str | None = None) -> DataFrame:
    """Replace ``col`` by its date; text that is no date becomes NULL."""
    if dict(df.dtypes)[col] == "string":
        parsed = F.try_to_timestamp(F.col(col), F.lit(fmt)) if fmt else F.try_to_timestamp(F.col(col))
        return df.withColumn(col, parsed.cast("date"))
    return df.withColumn(col, F.to_date(col))


def line_amount(df: DataFrame, name: str = "TotalAmount") -> DataFrame:
    """Quantity times price, exact when the price is a decimal."""
    return df.withColumn(name, F.col("Quantity") * F.col("UnitPrice"))


def exclude_returns(df: DataFrame, include: bool = False) -> DataFrame:
    return df if include else df.filter(F.col("Quantity") > 0)


def date_range(df: DataFrame, start: str | None, end: str | None, col: str = "date") -> DataFrame:
    """Both bounds inclusive; applied only when both are given."""
    if not (start and end):
        return df
    return df.filter(F.col(col).between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))


def zero_fill(df: DataFrame, keys: Sequence[str] = ("date",)) -> DataFrame:
    """NULL becomes 0 in every numeric column that is not a key, in one projection."""
    return df.select(
        *[
            F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType)).alias(f.name)
            if f.name not in keys and isinstance(f.dataType, NumericType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def clipped(col: Column, lo: float, hi: float) -> Column:
    return F.when(col.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), col)))


def clip(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    return df.withColumn(col, clipped(F.col(col).cast("double"), float(lo), float(hi)))


def numeric_columns(df: DataFrame, all_numeric: bool = False) -> list[str]:
    """The imputer's columns: double, float and int, or every numeric type."""
    kinds = NumericType if all_numeric else (DoubleType, FloatType, IntegerType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def _iqr_limits(df, col, threshold, id_cols, exact, bounded) -> DataFrame:
    limits = quantile_columns(df, [col], {"q1": 0.25, "q3": 0.75}, id_cols, exact, bounded)
    q1, q3 = F.col(f"{col}_q1"), F.col(f"{col}_q3")
    reach = F.lit(float(threshold)) * (q3 - q1)
    return limits.select(*id_cols, (q1 - reach).alias("_lower"), (q3 + reach).alias("_upper"))


def iqr_outliers(
    df: DataFrame,
    col: str,
    threshold: float = 3.0,
    id_cols: Sequence[str] = (),
    exact: bool = True,
    bounded: bool = False,
) -> DataFrame:
    """Rows with ``col`` inside [q1 - t*iqr, q3 + t*iqr]; NULL rows go, as in a comparison."""
    limits = _iqr_limits(df, col, threshold, id_cols, exact, bounded)
    return (
        attach(df, limits, id_cols)
        .filter(F.col(col).cast("double").between(F.col("_lower"), F.col("_upper")))
        .drop("_lower", "_upper")
    )


def outlier_counts(
    df: DataFrame,
    col: str,
    threshold: float = 3.0,
    id_cols: Sequence[str] = (),
    exact: bool = True,
    bounded: bool = False,
) -> DataFrame:
    """(ids, n_rows, n_kept, n_removed) of the same filter, as one aggregate."""
    limits = _iqr_limits(df, col, threshold, id_cols, exact, bounded)
    inside = F.col(col).cast("double").between(F.col("_lower"), F.col("_upper"))
    return (
        attach(df, limits, id_cols)
        .groupBy(*id_cols)
        .agg(F.count("*").alias("n_rows"), F.count_if(inside).alias("n_kept"))
        .withColumn("n_removed", F.col("n_rows") - F.col("n_kept"))
    )


def _mean(df: DataFrame, col: str) -> Column:
    """Mean of a column; decimals are summed exactly and divided once, so the order of rows does not matter."""
    if dict(df.dtypes)[col].startswith("decimal"):
        return F.sum(col).cast("double") / F.count(col)
    return F.avg(F.col(col).cast("double"))


def fill_missing(
    df: DataFrame,
    method: str = "interpolate",
    cols: Sequence[str] | None = None,
    id_cols: Sequence[str] = (),
    date_col: str = "date",
    bounded: bool = False,
) -> DataFrame:
    """Fill NULLs of ``cols`` with the mean, the median or the midpoint of the neighbours."""
    cols = list(cols) if cols is not None else [c for c in numeric_columns(df) if c not in id_cols]
    if method == "interpolate":
        return interpolate(df, cols, id_cols, date_col)
    if method == "mean":
        facts = df.groupBy(*id_cols).agg(
            *[_mean(df, c).alias(f"_fill_{c}") for c in cols]
        )
    elif method == "median":
        facts = quantile_columns(df, cols, {"fill": 0.5}, id_cols, bounded=bounded)
        facts = facts.select(*id_cols, *[F.col(f"{c}_fill").alias(f"_fill_{c}") for c in cols])
    else:
        return df
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"_fill_{c}")) for c in cols}
    return attach(df, facts, id_cols).withColumns(filled).select(*df.columns)


def interpolate(
    df: DataFrame, cols: Sequence[str], id_cols: Sequence[str] = (), date_col: str = "date"
) -> DataFrame:
    """NULL becomes the mean of the last value before and the first value after it.

    Takes one row per id and date. The value after is the last one seen in
    descending order, so both frames grow row by row instead of being rescanned.
    """
    past = W.partitionBy(*id_cols).orderBy(date_col).rowsBetween(W.unboundedPreceding, -1)
    future = W.partitionBy(*id_cols).orderBy(F.desc(date_col)).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumns(
        {
            c: F.coalesce(
                F.col(c).cast("double"),
                (F.last(F.col(c).cast("double"), True).over(past)
                 + F.last(F.col(c).cast("double"), True).over(future)) / 2,
            )
            for c in cols
        }
    )


def standardize(
    df: DataFrame, cols: Sequence[str], id_cols: Sequence[str] = (), bounded: bool = False
) -> DataFrame:
    """(x - mean) / sample deviation per id; a constant column becomes NULL."""
    facts = df.groupBy(*id_cols).agg(
        *[F.avg(F.col(c).cast("double")).alias(f"_avg_{c}") for c in cols],
        *[F.stddev_samp(F.col(c).cast("double")).alias(f"_std_{c}") for c in cols],
    )
    scaled = {
        c: F.try_divide(F.col(c).cast("double") - F.col(f"_avg_{c}"), F.nullif(F.col(f"_std_{c}"), F.lit(0.0)))
        for c in cols
    }
    return attach(df, facts, id_cols).withColumns(scaled).select(*df.columns)
