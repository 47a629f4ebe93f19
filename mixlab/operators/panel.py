"""The model panel: sales, spend per channel, external factors and calendar, per day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixlab.functions.noise import uniform
from mixlab.operators.blocks import positions
from mixlab.operators.channels import channel_transform
from mixlab.operators.features import panel_calendar
from mixlab.operators.prep import zero_fill


OTHERS = "other_channels"


def _known_channel(channels: Sequence[str], others: str) -> Column:
    """The channel; one that is not listed ends the query, or is named OTHERS to be carried along."""
    if others not in ("fail", "carry"):
        raise ValueError("others is 'fail' or 'carry'")
    name = F.coalesce(F.col("channel"), F.lit("NULL"))
    unlisted = F.lit(OTHERS) if others == "carry" else F.raise_error(F.concat(F.lit("unlisted channel: "), name)).cast("string")
    return F.when(F.col("channel").isin(list(channels)), F.col("channel")).otherwise(unlisted)


def pivot_spend(
    df: DataFrame,
    channels: Sequence[str],
    id_cols: Sequence[str] = (),
    carry: Sequence[str] = (),
    others: str = "fail",
    exact: bool = False,
) -> DataFrame:
    """Long to wide, ``sum(spend)`` per channel; ``carry`` columns become ``{channel}_{col}``.

    The channel list is given, so the schema is fixed and no extra job looks for it.
    Spend of a channel that is not listed is never dropped: ``others`` says whether it
    ends the query or goes to a column of its own. ``exact`` leaves decimal spend decimal.
    """
    names = [*channels, *([OTHERS] if others == "carry" else [])]
    known = df.withColumn("channel", _known_channel(channels, others))
    grouped = known.groupBy(*id_cols, "date").pivot("channel", names)
    if not carry:
        return grouped.agg(F.sum("spend") if exact else F.sum("spend").cast("double"))
    measures = [F.sum("spend").cast("double").alias("spend"), *[F.sum(c).alias(c) for c in carry]]
    return grouped.agg(*measures).withColumnsRenamed({f"{c}_spend": c for c in channels})


def join_spend(sales: DataFrame, wide: DataFrame, id_cols: Sequence[str] = ()) -> DataFrame:
    """Inner join on ids and date. Both sides come out of an aggregation on these
    keys, so their partitioning is reused and no row moves again."""
    return sales.join(wide, [*id_cols, "date"])


def join_external(panel: DataFrame, external: DataFrame, id_cols: Sequence[str] = ()) -> DataFrame:
    """Left join on date (and on the ids the external table has); a column that is
    already in the panel gets the prefix ``ext_``."""
    keys = [*[c for c in id_cols if c in external.columns], "date"]
    clash = {c: f"ext_{c}" for c in external.columns if c in panel.columns and c not in keys}
    return panel.join(external.withColumnsRenamed(clash), keys, "left")


def build_panel(
    sales: DataFrame,
    spend: DataFrame,
    channels: Sequence[str],
    params: Mapping[str, Mapping],
    external: DataFrame | None = None,
    id_cols: Sequence[str] = (),
    carry_features: Sequence[str] = (),
) -> DataFrame:
    """Pivot, inner join, left join, zero-fill, channel transforms, calendar."""
    panel = join_spend(sales, pivot_spend(spend, channels, id_cols, carry_features), id_cols)
    return finish_panel(panel, channels, params, external, id_cols)


def finish_panel(
    panel: DataFrame,
    channels: Sequence[str],
    params: Mapping[str, Mapping],
    external: DataFrame | None = None,
    id_cols: Sequence[str] = (),
) -> DataFrame:
    """External factors, zero-fill, channel transforms and calendar on a sales + spend frame."""
    if external is not None:
        panel = join_external(panel, external, id_cols)
    panel = zero_fill(panel, [*id_cols, "date"])
    return panel_calendar(channel_transform(panel, channels, params, id_cols))


def sales_with_spend(df: DataFrame, channels: Sequence[str], id_cols: Sequence[str] = ()) -> DataFrame:
    """Daily sales and wide spend in one aggregation, for lines that carry both.

    Equal to joining ``daily_sales`` and ``pivot_spend`` of the same lines, but
    the lines (and the joins below them) are read once and shuffled once, as one
    partial row per date and task. A channel that is not listed ends the query.
    """
    df = df.withColumn("channel", _known_channel(channels, "fail"))
    return df.groupBy(*id_cols, F.col("InvoiceDate").alias("date")).agg(
        F.sum("TotalAmount").cast("double").alias("revenue"),
        F.count("InvoiceNo").alias("transactions"),
        F.count("CustomerID").alias("unique_customers"),
        *[
            F.sum(F.when(F.col("channel") == c, F.col("spend"))).cast("double").alias(c)
            for c in channels
        ],
    )


def long_spend(wide: DataFrame, channels: Sequence[str], id_cols: Sequence[str] = ()) -> DataFrame:
    """(ids, date, channel, spend) from wide spend that has not been zero-filled; days without a channel have no row for it."""
    pairs = F.array(*[F.struct(F.lit(c).alias("channel"), F.col(c).alias("spend")) for c in channels])
    return wide.select(*id_cols, "date", F.inline(pairs)).filter(F.col("spend").isNotNull())


def time_split(
    df: DataFrame, train_end: str, test_start: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Train up to ``train_end``; test after it, or from ``test_start`` when given."""
    train = df.filter(F.col("date") <= F.to_date(F.lit(train_end)))
    if test_start is None:
        return train, df.filter(F.col("date") > F.to_date(F.lit(train_end)))
    return train, df.filter(F.col("date") >= F.to_date(F.lit(test_start)))


def time_part(df: DataFrame, train_end: str, test_start: str | None = None) -> DataFrame:
    """The rows of both sides of ``time_split``, with their side in ``part``, in one pass."""
    train = F.col("date") <= F.to_date(F.lit(train_end))
    test = F.col("date") >= F.to_date(F.lit(test_start)) if test_start else F.col("date") > F.to_date(F.lit(train_end))
    return df.withColumn("part", F.when(train, "train").when(test, "test")).filter(F.col("part").isNotNull())


def random_part(df: DataFrame, keys: Sequence[str], fraction: float = 0.8, seed: int = 42) -> DataFrame:
    """The rows with their side of ``random_split`` in ``part``."""
    low = uniform(F.concat_ws("|", *keys), seed, "split") < F.lit(fraction)
    return df.withColumn("part", F.when(low, "train").otherwise("test"))


def random_split(
    df: DataFrame, keys: Sequence[str], fraction: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the row's key: a retried task sends a row to the same side."""
    low = uniform(F.concat_ws("|", *keys), seed, "split") < F.lit(fraction)
    return df.filter(low), df.filter(~low)


def time_folds(df: DataFrame, k: int = 3, id_cols: Sequence[str] = ()) -> DataFrame:
    """(ids, date, fold): the test block of each date in expanding-window validation, per series.

    With n dates in k+1 parts, the last k blocks of m = n // (k+1) dates are test
    blocks 0..k-1; earlier dates (fold -1) only train. Dates are made distinct
    first and numbered by ``positions``, so no window holds a whole calendar.
    """
    ranked = positions(df.select(*id_cols, "date").distinct(), "_r", id_cols, total="_n")
    size = F.floor(F.col("_n") / (k + 1))
    first = F.col("_n") - k * size
    block = F.floor((F.col("_r") - first) / F.nullif(size, F.lit(0))).cast("int")
    fold = F.when((size > 0) & (F.col("_r") >= first), block).otherwise(-1)
    return ranked.select(*id_cols, "date", fold.alias("fold"))


def fold_rows(df: DataFrame, k: int = 3, id_cols: Sequence[str] = ()) -> DataFrame:
    """The rows with the ``fold`` of their date; ``df`` is read twice and should be staged."""
    folds = time_folds(df, k, id_cols)
    named = folds.select(*[F.col(c).alias(f"_on_{i}") for i, c in enumerate([*id_cols, "date"])], "fold")
    same = F.lit(True)
    for i, c in enumerate([*id_cols, "date"]):
        same &= F.col(c).eqNullSafe(F.col(f"_on_{i}"))
    return df.join(named, same).drop(*[f"_on_{i}" for i in range(len(id_cols) + 1)])
