"""Least squares from cross products that add up: one aggregate, any number of entities and folds.

A block is (n, means, moments) of some rows: their number, the mean of every column and the
centred cross products of every pair of columns (upper triangle, row by row). Two blocks
merge into one of all their rows, so a fit over any union of blocks reads no row again.
Blocks are solved where they are, as arrays, so a million entities are a million rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# A column whose variance is but this share of its own, after the columns before it, has coefficient 0.
TOLERANCE = 1e-9


def pairs(width: int) -> list[tuple[int, int]]:
    """The places (i, j), i <= j, of ``moments``, in order."""
    return [(i, j) for i in range(width) for j in range(i, width)]


def _complete(columns: Sequence[str]) -> Column:
    present = F.lit(True)
    for c in columns:
        value = F.col(c).cast("double")
        present &= value.isNotNull() & ~F.isnan(value)
    return present


def gram_blocks(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, n, means, moments): one block per group, in one aggregate that combines in the map tasks.

    Products are centred while they are summed, so large means lose no digits. Rows with a
    null or NaN in any of the columns belong to no block.
    """
    x = ["cast(`{}` as double)".format(c.replace("`", "``")) for c in columns]
    products = ", ".join(f"covar_pop({x[i]}, {x[j]}) * count(1)" for i, j in pairs(len(x)))
    return (
        df.filter(_complete(columns))
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.expr(f"array({', '.join(f'avg({v})' for v in x)})").alias("means"),
            F.expr(f"array({products})").alias("moments"),
        )
        .filter("n > 0")
    )


def _moment(block: Column, i: Column, j: Column, width: int) -> Column:
    """The cross product of columns i and j of a block, in either order."""
    low, high = F.least(i, j), F.greatest(i, j)
    row = low * width - F.shiftright(low * (low - 1), 1)
    return F.get(block["moments"], row + high - low)


def _merged(width: int, over: Callable[[Column], Column]) -> dict[str, Column]:
    """The block of all blocks that ``over`` sums."""
    mean = [F.get("means", F.lit(i)) for i in range(width)]
    total = over(F.sum("n"))
    sums = [over(F.sum(F.col("n") * m)) for m in mean]
    products = [
        over(F.sum(F.get("moments", F.lit(k)) + F.col("n") * mean[i] * mean[j])) - sums[i] * sums[j] / total
        for k, (i, j) in enumerate(pairs(width))
    ]
    return {"n": total, "means": F.array(*[s / total for s in sums]), "moments": F.array(*products)}


def merge_blocks(blocks: DataFrame, width: int, by: Sequence[str] = ()) -> DataFrame:
    """(by, n, means, moments): the blocks of each group as one."""
    return blocks.groupBy(*by).agg(*[c.alias(name) for name, c in _merged(width, lambda c: c).items()])


def earlier_blocks(blocks: DataFrame, width: int, by: Sequence[str], order: str) -> DataFrame:
    """Add ``earlier``: the merged block of all blocks of the group before this one; null for the first.

    A window over blocks, of which a group has as many as there are folds or periods.
    """
    before = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    parts = _merged(width, lambda c: c.over(before))
    merged = F.struct(*[c.alias(name) for name, c in parts.items()])
    return blocks.withColumn("earlier", F.when(parts["n"].isNotNull(), merged))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, computed once."""
    return F.transform(F.array(value), body)[0]


def _solved(system: Column, width: int) -> Column:
    """The solution of a symmetric system of scaled rows (array of ``width`` + 1 numbers each), by elimination."""

    def step(rows: Column, c: Column) -> Column:
        pivot = F.get(F.get(rows, c), c)
        scaled = F.transform(F.get(rows, c), lambda v: v / pivot)
        swept = let(
            scaled,
            lambda s: F.transform(
                rows, lambda row, i: F.when(i == c, s).otherwise(F.zip_with(row, s, lambda v, w: v - F.get(row, c) * w))
            ),
        )
        dropped = F.transform(rows, lambda row, i: F.when(i == c, F.transform(row, lambda v: v * 0)).otherwise(row))
        return F.when(pivot > TOLERANCE, swept).otherwise(dropped)

    swept = F.reduce(F.sequence(F.lit(0), F.lit(width - 1)), system, step)
    return F.transform(swept, lambda row: F.get(row, F.lit(width)))


def coefficients(block: Column, width: int) -> Column:
    """struct(intercept, slopes): least squares of the last of a block's columns on the others.

    Columns are scaled to unit variance first. One that is constant, or a combination of
    those before it, gets slope 0. A block of null is no fit.
    """
    features = width - 1
    places = F.sequence(F.lit(0), F.lit(features - 1))

    def over(value: Column, scale: Column) -> Column:
        return F.coalesce(F.try_divide(value, F.nullif(scale, F.lit(0.0))), F.lit(0.0))

    def fit(scale: Column) -> Column:
        def row(i: Column) -> Column:
            left = F.transform(places, lambda j: over(over(_moment(block, i, j, width), F.get(scale, i)), F.get(scale, j)))
            return F.concat(left, F.array(over(_moment(block, i, F.lit(features), width), F.get(scale, i))))

        solved = _solved(F.transform(places, row), features)
        return let(F.zip_with(solved, scale, over), lambda s: F.struct(_offset(block, s, features).alias("intercept"), s.alias("slopes")))

    scales = F.transform(places, lambda i: F.sqrt(F.greatest(_moment(block, i, i, width), F.lit(0.0))))
    return F.when(block.isNotNull(), let(scales, fit))


def _offset(block: Column, slopes: Column, features: int) -> Column:
    """The mean of the target less that of the slopes' sum."""
    products = F.zip_with(slopes, F.slice(block["means"], 1, features), lambda b, m: b * m)
    return F.get(block["means"], F.lit(features)) - F.reduce(products, F.lit(0.0), lambda a, v: a + v)


def squared_error(block: Column, fit: Column, width: int) -> Column:
    """The sum of squared errors that a fit leaves on the rows of a block, from the block alone."""
    features = width - 1
    places = F.sequence(F.lit(0), F.lit(features))

    def summed(weights: Column) -> Column:
        def row(i: Column) -> Column:
            terms = F.transform(places, lambda j: F.get(weights, j) * _moment(block, i, j, width))
            return F.get(weights, i) * F.reduce(terms, F.lit(0.0), lambda a, v: a + v)

        return F.greatest(F.reduce(F.transform(places, row), F.lit(0.0), lambda a, v: a + v), F.lit(0.0))

    weights = F.concat(F.transform(fit["slopes"], lambda b: -b), F.array(F.lit(1.0)))
    missed = _offset(block, fit["slopes"], features) - fit["intercept"]
    return let(weights, summed) + block["n"] * missed * missed


def _whole(df: DataFrame) -> Column:
    return F.struct("n", "means", "moments")


def fit_blocks(blocks: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, n, intercept, slopes, r2) of each block; r2 is null where the target is constant."""
    width = len(features) + 1
    fitted = blocks.withColumn("_block", _whole(blocks)).withColumn("_fit", coefficients(F.col("_block"), width))
    spread = F.get("moments", F.lit(len(pairs(width)) - 1))
    left = squared_error(F.col("_block"), F.col("_fit"), width)
    r2 = F.lit(1.0) - F.try_divide(left, F.nullif(F.greatest(spread, F.lit(0.0)), F.lit(0.0)))
    return fitted.select(*by, "n", "_fit.intercept", "_fit.slopes", r2.alias("r2"))


def train_linear_by(df: DataFrame, features: Sequence[str], by: Sequence[str], target: str = "revenue") -> DataFrame:
    """(by, n, intercept, slopes, r2): one least-squares fit per entity, all in one aggregate."""
    return fit_blocks(gram_blocks(df, [*features, target], by), features, by)


def score_by(df: DataFrame, fits: DataFrame, features: Sequence[str], by: Sequence[str], out: str = "prediction") -> DataFrame:
    """Add each row's prediction by the fit of its entity; null where there is none. Null ids are an entity."""
    named = fits.select(*[F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)], F.struct("intercept", "slopes").alias("_fit"))
    same = F.lit(True)
    for i, c in enumerate(by):
        same &= F.col(c).eqNullSafe(F.col(f"_by_{i}"))
    total = F.col("_fit.intercept")
    for i, c in enumerate(features):
        total = total + F.get("_fit.slopes", F.lit(i)) * F.col(c).cast("double")
    return df.join(named, same, "left").withColumn(out, total).drop("_fit", *[f"_by_{i}" for i in range(len(by))])


def cross_validate_by(
    df: DataFrame, features: Sequence[str], by: Sequence[str] = (), target: str = "revenue", fold: str = "fold"
) -> DataFrame:
    """(by, fold, n_train, n, rmse, r2) of expanding-window validation, per entity and test block.

    ``df`` has each row's ``fold`` (``time_folds``; -1 only trains). One aggregate makes a
    block per (entity, fold); the fit for a fold comes from the merged blocks before it, and
    its errors from the fold's own block, so the rows are read once, whatever the number of folds.
    """
    width = len(features) + 1
    blocks = gram_blocks(df, [*features, target], [*by, fold])
    tested = earlier_blocks(blocks, width, by, fold).filter((F.col(fold) >= 0) & F.col("earlier").isNotNull())
    scored = tested.withColumn("_block", _whole(tested)).withColumn("_fit", coefficients(F.col("earlier"), width))
    left = squared_error(F.col("_block"), F.col("_fit"), width)
    spread = F.greatest(F.get("moments", F.lit(len(pairs(width)) - 1)), F.lit(0.0))
    return scored.withColumn("_left", left).select(
        *by,
        fold,
        F.col("earlier.n").alias("n_train"),
        "n",
        F.sqrt(F.col("_left") / F.col("n")).alias("rmse"),
        (F.lit(1.0) - F.try_divide("_left", F.nullif(spread, F.lit(0.0)))).alias("r2"),
    )
