"""Revenue models on the panel: Spark ML fits, scoring, evaluation and search."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from mixlab.config import BOOSTING_ROUNDS
from mixlab.functions.carryover import carry_over, geometric_weights, saturate
from mixlab.functions.stats import correlation_of
from mixlab.operators.gram import coefficients, earlier_blocks, fit_blocks, gram_blocks, score_by
from mixlab.operators.panel import fold_rows
from mixlab.session import stage


def feature_columns(df: DataFrame, target: str = "revenue", exclude: Sequence[str] = ()) -> list[str]:
    """Every numeric column but the target and the excluded ones, such as numeric ids."""
    dropped = {"date", target, *exclude}
    return [f.name for f in df.schema if f.name not in dropped and isinstance(f.dataType, NumericType)]


def assemble(df: DataFrame, target: str = "revenue", exclude: Sequence[str] = ()) -> DataFrame:
    """Add the vector column ``features`` of all feature columns, in column order."""
    return VectorAssembler(
        inputCols=feature_columns(df, target, exclude), outputCol="features", handleInvalid="keep"
    ).transform(df)


def _training_rows(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(features, label), staged once since every fitting pass reads it again."""
    vectors = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    rows = vectors.transform(df).select("features", F.col(target).cast("double").alias("label"))
    return stage(rows)


@dataclass(frozen=True)
class LinearScorer:
    """A linear model as plain numbers; scores with one column expression."""

    intercept: float
    coefs: Mapping[str, float]

    def _sum(self) -> Column:
        total = F.lit(float(self.intercept))
        for name, beta in self.coefs.items():
            total = total + F.lit(float(beta)) * F.col(name)
        return total

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self._sum())

    def effects(self, df: DataFrame, columns: Mapping[str, str], out: str) -> DataFrame:
        """Add the prediction, and per entry of ``columns`` (name -> feature) what the
        prediction loses when that feature is 0: here coefficient times value."""
        losses = {
            name: F.lit(float(self.coefs.get(feature, 0.0))) * F.col(feature)
            for name, feature in columns.items()
        }
        return df.withColumns({out: self._sum(), **losses})


@dataclass(frozen=True)
class TreeScorer:
    """A fitted Spark ML model with its feature order."""

    model: object
    features: Sequence[str]

    def _score(self, df: DataFrame, inputs: Sequence[str], out: str) -> DataFrame:
        vectors = VectorAssembler(inputCols=list(inputs), outputCol="_features", handleInvalid="keep")
        settings = {self.model.featuresCol: "_features", self.model.predictionCol: out}
        return self.model.transform(vectors.transform(df), settings).drop("_features")

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return self._score(df, self.features, out)

    def effects(self, df: DataFrame, columns: Mapping[str, str], out: str) -> DataFrame:
        """Score the row once as it is and once per feature set to 0, side by side in
        the same task: no row is copied, shuffled or joined back."""
        scored = self.predict(df, out).withColumn("_zero", F.lit(0.0))
        for name, feature in columns.items():
            inputs = ["_zero" if f == feature else f for f in self.features]
            scored = self._score(scored, inputs, f"_without_{name}")
        losses = {name: F.col(out) - F.col(f"_without_{name}") for name in columns}
        return scored.withColumns(losses).drop("_zero", *[f"_without_{n}" for n in columns])


def train_linear(df: DataFrame, features: Sequence[str], target: str = "revenue") -> LinearScorer:
    """Least squares over all features by the normal equations, from one aggregate over the rows.

    Rows with a null or NaN in a feature or the target are left out; without any left, all is 0.
    """
    row = fit_blocks(gram_blocks(df, [*features, target]), features).first()
    if row is None:
        return LinearScorer(0.0, dict.fromkeys(features, 0.0))
    return LinearScorer(float(row["intercept"]), dict(zip(features, map(float, row["slopes"]))))


def simple_linear(
    df: DataFrame, features: Sequence[str], target: str = "revenue", by: Sequence[str] = ()
) -> DataFrame:
    """(by, feature, slope, intercept, r2): one-variable fits of the target, in one aggregate."""
    y = F.col(target).cast("double")
    rows = [
        F.struct(
            F.lit(f).alias("feature"),
            F.regr_slope(y, F.col(f).cast("double")).alias("slope"),
            F.regr_intercept(y, F.col(f).cast("double")).alias("intercept"),
            F.regr_r2(y, F.col(f).cast("double")).alias("r2"),
        )
        for f in features
    ]
    return df.groupBy(*by).agg(F.array(*rows).alias("rows")).select(*by, F.inline("rows"))


def _gbt(max_iter: int, max_depth: int, seed: int) -> GBTRegressor:
    return GBTRegressor(
        maxIter=max_iter,
        maxDepth=max_depth,
        stepSize=0.05,
        featureSubsetStrategy="0.9",
        subsamplingRate=0.8,
        seed=seed,
        # Trees of this depth are small, so they are sent to the rows; kept node ids cost a cached table per level.
        cacheNodeIds=False,
        checkpointInterval=10,
    )


def train_gbt(
    df: DataFrame,
    features: Sequence[str],
    target: str = "revenue",
    max_iter: int = BOOSTING_ROUNDS,
    max_depth: int = 5,
    seed: int = 42,
) -> TreeScorer:
    """Boosted regression trees; depth 5 has at most 32 leaves."""
    learner = _gbt(max_iter, max_depth, seed)
    return TreeScorer(learner.fit(_training_rows(df, features, target)), list(features))


_fitted: dict[tuple, TreeScorer] = {}


def saved_gbt(
    df: DataFrame, features: Sequence[str], target: str = "revenue", max_iter: int = BOOSTING_ROUNDS, max_depth: int = 5, seed: int = 42
) -> TreeScorer:
    """``train_gbt``, or the model that this application fitted before on the same rows with the same parameters.

    Rows are compared by their number and the sum of their hashes, so other rows are
    fitted anew, also if they differ only in how often a row repeats. Nothing is kept
    beyond the application. ``df`` is read once more for it and should be staged.
    """
    cells = F.xxhash64(*[F.col(c).cast("double") for c in (*features, target)])
    rows, mark = df.agg(F.count("*"), F.sum(cells.cast("decimal(20,0)"))).first()
    params = _gbt(max_iter, max_depth, seed).extractParamMap()
    learner = tuple(sorted((p.name, str(value)) for p, value in params.items()))
    key = (df.sparkSession.sparkContext.applicationId, rows, mark, tuple(features), target, learner)
    if key not in _fitted:
        _fitted[key] = train_gbt(df, features, target, max_iter, max_depth, seed)
    return _fitted[key]


def importance(spark, scorer: TreeScorer) -> DataFrame:
    """(feature, importance), one row per feature, normalised to sum 1."""
    weights = scorer.model.featureImportances.toArray()
    rows = [(name, float(weight)) for name, weight in zip(scorer.features, weights)]
    return spark.createDataFrame(rows, "feature STRING, importance DOUBLE")


def evaluate(df: DataFrame, y: str = "revenue", yhat: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """(by, rmse, mae, r2, mape) in one pass; mape divides by y + 1."""
    actual, predicted = F.col(y).cast("double"), F.col(yhat).cast("double")
    error = actual - predicted
    total = F.var_pop(actual) * F.count(actual)
    return df.groupBy(*by).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.sum(error * error), F.nullif(total, F.lit(0.0)))).alias("r2"),
        (F.avg(F.abs(F.try_divide(error, actual + 1))) * 100).alias("mape"),
    )


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    target: str = "revenue",
    k: int = 3,
    fit: Callable | None = None,
    id_cols: Sequence[str] = (),
) -> DataFrame:
    """(ids, fold, rmse, mae, r2, mape) per test block of expanding-window validation.

    Linear models, the default, are fitted for all ids and folds in one pass (``gram``), and
    another one scores the test rows. ``fit`` gives any other learner, with a fit per fold of
    the whole series; it takes no ids.
    """
    if fit is not None and id_cols:
        raise ValueError("only linear models are fitted by id")
    staged = stage(fold_rows(stage(df), k, id_cols))
    if fit is None:
        width = len(features) + 1
        blocks = gram_blocks(staged, [*features, target], [*id_cols, "fold"])
        fits = earlier_blocks(blocks, width, id_cols, "fold").select(*id_cols, "fold", coefficients(F.col("earlier"), width).alias("f"))
        fits = stage(fits.filter("fold >= 0 and f is not null").select(*id_cols, "fold", "f.*"))
        scored = score_by(staged.filter("fold >= 0"), fits, features, [*id_cols, "fold"])
        return evaluate(scored.filter(F.col("prediction").isNotNull()), target, "prediction", [*id_cols, "fold"])
    scored = None
    for fold in range(k):
        scorer = fit(staged.filter(F.col("fold") < fold), features, target)
        block = scorer.predict(staged.filter(F.col("fold") == fold)).select("fold", target, "prediction")
        scored = block if scored is None else scored.unionByName(block)
    return evaluate(scored, target, "prediction", ["fold"])


def param_search(
    panel: DataFrame,
    channels: Sequence[str],
    grid: Mapping[str, Sequence[float]],
    target: str = "revenue",
    max_lag: int = 10,
    id_cols: Sequence[str] = (),
) -> DataFrame:
    """(ids, channel, decay_rate, k, S, r2): the grid point whose transformed spend
    explains most of the target, per channel. A channel whose transformed spend
    never varies has no best point and is left out.

    One window makes the carry-over of every channel and decay; each row is then
    expanded into its grid points inside the task and folded at once by a
    partial aggregate, so the shuffle carries one counter row per grid point.
    """
    w = W.partitionBy(*id_cols).orderBy("date")
    carried = {
        f"_x_{i}_{j}": carry_over(F.col(c), geometric_weights(d, max_lag), w)
        for i, c in enumerate(channels)
        for j, d in enumerate(grid["decay_rate"])
    }
    series = [
        F.struct(F.lit(c).alias("channel"), F.lit(float(d)).alias("decay_rate"), F.col(f"_x_{i}_{j}").alias("_x"))
        for i, c in enumerate(channels)
        for j, d in enumerate(grid["decay_rate"])
    ]
    curves = [
        F.struct(F.lit(float(k)).alias("k"), F.lit(float(S)).alias("S"))
        for k, S in product(grid["k"], grid["S"])
    ]
    points = (
        panel.select(*id_cols, F.col(target).cast("double").alias("_y"), "date", *channels)
        .withColumns(carried)
        .select(*id_cols, "_y", F.inline(F.array(*series)))
        .select(*id_cols, "channel", "decay_rate", "_x", "_y", F.inline(F.array(*curves)))
    )
    fit = correlation_of(saturate(F.col("_x"), "hill", F.col("k"), F.col("S")), F.col("_y"))
    scores = points.groupBy(*id_cols, "channel", "decay_rate", "k", "S").agg((fit * fit).alias("r2"))
    point = F.struct("decay_rate", "k", "S", "r2")
    rank = F.struct(F.col("r2"), -F.col("decay_rate"), -F.col("k"), -F.col("S"))
    best = scores.filter(F.col("r2").isNotNull()).groupBy(*id_cols, "channel").agg(
        F.max_by(point, rank).alias("best")
    )
    return best.select(*id_cols, "channel", "best.*")
