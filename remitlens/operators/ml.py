"""Rate models: features, boosted trees and least squares on Spark ML, elastic net, time-ordered validation.

Fitting runs Spark jobs when called; scoring is lazy.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.contracts import DEFAULT_THRESHOLDS, DIMS, GROUP_KEYS, ML_CATEGORICAL, ML_NUMERIC, Thresholds
from remitlens.functions.numbers import div_or_null
from remitlens.functions.text import MISSING_PART
from remitlens.operators import elastic
from remitlens.operators.compact import payment_rate_column
from remitlens.operators.medians import exact_medians
from remitlens.operators.ml_report import (
    BOOSTED,
    LINEAR,
    finite_target,
    fold_summary,
    linear_gap,
    rate_gaps,
    regression_metrics,
    with_target,
)
from remitlens.operators.ordering import latest_window, time_ordinal
from remitlens.sources.columns import ensure_columns
from remitlens.storage import shared_folder, stored

TARGET = "actual_rate_per_visit"
SEED = 42
LINEAR_METRICS = (
    "model_type string, r2 double, mean_absolute_error double, features_used array<string>, training_samples bigint, test_samples bigint"
)


@dataclass(frozen=True)
class FeatureModel:
    """Medians and category codes learned from training rows."""

    medians: dict[str, float]
    encoder: PipelineModel
    params: dict = field(default_factory=dict)

    def impute(self, df: DataFrame) -> DataFrame:
        """Numeric columns with gaps filled by the training median; categories with gaps spelled out."""
        df = ensure_columns(df, {c: None for c in self.medians})
        filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in self.medians.items()}
        filled.update({c: F.coalesce(F.col(c), F.lit(MISSING_PART)) for c in ML_CATEGORICAL})
        return df.withColumns({f"_f_{c}": value for c, value in filled.items()})

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the ``features`` vector. A category unseen in training encodes as zeros."""
        kept = df.columns
        return self.encoder.transform(self.impute(df)).select(*kept, "features")

    def names(self, df: DataFrame) -> list[str]:
        """Name of each vector position."""
        attributes = self.transform(df).schema["features"].metadata["ml_attr"]["attrs"]
        positions = sorted((a["idx"], a["name"]) for group in attributes.values() for a in group)
        return [name.replace("_f_", "", 1).replace("_oh_", "", 1) for _, name in positions]


def fit_features(train: DataFrame) -> FeatureModel:
    """Learn medians (exact) and categories. Numeric columns without any value are left out."""
    train = ensure_columns(train, {c: None for c in ML_NUMERIC})
    found = exact_medians(train, ML_NUMERIC).first().asDict()
    medians = {c: m for c, m in found.items() if m is not None}
    model = FeatureModel(medians, None)
    indexers = StringIndexer(
        inputCols=[f"_f_{c}" for c in ML_CATEGORICAL],
        outputCols=[f"_ix_{c}" for c in ML_CATEGORICAL],
        handleInvalid="keep",
    )
    # The code reserved for unseen categories is the last one, which the encoder drops.
    onehot = OneHotEncoder(
        inputCols=[f"_ix_{c}" for c in ML_CATEGORICAL], outputCols=[f"_oh_{c}" for c in ML_CATEGORICAL], dropLast=True
    )
    assembler = VectorAssembler(
        inputCols=[f"_f_{c}" for c in medians] + [f"_oh_{c}" for c in ML_CATEGORICAL], outputCol="features"
    )
    encoder = Pipeline(stages=[indexers, onehot, assembler]).fit(model.impute(train))
    return FeatureModel(medians, encoder)


class _Scorer:
    """Scores of a model whose output columns begin with ``prefix``."""

    prefix: str

    @property
    def predicted(self) -> str:
        return f"{self.prefix}_expected_rate_per_visit"

    def predict(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def score(self, df: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
        """Expected rate, gaps and flag on every row; rows without a target have no gap."""
        scored = self.predict(df)
        has_target = F.col(TARGET).isNotNull()
        scored = scored.withColumn(self.predicted, F.when(has_target, F.col(self.predicted)))
        return rate_gaps(scored, self.predicted, self.prefix, thresholds.ml_gap_per_visit)


@dataclass(frozen=True)
class RateModel(_Scorer):
    """A fitted Spark ML model; ``prefix`` names its output columns."""

    features: FeatureModel
    regressor: object
    prefix: str
    params: dict

    def predict(self, df: DataFrame) -> DataFrame:
        scored = self.regressor.transform(self.features.transform(df))
        return scored.withColumnRenamed("prediction", self.predicted).drop("features")


@dataclass(frozen=True)
class ElasticNet(_Scorer):
    """A fitted elastic net."""

    linear: elastic.Linear
    params: dict
    prefix: str = LINEAR

    def predict(self, df: DataFrame) -> DataFrame:
        given = ensure_columns(df, {c: None for c in self.linear.medians})
        return given.withColumn(self.predicted, self.linear.predicted()).select(*df.columns, self.predicted)


def model_rows(weekly: DataFrame) -> DataFrame:
    """Weekly rows with a target: payment per visit."""
    rate = div_or_null(F.col("payment_amount"), F.col("visit_count"))
    return with_target(weekly.withColumn(TARGET, rate), TARGET)


def fit_boosted(train: DataFrame, iters: int = 400, lr: float = 0.06, depth: int = 5) -> RateModel:
    """Gradient-boosted trees. Every iteration is a round of Spark jobs, so ``iters`` sets the cost.

    The assembled features are written once; residuals and node ids are checkpointed every few iterations, so neither
    plans nor the work after a lost executor grow with the iterations.
    """
    features = fit_features(train)
    spark = train.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    regressor = GBTRegressor(
        labelCol=TARGET, maxIter=iters, stepSize=lr, maxDepth=depth, maxBins=255, seed=SEED, cacheNodeIds=True
    )
    fitted = regressor.fit(stored(features.transform(train).select("features", TARGET), "features"))
    return RateModel(features, fitted, BOOSTED, {"iters": iters, "lr": lr, "depth": depth})


def _elastic_prefixes(rows: DataFrame, n_blocks: int, alpha: float, l1_ratio: float) -> list[ElasticNet]:
    """The elastic net on the first block, the first two, and so on; ``rows`` name theirs in ``block``.

    The rows are read for their gaps, twice for the medians of all prefixes, and once for the statistics of all blocks.
    """
    rows = ensure_columns(rows, {c: None for c in ML_NUMERIC})
    gaps = rows.agg(*[F.count(F.when(F.col(c).isNull() | F.isnan(F.col(c).cast("double")), 1)).alias(c) for c in ML_NUMERIC]).first().asDict()
    prefixes = {f"{c}:{i}": F.when(F.col("block") < i, F.col(c).cast("double")) for i in range(1, n_blocks + 1) for c in ML_NUMERIC}
    medians = exact_medians(rows.select(*[v.alias(n) for n, v in prefixes.items()]), list(prefixes)).first().asDict()
    stats = elastic.statistics(rows, TARGET, [c for c, n in gaps.items() if n], n_blocks)
    params = {"alpha": alpha, "l1_ratio": l1_ratio}
    return [
        ElasticNet(elastic.solve(stats, i, {c: medians[f"{c}:{i}"] for c in ML_NUMERIC}, alpha, l1_ratio), params)
        for i in range(1, n_blocks + 1)
    ]


def fit_elasticnet(train: DataFrame, alpha: float = 0.1, l1_ratio: float = 0.2) -> ElasticNet:
    """Elastic net on unscaled features with penalty alpha * (l1_ratio * |w| + (1 - l1_ratio) / 2 * w²)."""
    return _elastic_prefixes(train.withColumn("block", F.lit(0)), 1, alpha, l1_ratio)[0]


def _capped(weekly: DataFrame, row_cap: int | None, tiebreak: Sequence[str]) -> DataFrame:
    rows = model_rows(weekly)
    return latest_window(rows, row_cap, tiebreak) if row_cap else rows


def _placed(weekly: DataFrame, k: int, row_cap: int | None, tiebreak: Sequence[str]) -> tuple[DataFrame, int, int]:
    """Rows with a target and their place in time (stored), how many there are, and the size of a test block."""
    placed = stored(time_ordinal(_capped(weekly, row_cap, tiebreak), tiebreak), "cv")
    n = placed.count()
    if n // (k + 1) == 0:
        raise ValueError(f"Too few rows ({n}) for {k} folds")
    return placed, n, n // (k + 1)


def time_cv(
    weekly: DataFrame,
    fit: Callable[[DataFrame], _Scorer],
    k: int = 5,
    row_cap: int | None = None,
    tiebreak: Sequence[str] = tuple(DIMS),
) -> DataFrame:
    """Fold, MAE, RMSE and R² of ``k`` expanding splits: each test block follows all of its training rows.

    A test block has n // (k + 1) rows. Rows are ordered once and stored, so folds are plain range filters.
    """
    placed, n, size = _placed(weekly, k, row_cap, tiebreak)
    folds = None
    for i in range(k):
        start = n - (k - i) * size
        at = F.col("ord")
        model = fit(placed.filter(at < start))
        test = model.predict(placed.filter((at >= start) & (at < start + size)))
        row = regression_metrics(test, TARGET, model.predicted).select(F.lit(i + 1).alias("fold"), "mae", "rmse", "r2")
        folds = row if folds is None else folds.unionByName(row)
    return folds


def elastic_cv(
    weekly: DataFrame,
    alpha: float = 0.1,
    l1_ratio: float = 0.2,
    k: int = 5,
    row_cap: int | None = None,
    tiebreak: Sequence[str] = tuple(DIMS),
) -> tuple[DataFrame, ElasticNet, DataFrame]:
    """``time_cv`` of the elastic net, its fit on all rows, and those rows, with one reading for all folds.

    Folds are blocks of time; what a fold trains on is the sum of the statistics of the blocks before it. Every row is
    in one test block at most, so one more pass predicts all of them, each with the model of its fold.
    """
    placed, n, size = _placed(weekly, k, row_cap, tiebreak)
    block = F.greatest(F.lit(0), F.floor((F.col("ord") - (n - k * size)) / size) + 1).cast("int")
    rows = placed.withColumn("block", block)
    *models, final = _elastic_prefixes(rows, k + 1, alpha, l1_ratio)
    given = ensure_columns(rows, {c: None for c in ML_NUMERIC})
    expected = F.lit(None).cast("double")
    for i, model in enumerate(models, 1):
        expected = F.when(F.col("block") == i, model.linear.predicted()).otherwise(expected)
    tested = given.select(F.col("block").alias("fold"), TARGET, expected.alias("_expected")).where("fold > 0")
    folds = regression_metrics(tested, TARGET, "_expected", ["fold"]).select("fold", "mae", "rmse", "r2")
    return folds, final, placed


def score(
    weekly: DataFrame, fit: Callable[[DataFrame], _Scorer], row_cap: int | None = None, tiebreak: Sequence[str] = tuple(DIMS)
) -> DataFrame:
    """Fit on the rows with a target, score the whole weekly table in place."""
    model = fit(_capped(weekly, row_cap, tiebreak))
    rate = div_or_null(F.col("payment_amount"), F.col("visit_count"))
    return model.score(weekly.withColumn(TARGET, rate))


def metrics_record(folds: DataFrame, scored: DataFrame, model: _Scorer) -> DataFrame:
    """One row: parameters, fold metrics in fold order with their summary, and metrics on the training rows."""
    train = regression_metrics(scored, TARGET, model.predicted)
    per_fold = F.sort_array(F.collect_list(F.struct("fold", "mae", "rmse", "r2")))
    cv = folds.agg(per_fold.alias("folds"))
    summary = fold_summary(folds)
    params = F.struct(*[F.lit(v).alias(p) for p, v in model.params.items()])
    rows = scored.agg(F.count(TARGET)).scalar()
    return train.select(
        params.alias("params"),
        rows.alias("rows_used_for_model"),
        cv.scalar().alias("folds"),
        summary.select(F.struct(*summary.columns)).scalar().alias("cross_validation"),
        F.struct("mae", "rmse", "r2").alias("train_fit"),
    )


def feature_importance(model: RateModel, df: DataFrame) -> DataFrame:
    """Importance of each feature of a tree model, largest first. One row per vector position."""
    if not hasattr(getattr(model, "regressor", None), "featureImportances"):
        raise ValueError("The model has no feature importances")
    values = model.regressor.featureImportances.toArray().tolist()
    rows = list(zip(model.features.names(df), values))
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def linear_diagnostics(
    lines: DataFrame, id_cols: Sequence[str] = ("row_id",), min_rows: int = 10, thresholds: Thresholds = DEFAULT_THRESHOLDS
) -> tuple[DataFrame, DataFrame]:
    """Least squares of the payment rate on charge and, when present, visits: (scored lines, metrics row).

    A fifth of the lines, drawn by a digest of ``id_cols``, is held out for the metrics. With ``min_rows`` lines or
    fewer nothing is fitted: the scores are missing, and the metrics table has no row.
    """
    used = [c for c in ("charge_amount", "visit_count") if c in lines.columns]
    rated = lines.withColumn("payment_rate", payment_rate_column())
    digest = F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in id_cols], F.lit(str(SEED))).cast("binary"))
    held_out = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 5 == 0
    rows = finite_target(rated, "payment_rate").fillna(0.0, subset=used).withColumn("_held_out", held_out)
    assembler = VectorAssembler(inputCols=used, outputCol="features")
    train, test = rows.filter(~F.col("_held_out")), rows.filter("_held_out")
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(held_out, 1)).alias("test")).first()
    names = F.array(*[F.lit(c) for c in used]).alias("features_used")
    if counts["n"] <= min_rows:
        missing = {c: F.lit(None).cast("double") for c in ("ml_expected_rate", "ml_rate_gap")}
        nothing = rated.withColumns({**missing, "ml_materiality_flag": F.lit(None).cast("boolean")})
        return nothing, lines.sparkSession.createDataFrame([], LINEAR_METRICS)
    regressor = LinearRegression(labelCol="payment_rate", regParam=0.0, predictionCol="ml_expected_rate")
    model = regressor.fit(assembler.transform(train).select("features", "payment_rate"))
    metrics = regression_metrics(model.transform(assembler.transform(test)), "payment_rate", "ml_expected_rate")
    metrics = metrics.select(
        F.lit("Linear Regression").alias("model_type"),
        "r2",
        F.col("mae").alias("mean_absolute_error"),
        names,
        F.lit(counts["n"] - counts["test"]).cast("bigint").alias("training_samples"),
        F.lit(counts["test"]).cast("bigint").alias("test_samples"),
    )
    scored = model.transform(assembler.transform(rated.fillna(0.0, subset=used))).drop("features")
    return linear_gap(scored, "ml_expected_rate", thresholds.linear_gap), metrics
