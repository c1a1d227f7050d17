"""Model fitting and scoring with spark.ml."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, LogisticRegression
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions import scalars as S
from tidemark.operators import metrics, sampling
from tidemark.operators.boosting import GBTClassifier
from tidemark.operators.routing import as_struct
from tidemark.session import materialized

# The tree ensemble and the linear baselines.
BOOSTED = {"rounds": 200, "depth": 4, "step": 0.05, "seed": 42}
LINEAR_C = 0.5
PLATT_C = 1.0
# Training rows that a partition holds at least, if there are so many, and partitions for each core at most.
PARTITION_ROWS = 50_000
PARTITIONS_A_CORE = 1


def with_vector(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return VectorAssembler(inputCols=columns or config.FEATURES, outputCol="features").transform(df)


def _mean_loss_penalty(c: float, n_rows: int) -> float:
    """Spark averages the loss; a penalty of C on the summed loss is 1 / (C * n) on the mean."""
    return 1.0 / (c * max(n_rows, 1))


def balance(df: DataFrame) -> tuple[int, float]:
    """Row count and negatives per positive."""
    row = metrics.class_balance(df).first()
    return row["n_rows"], row["scale_pos_weight"] or 1.0


def fit_linear(train: DataFrame, penalty: str, c: float = LINEAR_C, iterations: int = 100) -> LogisticRegressionModel:
    n_rows, _ = balance(train)
    lr = LogisticRegression(
        elasticNetParam={"l1": 1.0, "l2": 0.0}[penalty],
        regParam=_mean_loss_penalty(c, n_rows),
        standardization=False,
        maxIter=iterations,
    )
    return lr.fit(with_vector(train))


def fit_boosted(train: DataFrame, rounds: int = BOOSTED["rounds"]) -> GBTClassificationModel:
    """Boosted trees with the positives weighted up to balance the classes.

    Every round runs several short jobs over all rows, and each waits for its slowest task: the rows are dealt evenly over
    the cores. Few rows are put into few partitions, as their scheduling would be most of the time.
    """
    context = train.sparkSession.sparkContext
    n_rows, weight = balance(train)
    most = PARTITIONS_A_CORE * context.defaultParallelism
    weighted = with_vector(train.repartition(min(most, 1 + n_rows // PARTITION_ROWS))).withColumn(
        "weight", F.when(F.col("label") == 1, F.lit(float(weight))).otherwise(F.lit(1.0))
    )
    gbt = GBTClassifier(
        maxIter=rounds,
        maxDepth=BOOSTED["depth"],
        stepSize=BOOSTED["step"],
        seed=BOOSTED["seed"],
        weightCol="weight",
    )
    return gbt.fit(weighted)


def raw_scores(model, df: DataFrame) -> DataFrame:
    """Adds ``raw``, the positive class probability."""
    scored = model.transform(with_vector(df))
    return scored.withColumn("raw", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


@dataclass(frozen=True)
class Platt:
    slope: float
    intercept: float

    def column(self, raw: Column) -> Column:
        return 1.0 / (1.0 + F.exp(-(self.slope * raw + self.intercept)))


def fit_platt(scored: DataFrame) -> Platt:
    n_rows = scored.count()
    lr = LogisticRegression(regParam=_mean_loss_penalty(PLATT_C, n_rows), standardization=False)
    fitted = lr.fit(with_vector(scored.select("raw", "label"), ["raw"]))
    return Platt(float(fitted.coefficients[0]), float(fitted.intercept))


# Raw scores are probabilities; a fit on so many equal cells is as fine as a plot of it can be.
ISOTONIC_CELLS = 10_000


def fit_isotonic(scored: DataFrame, cells: int = ISOTONIC_CELLS) -> IsotonicRegressionModel:
    """Monotone fit; scores outside the fitted range take the nearest end.

    The rows are first reduced to the mean score and label of each cell of the score, weighted by their
    number: the pooled points that Spark gathers on the driver are then at most ``cells``.
    """
    cell = F.floor(F.col("raw") * cells)
    points = scored.groupBy(cell.alias("cell")).agg(
        F.avg("raw").alias("raw"), F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("weight")
    )
    regression = IsotonicRegression(
        featuresCol="raw", labelCol="label", predictionCol="calibrated_score", weightCol="weight"
    )
    return regression.fit(points)


@dataclass(frozen=True)
class Bundle:
    """A trained version: model, calibrator and tier boundaries."""

    model: GBTClassificationModel
    platt: Platt
    t_low: float
    t_high: float
    cost_low: float
    cost_high: float

    def score(self, df: DataFrame) -> DataFrame:
        """Adds raw and calibrated score, tier and confidence flag."""
        out = raw_scores(self.model, df).withColumn("calibrated_score", self.platt.column(F.col("raw")))
        score = F.col("calibrated_score")
        return out.withColumns(
            {
                "tier": S.tier(score, self.t_low, self.t_high),
                "low_confidence": S.low_confidence(score, F.lit(self.t_low), F.lit(self.t_high)),
            }
        )


def folds(features: DataFrame, path: str | None = None) -> DataFrame:
    """The modelling table with its fold, written once (at ``path``, if given): every fit and metric reads it."""
    split = sampling.split_folds(features).select("entity_id", *config.FEATURES, "label", "fold")
    if path is None:
        return materialized(split, "folds")
    split.write.mode("overwrite").parquet(path)
    return features.sparkSession.read.schema(split.schema).parquet(path)


def folds_path(root: str, data_version: str) -> str:
    """Where the folds that a version was trained on are kept."""
    return f"{root}/folds/data_version={data_version}"


def fold(table: DataFrame, *names: str) -> DataFrame:
    return table.filter(F.col("fold").isin(*names))


def train_bundle(table: DataFrame, rounds: int = BOOSTED["rounds"]) -> Bundle:
    """Fit on the training fold; calibrate and set the tier boundaries on the calibration fold."""
    model = fit_boosted(fold(table, "train"), rounds)
    calibration = materialized(raw_scores(model, fold(table, "calibration")).select("raw", "label"), "calibration")
    platt = fit_platt(calibration)
    scored = calibration.withColumn("score", platt.column(F.col("raw")))
    cuts = metrics.cascade_thresholds(scored).first()
    return Bundle(model, platt, cuts["t_low"], cuts["t_high"], cuts["cost_low"], cuts["cost_high"])


def evaluate(bundle: Bundle, df: DataFrame) -> DataFrame:
    """Average precision and ROC-AUC of a version on a labelled set, which is scored once."""
    scored = materialized(bundle.score(df).select("label", "calibrated_score"), "evaluated")
    return metrics.ranking_metrics(scored, score="calibrated_score")


def score_versions(bundles: dict[str, Bundle], sliced: DataFrame) -> DataFrame:
    """(version, slice, label, score) of several versions over the same sliced rows."""
    out = None
    for version, bundle in bundles.items():
        part = bundle.score(sliced).select(
            F.lit(version).alias("version"), "slice", "label", F.col("calibrated_score").alias("score")
        )
        out = part if out is None else out.unionByName(part)
    return out


def model_card(table: DataFrame, bundle: Bundle, data_version: str, rounds: int) -> DataFrame:
    """One row: version, thresholds, metrics on the untouched test fold, stage ``none``."""
    test = evaluate(bundle, fold(table, "test"))
    train = as_struct(metrics.class_balance(fold(table, "train"))).scalar()
    now = F.current_timestamp()
    numbers = F.struct(
        F.lit(bundle.t_low).alias("t_low"),
        F.lit(bundle.t_high).alias("t_high"),
        F.lit(bundle.cost_low).alias("cost_low"),
        F.lit(bundle.cost_high).alias("cost_high"),
    )
    settings = F.create_map(
        *[
            F.lit(str(x))
            for pair in {"maxIter": rounds, "maxDepth": BOOSTED["depth"], "stepSize": BOOSTED["step"]}.items()
            for x in pair
        ]
    )
    return test.withColumn("_train", train).select(
        S.version_id(now).alias("version"),
        now.alias("created_at"),
        F.lit(data_version).alias("data_version"),
        settings.alias("hyperparameters"),
        numbers.alias("thresholds"),
        F.struct(
            F.col("average_precision").alias("pr_auc"),
            F.col("roc_auc"),
            F.col("_train.n_rows").alias("n_train"),
            F.col("n_rows").alias("n_final_test"),
            F.col("_train.positive_rate").alias("positive_rate_train"),
        ).alias("metrics"),
        F.lit("none").alias("stage"),
    )


def register(card: DataFrame, bundle: Bundle, root: str) -> str:
    """Saves the model, then its card: a run that breaks off leaves a version without a card."""
    row = materialized(card, "card")
    version = row.first()["version"]
    bundle.model.write().save(f"{root}/models/{version}")
    calibrator = F.struct(F.lit(bundle.platt.slope).alias("slope"), F.lit(bundle.platt.intercept).alias("intercept"))
    row.withColumn("calibrator", calibrator).write.mode("append").parquet(f"{root}/cards")
    return version


def load(spark: SparkSession, root: str, version: str) -> Bundle:
    card = spark.read.parquet(f"{root}/cards").filter(F.col("version") == version).first()
    model = GBTClassificationModel.load(f"{root}/models/{version}")
    t = card["thresholds"]
    platt = Platt(card["calibrator"]["slope"], card["calibrator"]["intercept"])
    return Bundle(model, platt, t["t_low"], t["t_high"], t["cost_low"], t["cost_high"])


def train_and_register(features: DataFrame, root: str, data_version: str, rounds: int) -> str:
    """Split, fit, calibrate, set thresholds, evaluate, register. Promotes nothing."""
    table = folds(features, folds_path(root, data_version))
    bundle = train_bundle(table, rounds)
    return register(model_card(table, bundle, data_version, rounds), bundle, root)


def baseline_metrics(table: DataFrame, boosted: GBTClassificationModel) -> DataFrame:
    """Average precision and ROC-AUC of the rule, both linear models and fitted trees on the holdout."""
    train, test = fold(table, "train"), fold(table, "calibration", "test")
    parts = [
        test.select(F.lit("heuristic").alias("model"), S.heuristic_flag().cast("double").alias("score"), "label")
    ]
    fitted = {
        "linear_l1": fit_linear(train, "l1"),
        "linear_l2": fit_linear(train, "l2"),
        "boosted_trees": boosted,
    }
    for name, model in fitted.items():
        parts.append(raw_scores(model, test).select(F.lit(name).alias("model"), F.col("raw").alias("score"), "label"))
    scores = parts[0]
    for part in parts[1:]:
        scores = scores.unionByName(part)
    return metrics.ranking_metrics(materialized(scores, "baseline_scores"), by=["model"])


def baseline_gaps(report: DataFrame) -> DataFrame:
    """Average precision won from the rule to the best linear model, and from there to the trees."""
    ap = lambda *names: F.max(F.when(F.col("model").isin(*names), F.col("average_precision")))
    best = report.agg(
        ap("heuristic").alias("heuristic_ap"),
        ap("linear_l1", "linear_l2").alias("best_linear_ap"),
        ap("boosted_trees").alias("boosted_ap"),
    )
    return best.select(
        "*",
        (F.col("best_linear_ap") - F.col("heuristic_ap")).alias("heuristic_to_linear"),
        (F.col("boosted_ap") - F.col("best_linear_ap")).alias("linear_to_boosted"),
    )


def importances(spark: SparkSession, model: GBTClassificationModel) -> DataFrame:
    rows = [(name, float(v)) for name, v in zip(config.FEATURES, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"))


