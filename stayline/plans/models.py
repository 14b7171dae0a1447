"""Supervised score, additive attributions, segments and monitoring."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.plans import rules
from stayline.plans.scoring import top_names
from stayline.reference_data import SEGMENT_NAMES

# Inputs of the model. The label is a function of the service gap and the policy expiry, so these two and
# the scores built on the gap are left out.
INPUTS = [
    "vehicle_age_years",
    "financed",
    "total_service_visits",
    "avg_bill_amount",
    "pct_paid_services",
    "cancelled_visit_flag",
    "num_policy_renewals",
    "auto_membership_flag",
    "premium_trend",
    "frequency_score",
    "monetary_score",
]
# Least mean attribution that keeps an input, allowed loss of AUC before retraining.
LEAST_IMPORTANCE = 0.01
AUC_TOLERANCE = 0.05


@dataclass
class Fitted:
    """A trained model with its inputs and their means over the training rows."""

    model: object
    inputs: list[str]
    means: dict[str, float]

    @property
    def is_linear(self) -> bool:
        return hasattr(self.model, "coefficients")


def prepare(features: DataFrame) -> DataFrame:
    """Numeric inputs, the label, and a split that depends on the token only: 80 % train."""
    bucket = F.pmod(F.xxhash64("cust_id", F.lit(42)), F.lit(100))
    return features.withColumns(
        {
            "financed": F.when(F.col("finance_flag") == "Y", 1.0).otherwise(0.0),
            "label": F.col("churn_label").cast("double"),
            "is_train": bucket < 80,
        }
    )


def with_class_weight(train: DataFrame) -> DataFrame:
    """Weight rows by the inverse share of their class, in place of synthetic rows."""
    shares = train.groupBy("label").agg(F.count("*").alias("_n"))
    weights = shares.withColumn(
        "weight", F.sum("_n").over(Window.partitionBy(F.lit(0))) / (F.lit(2.0) * F.col("_n"))
    ).drop("_n")
    return train.join(F.broadcast(weights), "label")


def fit(features: DataFrame, inputs: list[str] | None = None, kind: str = "logistic") -> Fitted:
    """Train on the training split; ``kind`` is logistic (default) or trees."""
    inputs = list(inputs or INPUTS)
    train = with_class_weight(prepare(features).where("is_train"))
    assembled = VectorAssembler(inputCols=inputs, outputCol="features").transform(train)
    columns = {"featuresCol": "features", "labelCol": "label", "weightCol": "weight"}
    learner = (
        LogisticRegression(maxIter=50, regParam=0.01, **columns)
        if kind == "logistic"
        else GBTClassifier(maxIter=20, maxDepth=4, seed=42, **columns)
    )
    means = train.agg(*[F.avg(c).alias(c) for c in inputs]).first().asDict()
    model = learner.fit(assembled)
    if kind == "logistic":
        # The training summary holds the session, which no task can take along once something was observed in it.
        model._java_obj.setSummary(features.sparkSession._jvm.scala.Option.empty())
    return Fitted(model, inputs, means)


def score(fitted: Fitted, features: DataFrame) -> DataFrame:
    """Feature rows with ``churn_probability`` and the tier of the score."""
    rows = VectorAssembler(inputCols=fitted.inputs, outputCol="features").transform(prepare(features))
    scored = fitted.model.transform(rows)
    return scored.withColumn("churn_probability", F.round(vector_to_array("probability")[1], 4)).withColumn(
        "score_tier", rules.score_tier(F.col("churn_probability"))
    )


def evaluate(scored: DataFrame, threshold: float = 0.5) -> dict[str, float]:
    """AUC, precision, recall and F1 on the test split."""
    test = scored.where("NOT is_train")
    auc = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction").evaluate(test)
    said, is_churn = F.col("churn_probability") >= threshold, F.col("label") == 1
    c = test.agg(
        F.count_if(said & is_churn).alias("tp"),
        F.count_if(said & ~is_churn).alias("fp"),
        F.count_if(~said & is_churn).alias("fn"),
    ).first()
    precision = c.tp / (c.tp + c.fp) if c.tp + c.fp else 0.0
    recall = c.tp / (c.tp + c.fn) if c.tp + c.fn else 0.0
    f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
    return {"auc": auc, "precision": precision, "recall": recall, "f1": f1}


def metrics(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``evaluate`` as a table of one row, with the AUC from counts per score value of four decimals."""
    test = scored.where("NOT is_train").select(F.col("label").cast("int").alias("churn_label"), "churn_probability")
    said, is_churn = F.col("churn_probability") >= threshold, F.col("churn_label") == 1
    counts = test.agg(
        F.count_if(said & is_churn).alias("tp"), F.count_if(said & ~is_churn).alias("fp"), F.count_if(~said & is_churn).alias("fn")
    )
    auc = auc_by_period(test.withColumn("split", F.lit("test")), "split").select("customers", "churned", "auc")
    rate = lambda a, b: F.round(F.coalesce(F.try_divide(a, b), F.lit(0.0)), 6)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return auc.join(counts, F.lit(True)).select(
        "customers", "churned", "auc", rate(tp, tp + fp).alias("precision"), rate(tp, tp + fn).alias("recall"), rate(2 * tp, 2 * tp + fp + fn).alias("f1")
    )


def attributions(fitted: Fitted) -> dict[str, Column]:
    """Exact additive attribution of a linear model: weight times distance from the mean."""
    if not fitted.is_linear:
        raise ValueError("attributions are defined for the logistic model")
    weights = fitted.model.coefficients.toArray()
    return {c: F.lit(float(b)) * (F.col(c) - F.lit(fitted.means[c])) for c, b in zip(fitted.inputs, weights)}


def with_drivers(fitted: Fitted, scored: DataFrame, n: int = 3) -> DataFrame:
    """Add the ``n`` inputs with the largest absolute attribution."""
    sizes = {c: F.abs(a) for c, a in attributions(fitted).items()}
    return scored.withColumn("_top", top_names(sizes, n)).select(
        *scored.columns, *[F.col("_top")[i].alias(f"top_driver_{i + 1}") for i in range(n)]
    )


def importances(fitted: Fitted, scored: DataFrame) -> dict[str, float]:
    """Mean absolute attribution per input."""
    return scored.agg(*[F.avg(F.abs(a)).alias(c) for c, a in attributions(fitted).items()]).first().asDict()


def prune(fitted: Fitted, features: DataFrame, least: float = LEAST_IMPORTANCE) -> Fitted:
    """Refit without the inputs whose mean attribution is too small."""
    kept = [c for c, v in importances(fitted, prepare(features)).items() if v > least]
    return fitted if len(kept) == len(fitted.inputs) or not kept else fit(features, kept)


def segments(features: DataFrame, k: int = 4, seed: int = 42) -> DataFrame:
    """K-means on the R, F, M scores; clusters are named by the rank of their centre's sum.

    The scores have 125 combinations at most. The model is fitted on these in one order, weighted by their number of rows,
    so it doesn't depend on how the rows are spread.
    """
    scores = ["recency_score", "frequency_score", "monetary_score"]
    counted = features.groupBy(*scores).agg(F.count("*").cast("double").alias("n")).coalesce(1).sortWithinPartitions(*scores)
    rows = VectorAssembler(inputCols=scores, outputCol="rfm").transform(counted)
    model = KMeans(k=k, seed=seed, featuresCol="rfm", predictionCol="cluster", weightCol="n").fit(rows)
    best_first = sorted(range(k), key=lambda i: -sum(model.clusterCenters()[i]))
    names = {cluster: SEGMENT_NAMES[min(rank, len(SEGMENT_NAMES) - 1)] for rank, cluster in enumerate(best_first)}
    name = reduce(lambda acc, kv: acc.when(F.col("cluster") == kv[0], kv[1]), names.items(), F)
    return features.join(model.transform(rows).select(*scores, name.alias("segment")), scores)


def auc_by_period(scored: DataFrame, period: str, probability: str = "churn_probability") -> DataFrame:
    """AUC per period from counts per score value.

    Scores have four decimals, so a period has at most 10,001 values; only these counts meet in a window.
    Pairs with equal scores count one half.
    """
    lower = Window.partitionBy(period).orderBy(probability).rowsBetween(Window.unboundedPreceding, -1)
    counts = scored.groupBy(period, probability).agg(
        F.count_if(F.col("churn_label") == 1).alias("pos"), F.count_if(F.col("churn_label") == 0).alias("neg")
    )
    below = F.coalesce(F.sum("neg").over(lower), F.lit(0))
    won = counts.withColumn("won", F.col("pos") * (below + F.col("neg") / 2.0))
    return won.groupBy(period).agg(
        F.sum(F.col("pos") + F.col("neg")).alias("customers"),
        F.sum("pos").alias("churned"),
        F.round(F.try_divide(F.sum("won"), F.sum("pos").cast("double") * F.sum("neg")), 6).alias("auc"),
    )


def drift_gate(scored: DataFrame, period: str, tolerance: float = AUC_TOLERANCE) -> DataFrame:
    """Periods against the first with an AUC: ``retrain`` is 1 where the AUC fell by more than the tolerance."""
    by_period = auc_by_period(scored, period)
    first = by_period.where(F.col("auc").isNotNull()).agg(F.min_by("auc", period).alias("b")).scalar()
    return by_period.withColumn("baseline_auc", first).withColumn(
        "retrain", F.when(F.col("auc") < F.col("baseline_auc") * (1.0 - tolerance), 1).otherwise(0)
    )


def stability_index(scored: DataFrame, period: str, value: str = "churn_probability", bins: int = 10) -> DataFrame:
    """Population stability of each period against the first, in bins of the first period's quantiles.

    Values are taken to four decimals, so the running count is over 10,001 of them at most. Bin limits are at most
    ``bins`` numbers. An empty share counts as 0.0001.
    """
    counts = scored.withColumn(value, F.round(value, 4)).groupBy(period, value).agg(F.count("*").alias("n"))
    first = scored.agg(F.min(period).alias("p")).scalar()
    upto = Window.partitionBy(F.lit(0)).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(F.lit(0))
    base = counts.where(F.col(period) == first).withColumn(
        "bin", F.ceil(F.sum("n").over(upto) * bins / F.sum("n").over(whole))
    )
    limits = (
        base.groupBy("bin")
        .agg(F.max(value).alias("limit"))
        .where(F.col("bin") < bins)
        .agg(F.sort_array(F.collect_list("limit")).alias("l"))
        .scalar()
    )
    binned = (
        counts.withColumn("limits", limits)
        .withColumn("bin", F.size(F.filter("limits", lambda x: x < F.col(value))))
        .groupBy(period, "bin")
        .agg(F.sum("n").alias("n"))
    )
    share = F.greatest(F.col("n") / F.sum("n").over(Window.partitionBy(period)), F.lit(0.0001))
    shares = binned.withColumn("share", share).groupBy(period).pivot("bin", list(range(bins))).agg(F.max("share"))
    filled = shares.select(period, *[F.coalesce(F.col(str(b)), F.lit(0.0001)).alias(f"s{b}") for b in range(bins)])
    expected = {b: F.min_by(f"s{b}", period).over(whole) for b in range(bins)}
    terms = [(F.col(f"s{b}") - expected[b]) * F.log(F.col(f"s{b}") / expected[b]) for b in range(bins)]
    return filled.select(period, F.round(reduce(lambda a, b: a + b, terms), 6).alias("psi"))
