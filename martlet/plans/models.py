"""Customer value, churn and sales forecast models on ``pyspark.ml``.

Feature frames are written once before fitting, since a fit reads them many times; large
ones in equal parts, one for each core, since every pass of a fit waits for its largest.
Fitting and scoring run on the executors; only metrics reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.plans import features
from martlet.session import fresh_path, written
from martlet.sources.mart import Mart

SEED = 42
PART_ROWS = 5000  # fewer rows a core are not worth dealing anew
CLV_FEATURES = [
    "total_orders", "avg_order_value", "customer_lifespan_days", "categories_purchased",
    "days_since_last_order", "order_frequency", "annual_income", "customer_type_encoded",
    "segment_encoded", "age_group_encoded", "country_encoded",
]
CHURN_FEATURES = [
    "total_orders", "total_spent", "avg_order_value", "days_since_last_order",
    "categories_purchased", "order_value_std", "active_months", "order_frequency",
    "avg_monthly_spend", "annual_income", "customer_type_encoded", "segment_encoded",
    "age_group_encoded",
]
FORECAST_FEATURES = [
    "order_count", "avg_order_value", "unique_customers", "day_of_week", "month_number",
    "quarter_number", "is_weekend", "is_holiday", "sales_lag_1", "sales_lag_7", "sales_ma_7",
    "sales_ma_30", "trend", "month_sin", "month_cos",
]


@dataclass
class Trained:
    model: PipelineModel
    metrics: dict[str, float]
    importances: dict[str, float] = field(default_factory=dict)

    def save(self, path: str) -> str:
        self.model.write().overwrite().save(path)
        return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def _numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """Written rows in one equal part for each core, if there are enough of them.

    Files follow the joins before, and readers pack several into one task: a few more
    tasks than cores, or fewer, make every pass of a fit last up to twice as long. Parts
    are sorted, since a forest's draws follow the order of the rows.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if rows.count() < cores * PART_ROWS:
        return rows
    return written(rows.repartition(cores, key).sortWithinPartitions(*rows.columns), "dealt")


def _forest(columns: list[str], label: str, scale: bool, trees: int) -> Pipeline:
    stages = [VectorAssembler(inputCols=columns, outputCol="raw_features")]
    if scale:
        stages.append(
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True)
        )
    stages.append(
        RandomForestRegressor(
            featuresCol="features" if scale else "raw_features", labelCol=label,
            numTrees=trees, maxDepth=10, seed=SEED,
            # Each row's place in each tree is kept, so a level does not walk the trees
            # from their roots again; ten levels are too short a lineage to write down.
            cacheNodeIds=True, checkpointInterval=-1,
        )
    )
    return Pipeline(stages=stages)


def _regression(
    train: DataFrame, test: DataFrame, columns: list[str], label: str, scale: bool, trees: int
) -> Trained:
    model = _forest(columns, label, scale, trees).fit(train)
    scores = features.regression_metrics(model.transform(test), label, "prediction")
    metrics = scores.first().asDict()
    metrics["train_samples"], metrics["test_samples"] = train.count(), test.count()
    weights = model.stages[-1].featureImportances.toArray()
    return Trained(model, metrics, dict(zip(columns, map(float, weights))))


def train_clv(clv: DataFrame, trees: int = 100) -> Trained:
    """Forest that predicts total spend from the other lifetime-value features."""
    rows = _dealt(written(_numbers(clv, [*CLV_FEATURES, "total_spent"]), "clv"), "customer_id")
    train, test = features.random_split(rows, "customer_id")
    return _regression(train, test, CLV_FEATURES, "total_spent", True, trees)


def score_clv(model: PipelineModel | None, clv: DataFrame) -> DataFrame:
    if model is None:
        raise ValueError("the model is not trained; call train_clv first")
    scored = model.transform(_numbers(clv, CLV_FEATURES))
    return scored.withColumnRenamed("prediction", "predicted_clv").drop("raw_features", "features")


def customer_ltv_prediction(
    model: PipelineModel, customer_ids: DataFrame, clv: DataFrame
) -> DataFrame:
    """Predicted value of the given customer ids; NULL for customers without orders."""
    scored = score_clv(model, clv.join(customer_ids, "customer_id", "left_semi"))
    return customer_ids.join(scored.select("customer_id", "predicted_clv"), "customer_id", "left")


def train_churn(churn: DataFrame) -> Trained:
    """Logistic regression with balanced classes."""
    # The label stays whole: its text is part of the draw that splits the rows.
    filled = _numbers(churn, CHURN_FEATURES).na.fill(0.0, CHURN_FEATURES)
    rows = written(filled, "churn")
    train, test = features.stratified_split(rows, "customer_id", "is_churned")
    sizes = {r.is_churned: r.n for r in train.groupBy("is_churned").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    weight = F.lit(0.0)
    for label, n in sizes.items():
        weight = F.when(F.col("is_churned") == label, total / (len(sizes) * n)).otherwise(weight)
    model = Pipeline(
        stages=[
            VectorAssembler(inputCols=CHURN_FEATURES, outputCol="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True),
            LogisticRegression(
                featuresCol="features", labelCol="is_churned", weightCol="weight", regParam=0.01
            ),
        ]
    ).fit(train.withColumn("weight", weight))
    # A fitted regression keeps its training summary and with it the session, which
    # cannot always be shipped to tasks; a loaded one is the bare model.
    model = load(Trained(model, {}).save(fresh_path(rows.sparkSession, "churn-model")))
    scored = model.transform(test)
    metrics = features.confusion_metrics(scored, "is_churned", "prediction").first().asDict()
    metrics["auc_score"] = BinaryClassificationEvaluator(
        labelCol="is_churned", rawPredictionCol="rawPrediction"
    ).evaluate(scored)
    metrics["churn_rate"] = rows.agg(F.avg("is_churned")).first()[0]
    metrics["train_samples"], metrics["test_samples"] = total, test.count()
    return Trained(model, metrics)


def churn_scores(model: PipelineModel, churn: DataFrame) -> DataFrame:
    filled = _numbers(churn, CHURN_FEATURES).na.fill(0.0, CHURN_FEATURES)
    return model.transform(filled).select(
        "customer_id",
        F.col("prediction").cast("int").alias("predicted_churn"),
        vector_to_array("probability")[1].alias("churn_probability"),
    )


def train_forecast(series: DataFrame, trees: int = 100) -> Trained:
    """Forest over the series; the last fifth of the periods is the test."""
    complete = _numbers(series, [*FORECAST_FEATURES, "total_sales"]).na.drop(
        subset=FORECAST_FEATURES
    )
    rows = written(complete, "series")
    train, test = features.ordered_split(rows, "date_period")
    return _regression(train, test, FORECAST_FEATURES, "total_sales", False, trees)


# ---- registered queries ------------------------------------------------------------

def _as_rows(m: Mart, name: str, values: dict[str, float]) -> DataFrame:
    rows = [(name, k, float(v)) for k, v in values.items()]
    return m.spark.createDataFrame(rows, "model string, metric string, value double")


def clv_metrics(m: Mart) -> DataFrame:
    got = train_clv(features.clv_features(m))
    importances = {f"importance_{k}": v for k, v in got.importances.items()}
    return _as_rows(m, "clv", {**got.metrics, **importances})


def clv_scores(m: Mart) -> DataFrame:
    """Predictions for every customer, by a model that was saved and loaded again."""
    clv = written(features.clv_features(m), "clv-features")
    path = train_clv(clv, trees=20).save(fresh_path(m.spark, "clv-model"))
    return score_clv(load(path), clv).select("customer_id", "total_spent", "predicted_clv")


def reloaded_model(m: Mart) -> DataFrame:
    """A saved and reloaded model predicts what the fitted one did."""
    clv = written(features.clv_features(m), "clv-features")
    got = train_clv(clv, trees=5)
    again = load(got.save(fresh_path(m.spark, "clv-model")))
    first = score_clv(got.model, clv).select("customer_id", F.col("predicted_clv").alias("a"))
    second = score_clv(again, clv).select("customer_id", F.col("predicted_clv").alias("b"))
    return first.join(second, "customer_id").agg(
        F.count(F.lit(1)).alias("n_customers"), F.count_if(F.col("a") != F.col("b")).alias("n_differ")
    )


def churn_metrics(m: Mart) -> DataFrame:
    return _as_rows(m, "churn", train_churn(features.churn_features(m)).metrics)


def forecast_metrics(m: Mart) -> DataFrame:
    got = train_forecast(features.sales_time_series(m, "daily"))
    return _as_rows(m, "forecast", got.metrics)


def ltv_by_id(m: Mart) -> DataFrame:
    """Predicted value of every customer id in the customer table."""
    clv = written(features.clv_features(m), "clv-features")
    model = train_clv(clv, trees=20).model
    return customer_ltv_prediction(model, m.customers.select("customer_id"), clv)


ALL = {
    "l07_clv_metrics": clv_metrics,
    "l08_clv_scores": clv_scores,
    "l09_churn_metrics": churn_metrics,
    "l10_forecast_metrics": forecast_metrics,
    "l12_reloaded_model": reloaded_model,
    "u02_ltv_by_id": ltv_by_id,
}
