"""What must hold of a trained model whatever the fit: rows per side, metrics that can
be computed again from the scored rows, predictions in their range, and an error below
that of a plain rule. Facts are numbers; a check is 1 if it holds."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.plans import features, models
from martlet.session import fresh_path, written
from martlet.sources.mart import Mart

NEAR = 1e-9


def _facts(m: Mart, model: str, facts: dict[str, int | bool]) -> DataFrame:
    rows = [(model, name, int(value)) for name, value in facts.items()]
    return m.spark.createDataFrame(rows, "model string, fact string, value bigint")


def _agree(a: float, b: float) -> bool:
    return math.isclose(a, b, rel_tol=NEAR, abs_tol=NEAR)


def _squares(y: Column, p: Column) -> Column:
    return F.sum((y - p) * (y - p))


def _regression_facts(
    trained: models.Trained, train: DataFrame, test: DataFrame, label: str, rule: Column
) -> dict[str, int | bool]:
    """Facts of a forest; ``rule`` is the plain prediction it has to beat on the test rows."""
    y, p = F.col(label), F.col("prediction")
    learned = train.agg(
        F.count(F.lit(1)).alias("n"), F.min(y).alias("low"), F.max(y).alias("high")
    ).first()
    scored = trained.model.transform(test).agg(
        F.count(F.lit(1)).alias("n"),
        _squares(y, p).alias("sse"),
        _squares(y, rule).alias("rule_sse"),
        F.var_pop(y).alias("variance"),
        F.min(p).alias("low"),
        F.max(p).alias("high"),
    ).first()
    got, slack = trained.metrics, 1e-6 * max(abs(learned.low), abs(learned.high), 1.0)
    return {
        "train_rows": learned.n,
        "test_rows": scored.n,
        "reported_rows_agree": (got["train_samples"], got["test_samples"]) == (learned.n, scored.n),
        "mse_agrees": _agree(got["mse"], scored.sse / scored.n),
        "r2_agrees": _agree(got["r2_score"], 1 - scored.sse / (scored.variance * scored.n)),
        # A forest's prediction is a mean of labels it has learned from.
        "predictions_in_range": learned.low - slack <= scored.low and scored.high <= learned.high + slack,
        "importances_sum_to_one": _agree(sum(trained.importances.values()), 1.0),
        "better_than_rule": scored.sse < scored.rule_sse,
    }


def clv_checks(m: Mart) -> DataFrame:
    """The value forest; its rule is the mean of the training rows."""
    columns = [*models.CLV_FEATURES, "total_spent"]
    rows = written(models._numbers(features.clv_features(m), columns), "clv-checked")
    train, test = features.random_split(rows, "customer_id")
    mean = F.lit(train.agg(F.avg("total_spent")).first()[0])
    got = models.train_clv(rows, trees=20)
    return _facts(m, "clv", _regression_facts(got, train, test, "total_spent", mean))


def score_checks(m: Mart) -> DataFrame:
    """Scores of a saved and loaded forest: every customer with orders once, in range."""
    clv = written(features.clv_features(m), "clv-scored")
    spent = clv.agg(F.min("total_spent").alias("low"), F.max("total_spent").alias("high")).first()
    p, slack = F.col("predicted_clv"), 1e-6 * max(abs(spent.high), 1.0)
    inside = p.between(spent.low - slack, spent.high + slack)
    path = models.train_clv(clv, trees=20).save(fresh_path(m.spark, "clv-model"))
    scored = models.score_clv(models.load(path), clv).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.coalesce(inside, F.lit(False))).alias("inside")
    )
    got = scored.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("n") > 1).alias("scored_twice"),
        F.count_if(~F.col("inside")).alias("out_of_range"),
    )
    return _facts(m, "clv", got.first().asDict())


def churn_checks(m: Mart) -> DataFrame:
    """The churn regression; its rule is the one of ``rule_churn_metrics``."""
    rows = written(features.churn_features(m), "churn-checked")
    got = models.train_churn(rows)
    train, test = features.stratified_split(rows, "customer_id", "is_churned")
    scored = written(
        models.churn_scores(got.model, test).join(
            test.select("customer_id", "is_churned", "total_orders"), "customer_id"
        ).withColumn("rule", F.when(F.col("total_orders") < 10, 1).otherwise(0)),
        "churn-scored",
    )
    again = features.confusion_metrics(scored, "is_churned", "predicted_churn").first().asDict()
    rule = features.confusion_metrics(scored, "is_churned", "rule").first().asDict()
    odd = scored.agg(
        F.count_if(~F.col("churn_probability").between(0, 1)).alias("outside"),
        F.count_if((F.col("churn_probability") > 0.5) != (F.col("predicted_churn") == 1)).alias("off"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    n_train = train.count()
    reported = (got.metrics["train_samples"], got.metrics["test_samples"])
    return _facts(
        m,
        "churn",
        {
            "train_rows": n_train,
            "test_rows": odd.n,
            "reported_rows_agree": reported == (n_train, odd.n),
            "metrics_agree": all(got.metrics[k] == v for k, v in again.items()),
            "probabilities_outside": odd.outside,
            "labels_off_probability": odd.off,
            "better_than_chance": got.metrics["auc_score"] > 0.5,
            "better_than_rule": (again["f1_score"] or 0.0) > (rule["f1_score"] or 0.0),
        },
    )


def forecast_checks(m: Mart) -> DataFrame:
    """The sales forest; its rule foretells a day by last week's mean."""
    series = features.sales_time_series(m, "daily")
    columns = [*models.FORECAST_FEATURES, "total_sales"]
    rows = written(
        models._numbers(series, columns).na.drop(subset=models.FORECAST_FEATURES), "series-checked"
    )
    train, test = features.ordered_split(rows, "date_period")
    got = models.train_forecast(series, trees=20)
    return _facts(
        m, "forecast", _regression_facts(got, train, test, "total_sales", F.col("sales_ma_7"))
    )


def ltv_checks(m: Mart) -> DataFrame:
    """Predicted values of all customer ids: one row each, NULL just without orders."""
    got = models.ltv_by_id(m).join(
        m.lines.join(m.orders, "order_id").select("customer_id").distinct().withColumn(
            "buys", F.lit(True)
        ),
        "customer_id",
        "left",
    ).agg(
        F.count(F.lit(1)).alias("customers"),
        F.count("predicted_clv").alias("predicted"),
        F.count_if(F.col("buys").isNotNull() != F.col("predicted_clv").isNotNull()).alias("off"),
    )
    return _facts(m, "ltv", got.first().asDict())


ALL = {
    "l07_clv_checks": clv_checks,
    "l08_score_checks": score_checks,
    "l09_churn_checks": churn_checks,
    "l10_forecast_checks": forecast_checks,
    "u02_ltv_checks": ltv_checks,
}
