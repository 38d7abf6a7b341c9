"""Model features and evaluation, as plain DataFrame plans."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions.dates import day, years_between
from martlet.functions.draws import draw
from martlet.functions.money import mean_amount, ratio
from martlet.operators import quantiles
from martlet.operators.keys import number_rows
from martlet.operators.series import full_window_sum, lag_of, ordinal
from martlet.plans import calendar
from martlet.plans.views import add_up, money
from martlet.session import written
from martlet.sources.mart import Mart, line_totals


NO_LABEL = "Unknown"


def numbered_labels(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, label, code``: alphabetical codes 0, 1, ... of each column's values.

    NULL counts as 'Unknown'. One pass finds the distinct labels of all columns; they
    are numbered by range, so neither a column with very many labels nor a hot label
    ends in one array or task. Each code is the place less the column's first place.
    """
    values = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.coalesce(F.col(c).cast("string"), F.lit(NO_LABEL)).alias("label"),
                )
                for c in columns
            ]
        )
    )
    distinct = written(df.select(values.alias("v")).select("v.*").distinct(), "labels")
    placed = number_rows(distinct, ["column", "label"], 0, "place")
    first = placed.groupBy("column").agg(F.min("place").alias("first"))
    return placed.join(first, "column").select(
        "column", "label", (F.col("place") - F.col("first")).alias("code")
    )


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """Alphabetical codes 0, 1, ... of a categorical column's values."""
    return numbered_labels(df, [column]).select("label", "code")


def encode(df: DataFrame, source: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add the label code of each column under a new name; a label that ``source``
    does not hold gets NULL.

    The codes are joined: by broadcast while they are few, else by label, where
    adaptive execution splits the hot ones.
    """
    codes = written(numbered_labels(source, list(columns)), "label-codes")
    for column, name in columns.items():
        one = codes.filter(F.col("column") == column).select(
            F.col("label").alias("_label"), F.col("code").alias(name)
        )
        label = F.coalesce(F.col(column).cast("string"), F.lit(NO_LABEL))
        df = df.join(one, label == F.col("_label"), "left").drop("_label")
    return df


def _profile(m: Mart) -> DataFrame:
    age = years_between("birth_date", day(m.as_of))
    group = F.when(age < 25, "18-24").when(age < 35, "25-34").when(age < 45, "35-44")
    return m.customer_dim.select(
        "customer_id",
        "customer_type",
        "segment_name",
        F.when(F.col("customer_id") % 20 != 9, F.col("annual_income")).alias("annual_income"),
        group.otherwise("45+").alias("age_group"),
        "billing_country",
    )


def _categories(m: Mart) -> DataFrame:
    """Distinct product categories per customer.

    Names are joined last, so that the lines are shuffled to their orders without them.
    """
    return (
        m.items.select("order_id", "product_key")
        .join(m.orders.select("order_id", "customer_id"), "order_id")
        .join(m.products.select("product_key", "category_name"), "product_key")
        .select("customer_id", "category_name")
        .distinct()
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("categories_purchased"))
    )


def _purchases(m: Mart) -> DataFrame:
    """Measures, orders, active months and the spread of line totals per customer."""
    per_order = m.lines.groupBy("order_id").agg(
        *line_totals(),
        F.sum(square("line_c")).alias("square_c"),
    )
    months = (
        per_order.join(m.orders, "order_id")
        .groupBy("customer_id", F.trunc("order_date", "month").alias("month"))
        .agg(
            *add_up("square_c"),
            F.count(F.lit(1)).alias("n_orders"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
    )
    return months.groupBy("customer_id").agg(
        *add_up("square_c", "n_orders"),
        F.count(F.lit(1)).alias("active_months"),
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
    )


def clv_features(m: Mart) -> DataFrame:
    """Lifetime-value features of every customer with at least one order."""
    profile = _profile(m)
    # One row per customer, written once: the median reads it several times, and
    # must not run the joins over the lines again each time. It holds no other measures:
    # what is written is computed, whether it is read or not.
    spent = _purchases(m).select(
        "customer_id", "revenue_c", "n_lines", "n_orders", "first_order_date", "last_order_date"
    )
    base = written(
        spent.join(_categories(m), "customer_id").join(profile, "customer_id"), "clv-base"
    )
    lifespan = F.datediff("last_order_date", "first_order_date")
    out = base.select(
        "customer_id",
        "customer_type",
        "segment_name",
        F.coalesce(F.col("annual_income").cast("double"), quantiles.median(base, "annual_income"))
        .alias("annual_income"),
        "age_group",
        "billing_country",
        F.col("n_orders").alias("total_orders"),
        money("revenue_c", "total_spent"),
        mean_amount("revenue_c", "n_lines").alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
        lifespan.alias("customer_lifespan_days"),
        "categories_purchased",
        F.datediff(day(m.as_of), "last_order_date").alias("days_since_last_order"),
        ratio("n_orders", lifespan + 1, 6).alias("order_frequency"),
    )
    return encode(
        out,
        profile,
        {
            "customer_type": "customer_type_encoded",
            "segment_name": "segment_encoded",
            "age_group": "age_group_encoded",
            "billing_country": "country_encoded",
        },
    )


def square(column: str) -> Column:
    return F.col(column).cast("double") * F.col(column).cast("double")


def sample_deviation(square_sum, total, n) -> Column:
    """Sample standard deviation in currency from sums of cents; 0 for one row.

    Squares are summed as doubles: fifteen digits, where the result shows nine.
    """
    mean_part = F.col(total).cast("double") * F.col(total).cast("double") / F.col(n)
    spread = F.greatest(F.col(square_sum) - mean_part, F.lit(0.0))
    return F.when(F.col(n) > 1, F.sqrt(spread / (F.col(n) - 1)) / 100).otherwise(0.0)


def churn_features(m: Mart, threshold: int = 90) -> DataFrame:
    """Churn features; the label is recency beyond the threshold, and recency is also
    a feature, so the label can be read off it."""
    profile = _profile(m)
    recency = F.datediff(day(m.as_of), "last_order_date")
    base = _purchases(m).join(_categories(m), "customer_id").join(profile, "customer_id")
    out = base.select(
        "customer_id",
        "customer_type",
        "segment_name",
        "annual_income",
        "age_group",
        F.col("n_orders").alias("total_orders"),
        money("revenue_c", "total_spent"),
        mean_amount("revenue_c", "n_lines").alias("avg_order_value"),
        recency.alias("days_since_last_order"),
        "categories_purchased",
        F.round(sample_deviation("square_c", "revenue_c", "n_lines"), 4).alias("order_value_std"),
        "active_months",
        F.when(recency > threshold, 1).otherwise(0).alias("is_churned"),
        ratio("n_orders", "active_months", 4).alias("order_frequency"),
        mean_amount("revenue_c", "active_months").alias("avg_monthly_spend"),
    )
    return encode(
        out,
        profile,
        {
            "customer_type": "customer_type_encoded",
            "segment_name": "segment_encoded",
            "age_group": "age_group_encoded",
        },
    )


def sales_time_series(m: Mart, granularity: str = "daily") -> DataFrame:
    """Sales per day, week or month with lags, rolling means, trend and season.

    Customers are made distinct per period before counting. The windows run over one
    row per period.
    """
    d = F.col("order_date")
    periods = {"daily": d, "weekly": F.trunc(d, "week"), "monthly": F.trunc(d, "month")}
    if granularity not in periods:
        raise ValueError("granularity must be 'daily', 'weekly' or 'monthly'")
    per_period = (
        m.order_sales()
        .groupBy(periods[granularity].alias("date_actual"), "customer_id")
        .agg(*add_up(), F.count(F.lit(1)).alias("n_orders"))
        .groupBy("date_actual")
        .agg(*add_up("n_orders"), F.count(F.lit(1)).alias("unique_customers"))
    )
    flags = calendar.describe(per_period.select("date_actual")).select(
        "date_actual", "day_of_week", "month_number", "quarter_number", "is_weekend", "is_holiday"
    )
    series = per_period.join(flags, "date_actual").withColumnRenamed("date_actual", "date_period")
    angle = F.col("month_number") * (2 * math.pi / 12)
    at = "date_period"
    return series.select(
        at,
        money("revenue_c", "total_sales"),
        F.col("n_orders").alias("order_count"),
        mean_amount("revenue_c", "n_lines").alias("avg_order_value"),
        "unique_customers", "day_of_week", "month_number", "quarter_number", "is_weekend",
        "is_holiday",
        (lag_of("revenue_c", 1, at) / 100.0).alias("sales_lag_1"),
        (lag_of("revenue_c", 7, at) / 100.0).alias("sales_lag_7"),
        mean_amount(full_window_sum("revenue_c", 7, at), F.lit(7)).alias("sales_ma_7"),
        mean_amount(full_window_sum("revenue_c", 30, at), F.lit(30)).alias("sales_ma_30"),
        ordinal(at).alias("trend"),
        (F.round(F.sin(angle), 6) + 0.0).alias("month_sin"),
        (F.round(F.cos(angle), 6) + 0.0).alias("month_cos"),
    )


def scaled(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns moved to mean 0 and population deviation 1."""
    stats = df.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}_std") for c in columns],
    )
    return df.withColumns(
        {
            c: (F.col(c) - stats.select(f"{c}_mean").scalar())
            / F.nullif(stats.select(f"{c}_std").scalar(), F.lit(0.0))
            for c in columns
        }
    )


def scaled_income(m: Mart) -> DataFrame:
    return scaled(
        m.customer_dim.select("customer_id", F.col("annual_income").cast("double").alias("income")),
        ["income"],
    ).select("customer_id", F.round("income", 6).alias("income"))


# ---- splits -------------------------------------------------------------------------

TRAIN_SHARE = 0.8


def random_split(df: DataFrame, key: str, salt: str = "split-42") -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: a row keeps its side for good."""
    train = draw(salt, key) < TRAIN_SHARE
    return df.filter(train), df.filter(~train)


def stratified_split(
    df: DataFrame, key: str, label: str, salt: str = "split-42"
) -> tuple[DataFrame, DataFrame]:
    """Split each label on its own draw, so both sides keep the label's share."""
    train = draw(salt, key, label) < TRAIN_SHARE
    return df.filter(train), df.filter(~train)


def ordered_split(df: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """First 80 percent of the periods for training, the rest for testing."""
    placed = df.withColumn("_place", ordinal(order))
    cut = F.floor(placed.agg(F.count(F.lit(1))).scalar() * 0.8)
    return (
        placed.filter(F.col("_place") < cut).drop("_place"),
        placed.filter(F.col("_place") >= cut).drop("_place"),
    )


def _sides(train: DataFrame, test: DataFrame) -> DataFrame:
    return train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test"))
    )


def split_customers(m: Mart) -> DataFrame:
    return _sides(*random_split(m.customers.select("customer_id"), "customer_id"))


def split_by_label(m: Mart) -> DataFrame:
    """Size of both sides per churn label."""
    labels = m.orders.groupBy("customer_id").agg(F.max("order_date").alias("d")).select(
        "customer_id",
        F.when(F.datediff(day(m.as_of), "d") > 90, 1).otherwise(0).alias("is_churned"),
    )
    both = _sides(*stratified_split(labels, "customer_id", "is_churned"))
    return both.groupBy("is_churned", "side").agg(F.count(F.lit(1)).alias("n"))


def split_by_time(m: Mart) -> DataFrame:
    days = m.orders.groupBy("order_date").agg(F.count(F.lit(1)).alias("n_orders"))
    return _sides(*ordered_split(days, "order_date"))


# ---- metrics ----------------------------------------------------------------------

def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Mean squared error, r squared and mean absolute percentage error."""
    y, p = F.col(label), F.col(prediction)
    sums = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((y - p) * (y - p)).alias("sse"),
        F.var_pop(y).alias("variance"),
        F.avg(F.abs((y - p) / F.nullif(y, F.lit(0.0)))).alias("ape"),
    )
    return sums.select(
        (F.col("sse") / F.col("n")).alias("mse"),
        (1 - F.col("sse") / (F.col("variance") * F.col("n"))).alias("r2_score"),
        (F.col("ape") * 100).alias("mape"),
    )


def confusion_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy, precision, recall and F1 of a 0/1 prediction, and the label rate."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        ratio(F.col("n") - fp - fn, "n", 6).alias("accuracy"),
        ratio(tp, tp + fp, 6).alias("precision"),
        ratio(tp, tp + fn, 6).alias("recall"),
        ratio(tp * 2, tp * 2 + fp + fn, 6).alias("f1_score"),
        ratio(tp + fn, "n", 6).alias("label_rate"),
    )


def naive_forecast_metrics(m: Mart) -> DataFrame:
    """How well last week's mean foretells a day."""
    series = sales_time_series(m, "daily").filter("sales_ma_7 IS NOT NULL")
    got = regression_metrics(series, "total_sales", "sales_ma_7")
    return got.select(
        F.round(F.col("mse") / 1e6, 3).alias("mse_millions"),
        F.round("r2_score", 6).alias("r2_score"),
        F.round("mape", 6).alias("mape"),
    )


def rule_churn_metrics(m: Mart) -> DataFrame:
    """How well 'fewer than ten orders' tells churned customers."""
    per_customer = m.orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("order_date").alias("d")
    )
    judged = per_customer.select(
        F.when(F.datediff(day(m.as_of), "d") > 90, 1).otherwise(0).alias("is_churned"),
        F.when(F.col("n") < 10, 1).otherwise(0).alias("prediction"),
    )
    return confusion_metrics(judged, "is_churned", "prediction")


def segment_codes(m: Mart) -> DataFrame:
    return label_codes(m.customer_dim, "segment_name")


ALL = {
    "l01_clv_features": clv_features,
    "l02_churn_features": churn_features,
    "l03_daily_series": lambda m: sales_time_series(m, "daily"),
    "l03_weekly_series": lambda m: sales_time_series(m, "weekly"),
    "l03_monthly_series": lambda m: sales_time_series(m, "monthly"),
    "l04_segment_codes": segment_codes,
    "l05_scaled_income": scaled_income,
    "l06_split_customers": split_customers,
    "l06_split_by_label": split_by_label,
    "l06_split_by_time": split_by_time,
    "l11_naive_forecast_metrics": naive_forecast_metrics,
    "l11_rule_churn_metrics": rule_churn_metrics,
}
