"""Extract, clean, load: raw staging to clean staging to dimensions."""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import date, datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from martlet import schemas
from martlet.functions.text import clean, code, digits, is_email, to_type
from martlet.operators import scd2
from martlet.sources.tables import Tables

log = logging.getLogger(__name__)

CUSTOMER_TYPES = ("INDIVIDUAL", "BUSINESS")


class Cleaned(NamedTuple):
    """All rows with their verdict; the valid ones and the others as filters on it."""

    judged: DataFrame

    @property
    def valid(self) -> DataFrame:
        return self.judged.filter(F.col("validation_status") == "VALID").drop("reject_reason")

    @property
    def rejected(self) -> DataFrame:
        return self.judged.filter(F.col("validation_status") == "REJECTED")


def _judge(typed: DataFrame, rules: list[tuple[Column, str]]) -> Cleaned:
    """Rules see the cleaned columns; a rule that is not true rejects the row and the
    first one that fails is the reason."""
    reason = F.when(F.lit(False), "")
    for ok, why in rules:
        reason = reason.when(~F.coalesce(ok, F.lit(False)), why)
    return Cleaned(
        typed.withColumn("reject_reason", reason).withColumn(
            "validation_status",
            F.when(F.col("reject_reason").isNull(), "VALID").otherwise("REJECTED"),
        )
    )


def transform_customers(raw: DataFrame, types: tuple[str, ...] = CUSTOMER_TYPES) -> Cleaned:
    typed = raw.select(
        code("customer_number").alias("customer_number"),
        code("customer_type").alias("customer_type"),
        *[clean(c).alias(c) for c in ("company_name", "first_name", "last_name")],
        F.lower(clean("email")).alias("email"),
        digits("phone").alias("phone"),
        to_type("birth_date", "date").alias("birth_date"),
        F.upper("gender").alias("gender"),
        to_type("annual_income", "decimal(15,2)").alias("annual_income"),
        *[
            clean(c).alias(c)
            for c in ("address_line_1", "address_line_2", "city", "state_province", "postal_code")
        ],
        code("country").alias("country"),
        to_type("registration_date", "date").alias("registration_date"),
        F.col("file_name").alias("source_file"),
    )
    return _judge(
        typed,
        [
            (F.col("customer_number").isNotNull(), "customer number is missing"),
            (F.col("customer_type").isin(*types), "customer type is unknown"),
            (is_email("email"), "e-mail is not valid"),
        ],
    )


def transform_products(raw: DataFrame) -> Cleaned:
    flag = F.upper("discontinued")
    typed = raw.select(
        code("product_number").alias("product_number"),
        *[clean(c).alias(c) for c in ("product_name", "category_name", "supplier_name")],
        "description",
        code("color").alias("color"),
        code("size").alias("size"),
        to_type("weight", "decimal(8,2)").alias("weight"),
        *[to_type(c, "decimal(10,2)").alias(c) for c in ("unit_price", "cost", "list_price")],
        F.coalesce(flag == "TRUE", F.lit(False)).alias("discontinued"),
        F.col("file_name").alias("source_file"),
    )
    return _judge(
        typed,
        [
            (F.col("product_number").isNotNull(), "product number is missing"),
            (F.col("product_name").isNotNull(), "product name is missing"),
            (F.col("unit_price") > 0, "unit price is not positive"),
            (F.col("cost") >= 0, "cost is negative or missing"),
        ],
    )


def clean_reference(raw: DataFrame, table: str) -> DataFrame:
    """Typed copy of a reference table; rows without a key text are left out."""
    spec = schemas.CLEAN[table]
    key = spec[0][0]
    empty = lambda c: F.when(F.col(c) != "", F.col(c))
    return raw.filter(F.col(key).isNotNull()).select(
        *[
            F.col(c) if kind is None else to_type(empty(c), kind).alias(c)
            for c, kind in spec
        ],
        F.col("file_name").alias("source_file"),
        F.lit("VALID").alias("validation_status"),
    )


def load_reference(
    cleaned: DataFrame, table: str, above: int | None = None, departments: DataFrame | None = None
) -> DataFrame:
    """Target rows of a cleaned reference table: valid, above an id cut-off if given;
    positions only for departments that exist."""
    spec = [c for c, _ in schemas.CLEAN[table]]
    rows = cleaned.filter(F.col("validation_status") == "VALID")
    if above is not None:
        rows = rows.filter(F.col(spec[0]) > above)
    if departments is not None:
        rows = rows.join(departments.select("department_id"), "department_id")
    return rows.select(*spec[1:])


# ---- the full run ------------------------------------------------------------------

TRANSFORMS: dict[str, Callable[[DataFrame], Cleaned]] = {
    "CUSTOMERS": transform_customers,
    "PRODUCTS": transform_products,
}
# Name of the summary entry in the process log.
FULL_RUN = "FULL_ETL_PIPELINE"


def run_table(tables: Tables, name: str, transform: Callable[[DataFrame], Cleaned]) -> dict:
    """Clean one raw table into staging in a single pass.

    Valid and rejected rows go to their own partition of the same write, and are
    counted by an observation while they pass.
    """
    counts = Observation()
    judged = transform(tables.read(f"stg_{name.lower()}_raw")).judged
    tables.replace(
        f"stg_{name.lower()}_clean",
        judged.observe(
            counts,
            F.count(F.lit(1)).alias("extracted"),
            F.count_if(F.col("validation_status") == "VALID").alias("valid"),
        ),
        partition_by=("validation_status",),
    )
    extracted, valid = counts.get["extracted"], counts.get["valid"]
    return {
        "extracted": extracted, "valid": valid, "invalid": extracted - valid, "loaded": valid,
    }


def merge_dimension(
    tables: Tables, name: str, source: DataFrame, key: str, tracked: list[str], as_of: date
) -> dict:
    """First load or merge of a dimension; returns what was inserted and expired."""
    if tables.exists(name):
        after = scd2.merge(tables.read(name), source, key, tracked, as_of)
    else:
        after = scd2.first_load(source, as_of)
    stored = tables.replace(name, after)
    counts = scd2.merge_counts(after, stored, as_of).first()
    return {"inserted": counts.inserted, "expired": counts.expired}


def run(
    tables: Tables,
    names: list[str],
    dimensions: dict[str, tuple[DataFrame, str, list[str]]],
    as_of: date,
) -> dict:
    """Clean every named table, then merge the dimensions, logging each step.

    A table that fails is logged and does not stop the others; a table without a
    transform is skipped with a warning.
    """
    started, results = datetime.now(), {}
    for name in names:
        transform = TRANSFORMS.get(name.upper())
        if transform is None:
            log.warning("no transform for %s, skipped", name)
            continue
        begun = datetime.now()
        try:
            got = run_table(tables, name, transform)
        except Exception as failure:
            results[name] = {"error": str(failure)}
            tables.log_process(f"ETL_{name}", "ERROR", begun, error=str(failure)[:1000])
            continue
        results[name] = got
        tables.log_process(
            f"ETL_{name}", "SUCCESS", begun, got["extracted"], got["loaded"], 0, got["invalid"]
        )
    try:
        merged = {
            dim: merge_dimension(tables, dim, source, key, tracked, as_of)
            for dim, (source, key, tracked) in dimensions.items()
        }
    except Exception as failure:
        tables.log_process(FULL_RUN, "ERROR", started, error=str(failure)[:1000])
        raise
    results["dimensional_updates"] = merged
    done = [r for r in results.values() if "extracted" in r]
    tables.log_process(
        FULL_RUN, "SUCCESS", started,
        sum(r["extracted"] for r in done), sum(r["loaded"] for r in done),
        sum(d["expired"] for d in merged.values()),
    )
    return results


def run_named(tables: Tables, name: str, dimensions: dict, as_of: date) -> str:
    """One table's run as a status line."""
    got = run(tables, [name], dimensions, as_of).get(name)
    if got is None:
        return f"{name}: SKIPPED"
    if "error" in got:
        return f"{name}: ERROR {got['error']}"
    return f"{name}: SUCCESS, {got['loaded']} loaded, {got['invalid']} rejected"


# Column lineage of the loads
# (source table, column, target table, column, rule, process).
LINEAGE = (
    ("STG_CUSTOMERS_RAW", "CUSTOMER_NUMBER", "CUSTOMERS", "CUSTOMER_NUMBER", "DIRECT_COPY", "CUSTOMER_ETL"),
    ("STG_CUSTOMERS_RAW", "ANNUAL_INCOME", "CUSTOMERS", "ANNUAL_INCOME", "CAST_TO_DECIMAL", "CUSTOMER_ETL"),
    ("CUSTOMERS", "CUSTOMER_ID", "CUSTOMER_DIM", "CUSTOMER_ID", "DIRECT_COPY", "DIM_LOAD"),
    ("ORDERS", "ORDER_DATE", "SALES_FACT", "ORDER_DATE_KEY", "DATE_LOOKUP", "FACT_LOAD"),
    ("ORDER_ITEMS", "QUANTITY", "SALES_FACT", "QUANTITY", "DIRECT_COPY", "FACT_LOAD"),
)
