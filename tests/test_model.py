import pytest
from frames import rows

from martlet import model
from martlet.operators import scd2
from martlet.plans import builds


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    names = model.Namespace("t_", "_dev")
    made = model.create(spark, names, str(tmp_path_factory.mktemp("warehouse")))
    yield names, made
    for schema in model.TABLES:
        spark.sql(f"DROP DATABASE IF EXISTS {names.database(schema)} CASCADE")


def test_all_tables_exist(spark, warehouse):
    names, made = warehouse
    assert all(spark.catalog.tableExists(t) for t in made)
    assert names.table("sales", "orders") == "t_sales_dev.orders"
    assert model.create(spark, names, "/nowhere") == made  # a second time changes nothing


def test_defaults_lengths_and_required_columns(spark, warehouse):
    names, _ = warehouse
    table = names.table("customers", "customers")
    ok = "1L AS customer_id, 'C1' AS customer_number, 'a@b.co' AS email, DATE '2020-01-01' AS registration_date"
    model.insert(spark, spark.sql(f"SELECT {ok}"), table)
    got = spark.table(table).first()
    assert (got.status, got.preferred_language, got.marketing_opt_in) == ("ACTIVE", "EN", True)
    assert got.customer_type == "INDIVIDUAL" and got.total_orders == 0
    assert got.created_date is not None
    with pytest.raises(Exception, match="(?i)length|exceed"):
        model.insert(spark, spark.sql(f"SELECT {ok}, '{'9' * 21}' AS phone"), table)


def test_built_tables_fit_the_model(spark, warehouse, mart):
    names, _ = warehouse
    fits = {
        "sales_fact": builds.sales_fact(mart).drop("line_number"),
        "customer_ltv_fact": builds.customer_ltv(mart),
        "product_performance_fact": builds.product_performance(mart),
        "date_dim": mart.date_dim,
        "product_dim": scd2.first_load(
            builds.product_source(mart).selectExpr("product_id AS product_key", "*"), mart.as_of),
    }
    for name, df in fits.items():
        table = names.table("analytics", name)
        model.insert(spark, df, table)
        assert spark.table(table).count() == df.count()
    assert rows(model.duplicate_keys(spark.table(names.table("analytics", "product_dim")),
                                     "product_dim"), "duplicates") == [(0,), (0,)]
