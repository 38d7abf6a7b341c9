"""Label codes against a plain numbering: many labels, a hot one, NULL and ties."""

from frames import rows
from pyspark.sql import functions as F

from martlet.plans import features

MANY = 100_000


def many(spark):
    """A third of all rows hold one label; the others hold one each."""
    n = F.col("id")
    hot = n % 3 == 0
    return spark.range(MANY * 3 // 2).select(
        n,
        F.when(hot, "hot").otherwise(F.concat(F.lit("label "), n.cast("string"))).alias("a"),
        F.when(n % 2 == 0, "x").when(n % 5 != 0, "y").alias("b"),
    )


def test_many_labels(spark):
    df = many(spark)
    got = features.encode(df, df, {"a": "a_code", "b": "b_code"})
    found = got.collect()
    order = {label: i for i, label in enumerate(sorted({r.a for r in found}))}
    assert len(found) == MANY * 3 // 2 and len(order) == MANY + 1
    assert all(r.a_code == order[r.a] for r in found)
    assert all(r.b_code == {None: 0, "x": 1, "y": 2}[r.b] for r in found)
    assert got.columns == ["id", "a", "b", "a_code", "b_code"]


def test_no_array_of_labels(spark):
    plan = features.label_codes(many(spark), "a")._jdf.queryExecution().toString()
    assert "collect_set" not in plan and "collect_list" not in plan


def test_unknown_and_missing_labels(spark):
    seen = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "kind string")
    new = spark.createDataFrame([("a",), ("c",), (None,)], "kind string")
    assert rows(features.label_codes(seen, "kind")) == [("Unknown", 0), ("a", 1), ("b", 2)]
    got = features.encode(new, seen, {"kind": "code"})
    assert {(r.kind, r.code) for r in got.collect()} == {("a", 1), ("c", None), (None, 0)}


def test_no_rows(spark):
    none = spark.createDataFrame([], "kind string")
    assert rows(features.label_codes(none, "kind")) == []
    assert rows(features.encode(none, none, {"kind": "code"})) == []
