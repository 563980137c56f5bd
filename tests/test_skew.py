"""One key that holds most rows must not put most rows into one task."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import joins, running
from ledgerline.operators.running import Order, running_totals


@pytest.fixture
def shuffled_joins(spark):
    """No broadcast, and no run-time change of partitions that would hide their sizes."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def largest_share(df, column):
    counts = [r["count"] for r in df.groupBy(column).count().collect()]
    return max(counts) / sum(counts)


def test_rows_with_null_keys_are_spread(spark, shuffled_joins):
    left = spark.range(8000).select(
        "id", F.when(F.col("id") % 10 < 2, F.col("id").cast("string")).alias("k")
    )
    right = spark.range(500).select(F.col("id").cast("string").alias("rk"), F.lit(1).alias("v"))

    def share(df):
        return largest_share(df.withColumn("task", F.spark_partition_id()), "task")

    assert share(left.join(right, left.k == right.rk, "left")) > 0.7
    assert share(joins.null_safe_left_join(left, right, [("k", "rk")])) < 0.2


def test_hot_partition_of_running_totals_is_split(spark, monkeypatch):
    seen = {}
    original = running.settled

    def spy(df):
        seen["table"] = original(df)
        return seen["table"]

    monkeypatch.setattr(running, "settled", spy)
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("p"),
        (F.col("id") % 1000).alias("o"), F.col("id").alias("k"), F.lit(1.0).alias("v"),
    )
    out = running_totals(df, ["p"], [Order("o")], [Order("k")], {"c": "v"}, rank="n")
    assert out.filter("p = 'hot'").agg(F.max("n")).first()[0] == 13333
    assert largest_share(seen["table"], "__range") < 0.3


def test_hot_value_is_split_by_the_tie_break(spark, monkeypatch):
    seen = {}
    original = running.settled

    def spy(df):
        seen["table"] = original(df)
        return seen["table"]

    monkeypatch.setattr(running, "settled", spy)
    df = spark.range(20000).select(F.lit(1).alias("o"), F.col("id").alias("k"), F.lit(1.0).alias("v"))
    out = running_totals(df, [], [Order("o")], [Order("k")], {"c": "v"}, rank="n")
    assert out.select("c").distinct().collect()[0][0] == 20000.0
    assert out.agg(F.count_distinct("n")).first()[0] == 20000
    assert largest_share(seen["table"], "__range") < 0.3


def test_element_of_every_set_makes_no_candidates(spark):
    small = spark.range(300).select(F.col("id").alias("s"), F.explode(F.array(F.lit("client"), F.concat(F.lit("e"), "id"))).alias("element"))
    large = spark.range(300).select(F.col("id").alias("l"), F.explode(F.array(F.lit("client"), F.concat(F.lit("e"), "id"))).alias("element"))
    pairs = joins.subset_pairs(small, large, "s", "l")
    assert pairs.count() == 300 and pairs.filter("s != l").isEmpty()
