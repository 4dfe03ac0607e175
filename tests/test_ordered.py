import pytest
from pyspark.sql import functions as F

from changelake.plans import ordered
from helpers import tuples


def crowded(spark):
    """One large group, nine tenths of it in a hundredth of its range; one small group."""
    burst = spark.range(900).select(F.lit("hot").alias("g"), (F.col("id") + 50_001).alias("o"))
    rest = spark.range(100).select(F.lit("hot").alias("g"), (F.col("id") * 1_000).alias("o"))
    cold = spark.range(20).select(F.lit("cold").alias("g"), F.col("id").alias("o"))
    return burst.union(rest).union(cold)


@pytest.mark.parametrize("unique_lead", [False, True])
def test_large_groups_are_cut_small_and_in_order(spark, unique_lead):
    cut = ordered.cut_hot_groups(crowded(spark), ["g"], "o", 50, unique_lead)
    assert cut.filter("g = 'cold' AND _segment IS NOT NULL").count() == 0
    sizes = cut.filter("g = 'hot'").groupBy("_segment").agg(
        F.count("*").alias("n"), F.min("o").alias("lo"), F.max("o").alias("hi")
    )
    rows = sizes.orderBy("_segment").collect()
    assert sum(r.n for r in rows) == 1000
    assert max(r.n for r in rows) <= 101
    assert all(a.hi < b.lo for a, b in zip(rows, rows[1:]))


def test_same_order_value_stays_in_one_segment(spark):
    df = spark.range(300).select(F.lit("g").alias("g"), F.lit(5).cast("long").alias("o"))
    assert ordered.cut_hot_groups(df, ["g"], "o", 10).select("_segment").distinct().count() == 1


def test_rows_without_order_value_come_first(spark):
    df = crowded(spark).union(spark.createDataFrame([("hot", None)], "g string, o long"))
    cut = ordered.cut_hot_groups(df, ["g"], "o", 50)
    lowest = cut.filter("g = 'hot'").agg(F.min("_segment")).first()[0]
    assert tuples(cut.filter("g = 'hot' AND o IS NULL"), "_segment") == [(lowest,)]


def test_every_group_above_the_limit_is_cut(spark):
    df = spark.range(600).select((F.floor(F.sqrt("id")) % 4).alias("g"), F.col("id").alias("o"))
    cut = ordered.cut_hot_groups(df, ["g"], "o", 10)
    assert cut.filter("_segment IS NULL").count() == 0
    many = spark.range(36_006).select((F.col("id") % 12_002).alias("g"), F.col("id").alias("o"))
    assert ordered.cut_hot_groups(many, ["g"], "o", 2).filter("_segment IS NULL").count() == 0
    got = ordered.number_rows(df, ["g"], ["o"], "o", rows_per_segment=10)
    seen = {}
    for r in got.orderBy("o").collect():
        assert r.row_no == seen.setdefault(r.g, 0)
        seen[r.g] += 1
