from __future__ import annotations

import hashlib

import pytest
from conftest import values
from pyspark.sql import functions as F

from viewlog.operators import joins, keys


def order(names, digits=3):
    return sorted(names, key=lambda n: (hashlib.md5(n.encode()).hexdigest()[:digits], n))


@pytest.mark.parametrize("digits", [1, 3])
def test_keys_are_dense_and_follow_the_stated_order(spark, digits):
    names = [f"C{n:05d}" for n in range(700)]
    frame = spark.createDataFrame([(n,) for n in names], "id string").repartition(7)
    got = dict(values(keys.assign_keys(frame, "id", "k", digits=digits), "id", "k"))
    assert got == {name: n for n, name in enumerate(order(names, digits), start=1)}


def test_keys_do_not_depend_on_the_partitioning(spark):
    frame = spark.range(500).select(F.concat(F.lit("x"), "id").alias("id"))
    runs = [values(keys.assign_keys(frame.repartition(n), "id", "k"), "id", "k") for n in (1, 13)]
    assert runs[0] == runs[1]


def test_new_keys_continue_after_the_largest(spark):
    old = spark.createDataFrame([("a", 7), ("b", 3)], "id string, k long")
    new = spark.createDataFrame([("c",), ("d",), ("e",)], "id string")
    got = dict(values(keys.assign_keys(new, "id", "k", old), "id", "k"))
    assert got == {name: n for n, name in enumerate(order("cde"), start=8)}
    empty = old.where("false")
    assert sorted(k for _, k in values(keys.assign_keys(new, "id", "k", empty), "id", "k")) == [1, 2, 3]


@pytest.fixture
def skewed(spark):
    """A third of the rows under one key, some without a key, some with an unknown one."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
    return spark.range(3000).select(key.alias("key"), F.col("id").alias("n"))


@pytest.fixture
def dimension(spark):
    return spark.createDataFrame([("hot", 0), *[(f"k{n}", n) for n in range(1, 40)]], "name string, dim_key long")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("target", [1, 20, 500, 1_000_000])
def test_lookup_equals_a_plain_join(skewed, dimension, how, target):
    heavy = joins.heavy_keys(skewed, "key", target)
    got = joins.lookup(skewed, dimension, "key", "name", heavy, spread=["n"], how=how)
    wanted = skewed.join(dimension.withColumnRenamed("name", "key"), "key", how)
    assert values(got, "key", "n", "dim_key") == values(wanted, "key", "n", "dim_key")


def test_heavy_keys_have_more_rows_than_the_target(skewed):
    assert values(joins.heavy_keys(skewed, "key", 300)) == [("hot", 4)]
    assert joins.heavy_keys(skewed, "key").count() == 0
    assert joins.heavy_keys(skewed, "key", 1, limit=5).count() <= 5


def test_no_task_gets_more_than_its_share(spark):
    """A third of the rows under one key, and 2,000 more keys that are all above the target."""
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 2000)
    rows = spark.range(120_000).select(key.alias("key"), F.col("id").alias("n"))
    target = 20
    heavy = joins.heavy_keys(rows, "key", target)
    assert heavy.count() == 2001
    slots = F.coalesce(F.col("_slots"), F.lit(1))
    dealt = rows.join(heavy, "key", "left").groupBy("key", F.pmod(F.xxhash64("n"), slots).alias("slot")).count()
    assert dealt.agg(F.max("count")).first()[0] <= 3 * target
    names = spark.createDataFrame([(-1, 0), *[(n, n) for n in range(2000)]], "name long, dim_key long")
    joined = joins.lookup(rows, names, "key", "name", heavy, spread=["n"])
    assert joined.count() == 120_000


def test_a_heavy_key_is_spread_over_many_slots(spark, skewed, dimension):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        heavy = joins.heavy_keys(skewed, "key", 100)
        joined = joins.lookup(skewed, dimension, "key", "name", heavy, spread=["n"])
        tasks = joined.where("key = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks > 1
        plain = skewed.join(dimension.withColumnRenamed("name", "key"), "key")
        assert plain.where("key = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_lookup_takes_inner_and_left_only(skewed, dimension):
    with pytest.raises(ValueError):
        joins.lookup(skewed, dimension, "key", "name", joins.heavy_keys(skewed, "key"), ["n"], how="right")


def test_anti_and_semi(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    known = spark.createDataFrame([("a",), ("a",)], "id string")
    assert values(joins.only_in(rows, known, "k", "id")) == [("a",)]
    assert values(joins.not_in(rows.where("k IS NOT NULL"), known, "k", "id")) == [("b",)]


def test_few_rows_have_no_heavy_key(spark):
    """Then nothing is grouped, and a join with what comes back costs nothing."""
    rows = spark.range(10).select(F.lit("a").alias("key"))
    heavy = joins.heavy_keys(rows, "key", target=10)
    assert heavy.columns == ["key", "_slots"] and heavy.count() == 0
    assert heavy._jdf.queryExecution().optimizedPlan().toString().startswith("LocalRelation <empty>")
    assert [tuple(row) for row in joins.heavy_keys(rows, "key", target=9).collect()] == [("a", 2)]
