"""How rows find their shard."""

import pytest
from pyspark.sql import functions as F

from constella.llm.common import ordered_shards


@pytest.fixture
def small_broadcasts(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_payloads_are_not_shuffled_to_find_their_shard(spark, small_broadcasts):
    rows = spark.range(5000).select(F.when(F.col("id") > 0, F.col("id") * 7).alias("k"), F.repeat(F.lit("x"), 100).alias("body"))
    sharded = ordered_shards(rows, "k", F.octet_length("body"), 10_000)
    plan = sharded._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    found = sharded.groupBy("_shard").agg(F.count("*").alias("n"), F.min("k").alias("low"), F.max("k").alias("high")).orderBy("_shard").collect()
    assert sum(r.n for r in found) == 5000 and len(found) == 50 and max(r.n for r in found) <= 101
    assert all(a.high < b.low for a, b in zip(found, found[1:]))
