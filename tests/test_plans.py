"""Shape of the physical plans that matter at scale."""

from pyspark.sql import functions as F

from constella import schemas as S
from constella.operators import one_row_per_id, one_row_per_key
from constella.plans.batches import empty, fact_step
from tests.helpers import movie, raw_df
from constella.operators import clean


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _window(spark, scratch, n=200):
    rows = [movie(i, slug=f"s{i % 3}", date="2024-01-01 00:00:00", language="en" if i % 3 else None,
                  runtime=90, rating=7.0, year=2000) for i in range(n)]
    clean(raw_df(spark, rows)).withColumn("landing", F.lit(1)).write.parquet(f"{scratch}/w")
    return spark.read.parquet(f"{scratch}/w")


def test_one_row_per_key_aggregates_map_side(spark, scratch):
    w = _window(spark, scratch)
    for df in (one_row_per_key(w, "slug", S.MOVIE_ATTRIBUTES), one_row_per_id(w, "movie_id", ["landing", "slug"])):
        p = plan(df)
        assert "partial_min" in p                 # map-side combine before the shuffle
        assert "Window" not in p                  # nothing partitioned by a possibly hot key


def test_fact_step_reduces_history_and_broadcasts_dims(spark, scratch):
    w = _window(spark, scratch)
    spark.range(100, 1000).select(F.col("id").alias("movie_id")).write.parquet(f"{scratch}/hist")
    hist = spark.read.parquet(f"{scratch}/hist").select(
        "movie_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in S.FACT_MOVIES.fields[1:]])
    dims = {name: empty(spark, schema) for name, schema in [
        ("dim_movie", S.DIM_MOVIE), ("dim_date", S.DIM_DATE), ("dim_language", S.DIM_LANGUAGE),
        ("dim_runtime", S.DIM_RUNTIME), ("dim_rating", S.DIM_RATING), ("dim_released_year", S.DIM_RELEASED_YEAR)]}
    out = fact_step(w, dims, hist)
    p = plan(out)
    # fact history, dim_movie and dim_date are each cut to the window's keys
    assert p.count("LeftSemi") >= 3 and "BroadcastExchange" in p
    assert "SortMergeJoin" not in p
    assert sorted(r.movie_id for r in out.collect()) == list(range(100))   # 100..199 already loaded
