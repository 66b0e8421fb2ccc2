"""Property: both numbering paths equal row_number() over the natural order."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from constella.operators import dense_keys


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.one_of(st.none(), st.text(max_size=4)), max_size=60, unique=True),
       offset=st.integers(min_value=0, max_value=10_000),
       parts=st.integers(min_value=1, max_value=5))
def test_dense_keys_equals_row_number(spark, values, offset, parts):
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(parts)
    expected = df.select("v", (F.row_number().over(Window.orderBy(F.col("v").asc_nulls_first())) + offset)
                         .cast("bigint").alias("k"))
    want = sorted(map(tuple, expected.collect()), key=repr)
    for limit in (None, 1_000_000):
        got = dense_keys(df, ["v"], "k", offset)
        assert sorted(map(tuple, got.collect()), key=repr) == want
