"""Laws that hold for any input."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from latentspark.operators import particles as sets
from latentspark.operators import position

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def ordered(spark, n):
    return spark.range(n).select(F.col("id").alias("position"), F.lit(2.0).alias("apix"))


@FEW
@given(n=st.integers(0, 60), chunk=st.integers(1, 20))
def test_chunks_hold_every_image(spark, n, chunk):
    sizes = [r["images"] for r in position.chunk_sizes(ordered(spark, n), chunk).orderBy("chunk").collect()]
    assert sum(sizes) == n and all(s == chunk for s in sizes[:-1])


@FEW
@given(n=st.integers(0, 40), picks=st.lists(st.integers(-5, 50), max_size=30))
def test_subset_keeps_order_and_is_idempotent(spark, n, picks):
    index = spark.createDataFrame([(p,) for p in picks], "position bigint")
    once = sets.subset(ordered(spark, n), index)
    places = [r["position"] for r in once.orderBy("position").collect()]
    assert places == sorted({p for p in picks if 0 <= p < n})
    assert sets.subset(once, index).count() == len(places)


@FEW
@given(old=st.sampled_from([64, 128, 256]), new=st.sampled_from([32, 64, 128]))
def test_rescaling_there_and_back(spark, old, new):
    there = sets.rescale_sampling(ordered(spark, 3), old, new)
    assert {r["apix"] for r in sets.rescale_sampling(there, new, old).collect()} == {2.0}


@FEW
@given(sizes=st.lists(st.integers(0, 12), min_size=1, max_size=4))
def test_concatenated_chunks_are_dense(spark, sizes):
    whole = position.concat_chunks([ordered(spark, n) for n in sizes])
    assert sorted(r["position"] for r in whole.collect()) == list(range(sum(sizes)))
