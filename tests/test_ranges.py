"""The smallest range around a point, against all pairs."""

import random

from recordforge.operators import ownership as O
from recordforge.plans import registry


def test_first_in_range_equals_all_pairs(spark):
    rng = random.Random(1)
    ranges = [(i, lo, lo + rng.choice([0, 1, 5, 40, 900, -1])) for i in range(60) for lo in [rng.randrange(-500, 1000)]]
    ranges += [(99, 3000, 10**12), (100, None, 5), (101, 7, None)]
    points = [*range(-600, 2000), 2999, 3000, 10**12, 10**12 + 1, None, 5]
    got = O.first_in_range(
        spark.createDataFrame([(p,) for p in points], "page long"), spark.createDataFrame(ranges, "chapter long, lo long, hi long"), "page", "lo", "hi", "chapter"
    ).collect()
    want = {p: min(c) for p in points if p is not None and (c := [c for c, lo, hi in ranges if None not in (lo, hi) and lo <= p <= hi])}
    assert sorted(map(tuple, got)) == sorted(want.items())


def test_chapters_beyond_forty_count(spark, tmp_path):
    spark.createDataFrame([(41, 1), (41, 9), (7, 5), (7, 6), (9000, 20), (9000, 30)], "o_custkey long, o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(p,) for p in (1, 5, 9, 10, 25)], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    got = registry.QUERIES["chapter_for_every_page"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [(1, 41), (5, 7), (9, 41), (25, 9000)]


def test_points_by_level_are_never_held_as_a_whole(spark):
    """Their rows by level are many more than Spark's size check expects, so no join may build a table in memory from them."""
    df = O.first_in_range(spark.range(50).withColumnRenamed("id", "page"), spark.createDataFrame([(1, 5, 10**9)], "chapter long, lo long, hi long"), "page", "lo", "hi", "chapter")
    assert sorted(df.collect()) == [(p, 1) for p in range(5, 50)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "HashJoin" not in plan


def test_ends_of_the_numbers(spark):
    top, low = 2**63 - 1, -(2**63) + 1
    df = O.first_in_range(
        spark.createDataFrame([(low,), (0,), (top - 1,)], "page long"), spark.createDataFrame([(3, low, top), (2, 0, top), (1, top, top)], "chapter long, lo long, hi long"), "page", "lo", "hi", "chapter"
    )
    assert sorted(map(tuple, df.collect())) == [(low, 3), (0, 2), (top - 1, 2)]
    assert O.first_in_range(spark.createDataFrame([], "page long"), spark.createDataFrame([(3, 1, 2)], "chapter long, lo long, hi long"), "page", "lo", "hi", "chapter").collect() == []
