import pytest
from pyspark.sql import functions as F

from strata.operators.ordering import with_position


@pytest.mark.parametrize("parts", [1, 7])
def test_positions_equal_row_numbers(spark, parts):
    df = (spark.range(3000).repartition(5).select(F.col("id"), F.when(F.col("id") % 11 != 0, F.lit(7)).alias("hot"),  # most rows share a value
                                                  F.lit("old").alias("position")))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = with_position(df, ["hot", F.desc("id")]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    want = sorted(((None if i % 11 == 0 else 7, i) for i in range(3000)), key=lambda r: (r[0] is not None, -r[1]))
    assert [(r["hot"], r["id"]) for r in sorted(got, key=lambda r: r["position"])] == want
    assert sorted(r["position"] for r in got) == list(range(1, 3001))


def test_positions_of_equal_and_no_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "x int")
    assert sorted((r["x"] is not None, r["position"]) for r in with_position(df, ["x"]).collect()) == [(False, 1), (True, 2), (True, 3)]
    assert with_position(df.limit(0), ["x"]).collect() == []
