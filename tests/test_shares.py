from pyspark.sql import functions as F

from sorterlog.operators import counts as ct


def test_shares_take_no_window_over_all_values(spark):
    df = spark.range(3000).select(F.concat(F.lit("v"), (F.col("id") % 1000).cast("string")).alias("t"))
    found = ct.shares(df, "t")
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["count"], r["percentage"]) for r in found.collect()} == {(3, 0.1)} and found.count() == 1000
    assert ct.shares(df.where("false"), "t").collect() == []
