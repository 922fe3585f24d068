"""What every choice of rows must satisfy also holds of amounts that nothing can be divided by."""

from pyspark.sql import functions as F

from txnwatch.plans import catalog


def test_spikes_of_zero_and_negative_amounts(spark, tmp_path):
    amount = F.when(F.col("id") % 3 == 0, 0.0).when(F.col("id") % 3 == 1, -F.col("id") / 7).when(F.col("id") % 7 > 0, 12.34)
    events = spark.range(6000).select(
        F.col("id").alias("event_id"), F.lit("2024-01-15 10:00:00").cast("timestamp_ntz").alias("ts"), F.lit(1).cast("long").alias("user_id"),
        F.lit("view").alias("event_type"), amount.alias("value"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(1, 2)], "c_custkey long, c_nationkey long").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(2, "US")], "n_nationkey long, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    found = catalog.hashed_injection(spark, str(tmp_path)).first().asDict()
    assert found == {
        "n_rows": 6000, "rate_is_near": True, "unlabelled_changes": 0, "spikes_out_of_range": 0, "jumps_not_far": 0,
        "bursts_at_other_hours": 0, "n_types": 3}
