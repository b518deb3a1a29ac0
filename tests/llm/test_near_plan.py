"""Bucket rows, 32 a document, are not broadcast however small Spark takes their table to be."""

import pytest

from wafercast.llm import near_dedup


@pytest.fixture
def large_threshold(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bucket_joins_broadcast_no_table(spark, tmp_path, large_threshold):
    spark.createDataFrame([(1, [10, 11]), (2, [10, 12]), (3, [13, 12]), (4, [14, 15])], "doc long, bands array<long>"
                          ).write.parquet(f"{tmp_path}/reps")
    members = near_dedup.bucket_members(spark.read.parquet(f"{tmp_path}/reps"))
    spark.createDataFrame([(10, 0, 1, 1), (10, 0, 2, 1), (12, 1, 2, 1), (12, 1, 3, 3)], "bucket long, band int, doc long, comp long"
                          ).write.parquet(f"{tmp_path}/own")
    opened = near_dedup.open_members(spark.read.parquet(f"{tmp_path}/own"))
    assert {tuple(r) for r in members.collect()} == {(10, 0, 1, 1), (10, 0, 2, 1), (12, 1, 2, 2), (12, 1, 3, 2)}
    assert {tuple(r) for r in opened.collect()} == {(12, 1, 2, 1, 1), (12, 1, 3, 3, 1)}
    for df in (members, opened):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
