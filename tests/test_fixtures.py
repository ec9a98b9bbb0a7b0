"""Writing the fixture tables: short rows are sorted, not wide ones."""

from shardtally.checks import fixtures


def test_only_short_rows_are_sorted_for_writing(spark, tmp_path):
    """The writer of day partitions needs its rows by day; sorting them with their nested columns takes 1.3 KB a row."""
    df = fixtures.events(spark, "/root/testdata/sf0.001", by_day=True)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    df.createOrReplaceTempView("derived")
    spark.sql(f"CREATE TABLE by_day ({columns}) USING parquet PARTITIONED BY (shard) LOCATION '{tmp_path}/by_day'")
    try:
        into = ", ".join(spark.table("by_day").columns)
        plan = spark.sql(f"EXPLAIN INSERT INTO by_day SELECT {into} FROM derived").first()[0].split("\n")
        sorts = [i for i, line in enumerate(plan) if " Sort [" in line]
        assert len(sorts) == 1 and "shard" in plan[sorts[0]]
        assert not any("event_params" in line or "mobile_brand_name" in line for line in plan[sorts[0] :])
        assert any("event_params" in line for line in plan[: sorts[0]])
    finally:
        spark.sql("DROP TABLE by_day")
        spark.catalog.dropTempView("derived")


def test_order_changes_no_rows(spark):
    one, other = (fixtures.events(spark, "/root/testdata/sf0.001", by_day) for by_day in (True, False))
    assert one.count() == other.count() and one.exceptAll(other).count() == 0
