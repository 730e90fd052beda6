from quire.checkpoint import checkpoint
from quire.partitioning import spread


def test_checkpoint_keeps_rows_and_cuts_the_plan(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "id BIGINT, text STRING").groupBy("id", "text").count()
    cut = checkpoint(df)
    assert sorted(cut.collect()) == sorted(df.collect()) and cut.schema == df.schema
    assert "Aggregate" not in cut._jdf.queryExecution().executedPlan().toString()
    assert checkpoint(df.limit(0)).count() == 0


def test_spread(spark):
    cores = spark.sparkContext.defaultParallelism
    small = spark.range(10, numPartitions=1)
    assert spread(small).rdd.getNumPartitions() == cores and spread(small).count() == 10
    many = spark.range(10, numPartitions=cores + 3)
    assert spread(many) is many
    grouped = many.groupBy("id").count()
    assert spread(grouped) is grouped
