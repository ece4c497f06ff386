"""A third of all rows in one record, one source, one run."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import coverage, numbering, records, runs
from tidemark.schema import KEY
from tidemark.streaming.first_seen import first_seen_stream

N = 60_000


def skewed(spark):
    """Row i is the same record for a third of all i, else nearly its own."""
    i = F.col("id")
    hot = i % 3 == 0
    return spark.range(N).select(
        F.when(hot, F.lit("hot")).otherwise((i % 20_000).cast("string")).alias("id_1"),
        F.when(hot, F.lit("S0")).otherwise(F.concat(F.lit("S"), (i % 7).cast("string"))).alias("id_2"),
        F.lit("Flu").alias("vaccine_group"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), F.when(hot, F.lit(0)).otherwise((i % 30).cast("int"))).alias(
            "vaccination_date"
        ),
        i.alias("n"),
    )


def expected_distinct():
    def one(i):
        return ("hot", "S0", 0) if i % 3 == 0 else (str(i % 20_000), f"S{i % 7}", i % 30)

    return len({one(i) for i in range(N)})


def shuffled_rows(df):
    """Rows the first exchange of an executed plan has written."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan
    return plan


def test_copies_fold_before_the_shuffle(spark):
    distinct = records.dedupe(skewed(spark))
    plan = shuffled_rows(distinct)
    # A partial aggregate lies on either side of the one exchange.
    assert plan.count("Exchange hashpartitioning") >= 1
    assert distinct.count() == expected_distinct()


def test_a_hot_source_is_numbered_by_many_tasks(spark):
    rows = skewed(spark)
    # Small partitions would be put together again on data of this size.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = numbering.sequence(rows, ["id_2"], ["n"], hot_rows=10_000)
        placed = numbered.filter("id_2 = 'S0'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert numbered.count() == N
    hot = numbered.filter("id_2 = 'S0'").agg(F.min("seq"), F.max("seq"), F.count_distinct("seq")).first()
    size = rows.filter("id_2 = 'S0'").count()
    assert tuple(hot) == (1, size, size)
    assert len(placed) > 1


def test_aggregates_of_a_hot_run(spark):
    at = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
    events = skewed(spark).select(
        F.col("id_1").alias("run_id"),
        F.col("n").cast("int").alias("seq"),
        F.when(F.col("n") == N - 3, F.lit("RunFailed")).otherwise(F.lit("RunStarted")).alias("type"),
        (at + F.make_dt_interval(secs=F.col("n"))).alias("at"),
    )
    hot = runs.summarize(events, ["run_id"]).filter("run_id = 'hot'").first()
    assert (hot["events"], hot["outcome"]) == (N // 3, "RunFailed")
    last = coverage.latest(skewed(spark), ["id_2"], "n", ["n"]).filter("id_2 = 'S0'").first()
    assert last["n"] == N - 3


def test_diff_with_a_hot_record_without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = skewed(spark)
        known = records.dedupe(rows.filter("n % 2 = 0"))
        new = records.diff(records.dedupe(rows), known)
        assert new.count() + known.count() == expected_distinct()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_seen_in_a_stream_with_a_hot_record(spark, folder):
    skewed(spark).repartition(6).write.parquet(f"{folder}/in")
    schema = spark.read.parquet(f"{folder}/in").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")
    (
        first_seen_stream(stream, "n")
        .writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/state")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    got = spark.read.parquet(f"{folder}/out")
    assert got.count() == got.dropDuplicates(KEY).count() == expected_distinct()
