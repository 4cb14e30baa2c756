"""Observations from files and the events table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions.patterns import strip


def text_lines(spark: SparkSession, path: str, source: str = "file") -> DataFrame:
    """Lines of text files that aren't blank, as observations; seq follows the order in a file."""
    lines = spark.read.text(path).filter(strip(F.col("value")) != "")
    return lines.select(F.monotonically_increasing_id().alias("seq"), F.current_timestamp().alias("obs_ts"), F.lit(source).alias("source"), F.col("value").alias("raw"))


def matrix_cases(spark: SparkSession, path: str) -> DataFrame:
    """(input, expect_action) of a test matrix: a JSON file with a list of cases; missing fields are empty."""
    rows = spark.read.schema("cases array<struct<input string, expect_action string>>").json(path, multiLine=True)
    return rows.select(F.explode("cases").alias("c")).select(F.coalesce("c.input", F.lit("")).alias("input"), F.coalesce("c.expect_action", F.lit("")).alias("expect_action"))


#: Bytes of stored events that one task turns into lines, and the most events, however small they are stored.
TASK_BYTES = 2 << 20
TASK_ROWS = 100_000


def spread(df: DataFrame, task_bytes: int = TASK_BYTES, task_rows: int = TASK_ROWS) -> DataFrame:
    """df over as many tasks as run at once, and over more where its files or rows are more, so that no task grows with them.

    Rows of larger files are counted, which reads their footers: files of one size differ in rows by their encoding, and
    splits of one size by where row groups lie.
    """
    plan = df._jdf.queryExecution()
    size, parts = int(str(plan.optimizedPlan().stats().sizeInBytes())), plan.toRdd().getNumPartitions()
    tasks, most = max(df.sparkSession.sparkContext.defaultParallelism, -(-size // task_bytes)), 0
    if size > task_bytes:
        total, most = df.groupBy(F.spark_partition_id()).count().agg(F.sum("count"), F.max("count")).first()
        tasks = max(tasks, -(-(total or 0) // task_rows))
    return df if parts >= tasks and (most or 0) <= task_rows else df.repartition(tasks)


def event_line() -> Column:
    """An event written as a database log line; every fiftieth is garbage that nothing parses."""
    k = F.get_json_object("props", "$.k")
    user = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    rest = (
        F.when(F.col("event_type") == "error", F.concat(F.lit('FATAL:  password authentication failed for user "'), user, F.lit('"')))
        .when(F.col("event_type") == "signup", F.concat(user, F.lit("@prod LOG:  connection authorized: user="), user, F.lit(" database=prod")))
        .when(F.col("event_type") == "purchase", F.concat(user, F.lit("@prod LOG:  statement: SELECT "), k))
        .when(F.col("event_type") == "click", F.concat(user, F.lit("@prod ERROR:  permission denied for table t"), k))
        .otherwise(F.concat(F.lit("LOG:  checkpoint "), k))
    )
    head = F.concat(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSS"), F.lit(" UTC ["), F.col("event_id").cast("string"), F.lit("] "))
    return F.when(F.col("event_id") % 50 == 7, F.concat(F.lit("GARBAGE "), F.col("event_id").cast("string"), F.lit(" k="), k)).otherwise(F.concat(head, rest))


def event_lines(events: DataFrame) -> DataFrame:
    """Events as observations of database log lines."""
    return events.select(F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("obs_ts"), F.lit("events").alias("source"), event_line().alias("raw"))
