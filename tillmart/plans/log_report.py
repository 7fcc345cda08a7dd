"""Report on past runs from their text logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmart.functions.calendar import seconds_between
from tillmart.sources.stores import Store

START, FINISH, OTHER = "start", "finish", "other"

# Levels, and how the messages of a step begin, up to the table.
LEVELS = ["INFO", "ERROR"]
STEPS = [
    ("Creating/Overwriting datamart table: ", "datamart", START),
    ("Finished writing ", "datamart", FINISH),
    ("Exporting table ", "export", START),
    ("Finished exporting ", "export", FINISH),
    ("Starting ingest: ", "ingest", START),
    ("Target count for ", "ingest", FINISH),
]
TIME_LENGTH = 19


def parse_log(lines: DataFrame, text: str = "value") -> DataFrame:
    """Log lines to `logged_at, level, message, job, step, table_name, rows`.

    A line is `[time ]LEVEL: message`; other lines are left out. The parsed line
    comes out of a one-element explode, so that later filters do not repeat the
    parsing.
    """
    line = F.col(text)
    at = F.left(line, F.lit(TIME_LENGTH)).try_cast("timestamp_ntz")
    rest = F.when(at.isNull(), line).otherwise(F.substr(line, F.lit(TIME_LENGTH + 2)))
    level = F.substring_index(rest, ": ", 1)
    message = F.substr(rest, F.length(level) + 3)
    split = lines.select(at.alias("at"), level.alias("level"), message.alias("message"))

    said = F.col("message")

    def step_of(prefix: str, job: str, step: str) -> Column:
        after = F.substring_index(F.substr(said, F.lit(len(prefix) + 1)), " | ", 1)
        # An ingest starts from a source table and names the target behind an arrow.
        name = F.substring_index(F.substring_index(after, " -> ", -1), " ", 1)
        found = F.struct(
            F.lit(job).alias("job"),
            F.lit(step).alias("step"),
            F.rtrim(name, F.lit(":")).alias("table_name"),
        )
        return F.when(said.startswith(prefix), found)

    nothing = F.struct(
        F.lit(None).cast("string").alias("job"),
        F.lit(OTHER).alias("step"),
        F.lit(None).cast("string").alias("table_name"),
    )
    parsed = F.struct(
        F.col("at").alias("logged_at"),
        "level",
        "message",
        F.coalesce(*[step_of(*known) for known in STEPS], nothing).alias("what"),
        F.substring_index(said, ": ", -1).try_cast("long").alias("rows"),
    )
    return (
        split.select(F.explode(F.array(parsed)).alias("line"))
        .filter(F.col("line.level").isin(LEVELS))
        .select("line.logged_at", "line.level", "line.message", "line.what.*", "line.rows")
    )


def log_report(parsed: DataFrame) -> DataFrame:
    """One row per finished step: job, table, start, end, seconds and rows.

    A finish belongs to the latest start of its job and table at or before it. Log
    times are whole seconds, so the history is first reduced to one row per table
    and second. A window then covers one table and day, at most 86,400 rows, and
    the last start before the day comes from one row per table and day.
    """
    key = ["job", "table_name"]
    steps = parsed.filter(F.col("step") != OTHER).dropna(subset=[*key, "logged_at"])
    start_time = F.when(F.col("step") == START, F.col("logged_at"))
    seconds = steps.groupBy(*key, "logged_at").agg(F.max(start_time).alias("start"))
    seconds = seconds.withColumn("day", F.col("logged_at").cast("date"))

    day_so_far = W.partitionBy(*key, "day").orderBy("logged_at")
    in_day = seconds.withColumn("latest", F.max("start").over(day_so_far))
    days_before = W.partitionBy(*key).orderBy("day").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        seconds.groupBy(*key, "day")
        .agg(F.max("start").alias("last_start"))
        .select(*key, "day", F.max("last_start").over(days_before).alias("earlier"))
    )
    starts = in_day.join(carried, [*key, "day"]).select(
        *key, "logged_at", F.coalesce("latest", "earlier").alias("started_at")
    )
    finishes = parsed.filter(F.col("step") == FINISH).alias("f")
    return finishes.join(starts.alias("s"), [*key, "logged_at"], "left").select(
        *key,
        "started_at",
        F.col("logged_at").alias("ended_at"),
        seconds_between(F.col("started_at"), F.col("logged_at")).alias("seconds"),
        "rows",
    )


def load_log(spark: SparkSession, path: str, store: Store, table: str) -> DataFrame:
    """Parse text logs once, into a table that the report reads several times."""
    store.write(parse_log(spark.read.text(path)), table, "overwrite")
    return store.read(table)
