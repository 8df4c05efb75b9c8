"""The catalogue stream over the events, dropped as one folder of text files per day."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.plans import views as v
from cellweave.plans.registry import query
from cellweave.session import scratch_path
from cellweave.streaming import catalog as stream

EVENT_SCHEMA = "event_id bigint, user_id bigint, event_type string, value double"


def _drop(spark, sf, path, condition=None, break_errors=False):
    """Write the events as JSON lines below ``path``, a folder per day; error events may be cut short."""
    day = F.date_format("ts", "yyyy-MM-dd")
    events = v.table(spark, sf, "events").withColumn("day", day)
    if condition is not None:
        events = events.where(condition)
    line = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    if break_errors:
        line = F.when(F.col("event_type") == "error", F.substring(line, 1, 12)).otherwise(line)
    events.select("day", line.alias("value")).write.mode("append").partitionBy("day").text(path)


def _by_day(rows):
    return rows.groupBy(F.regexp_replace("folder", "^day=", "").alias("day")).agg(
        F.sum("n_cells").alias("n_cells"),
        F.round(F.sum("total_value"), 2).alias("total_value"),
        (F.count("*") - F.count_distinct("filename")).alias("n_repeated_files"),
    )


_BY_DAY = """SELECT strftime(ts, '%Y-%m-%d') AS day, COUNT(*) AS n_cells, round(SUM(value), 2) AS total_value, 0::BIGINT AS n_repeated_files
    FROM events GROUP BY 1"""


def _paths(spark, label):
    base = scratch_path(spark, label)
    return f"{base}/drop", f"{base}/out", f"{base}/checkpoint"


@query("stream_new_files", _BY_DAY)
def stream_new_files(spark, sf):
    drop, out, checkpoint = _paths(spark, "new-files")
    _drop(spark, sf, drop)
    stream.sweep(spark, drop, EVENT_SCHEMA, out, checkpoint, files_per_batch=1000)
    return _by_day(stream.read_catalog(spark, out))


@query("stream_resume", _BY_DAY)
def stream_resume(spark, sf):
    drop, out, checkpoint = _paths(spark, "resume")
    _drop(spark, sf, drop, F.col("day") < "2024-01-16")
    stream.sweep(spark, drop, EVENT_SCHEMA, out, checkpoint)
    _drop(spark, sf, drop, F.col("day") >= "2024-01-16")
    stream.sweep(spark, drop, EVENT_SCHEMA, out, checkpoint)
    stream.sweep(spark, drop, EVENT_SCHEMA, out, checkpoint)
    return _by_day(stream.read_catalog(spark, out))


@query(
    "stream_append_sink",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, COUNT(*) FILTER (event_type <> 'error') AS n_cells, COUNT(*) FILTER (event_type = 'error') AS n_bad,
    COUNT(*) FILTER (event_type = 'error') > 0 AS has_error FROM events GROUP BY 1""",
)
def stream_append_sink(spark, sf):
    drop, out, checkpoint = _paths(spark, "append")
    _drop(spark, sf, drop, break_errors=True)
    stream.sweep(spark, drop, EVENT_SCHEMA, out, checkpoint)
    return stream.read_catalog(spark, out).groupBy(F.regexp_replace("folder", "^day=", "").alias("day")).agg(
        F.sum("n_cells").alias("n_cells"), F.sum("n_bad").alias("n_bad"), (F.count("error") > 0).alias("has_error")
    )


@query(
    "stream_refresh_summary",
    """SELECT COUNT(DISTINCT strftime(ts, '%Y-%m-%d')) AS n_folders, COUNT(*) FILTER (event_type <> 'error') AS n_cells,
    COUNT(*) FILTER (event_type = 'error') AS n_bad FROM events""",
)
def stream_refresh_summary(spark, sf):
    drop, out, checkpoint = _paths(spark, "summary")
    _drop(spark, sf, drop, break_errors=True)
    stream.sweep(spark, drop, EVENT_SCHEMA, out, checkpoint, files_per_batch=20)
    totals = spark.read.parquet(f"{out}/totals")
    latest = totals.select(F.max("batch")).scalar()
    return totals.where(F.col("batch") == latest).select("n_folders", "n_cells", "n_bad")


@query("stream_drain_exit", _BY_DAY)
def stream_drain_exit(spark, sf):
    drop, out, checkpoint = _paths(spark, "drain")
    _drop(spark, sf, drop)
    sentinel = f"{out}-complete"
    spark.range(1).write.parquet(sentinel)
    stream.watch(spark, drop, EVENT_SCHEMA, out, checkpoint, sentinel, every="1 second")
    return _by_day(stream.read_catalog(spark, out))
