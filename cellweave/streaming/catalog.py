"""The catalogue kept current from a drop folder by Structured Streaming."""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

CATALOG_SCHEMA = (
    "filename string, folder string, n_cells bigint, n_bad bigint, total_value double, error string, batch bigint"
)


def new_files(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Lines of unseen files below ``folder``, tagged with file and folder; hidden files are skipped."""
    return (
        spark.readStream.option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", "[!._]*").text(f"{folder}/*")
        .select(
            F.col("_metadata.file_path").alias("filename"),
            F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1).alias("folder"),
            "value",
        )
    )


def file_rows(lines: DataFrame, schema: str) -> DataFrame:
    """One catalogue row per file; lines that are not records are counted and named in ``error``."""
    parsed = lines.withColumn("_r", F.from_json("value", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"}))
    bad = F.col("_r").isNull() | F.col("_r._bad").isNotNull()
    rows = parsed.groupBy("filename", "folder").agg(
        F.count_if(~bad).alias("n_cells"),
        F.count_if(bad).alias("n_bad"),
        F.sum(F.when(~bad, F.col("_r.value"))).alias("total_value"),
    )
    message = F.when(F.col("n_bad") > 0, F.concat(F.col("n_bad").cast("string"), F.lit(" unreadable records")))
    return rows.withColumn("error", message)


def read_catalog(spark: SparkSession, out: str) -> DataFrame:
    """The catalogue so far; empty before the first batch."""
    try:
        return spark.read.schema(CATALOG_SCHEMA).option("basePath", f"{out}/rows").parquet(f"{out}/rows")
    except AnalysisException:
        return spark.createDataFrame([], CATALOG_SCHEMA)


def catalog_totals(rows: DataFrame) -> DataFrame:
    good = F.col("error").isNull()
    return rows.agg(
        F.count("*").alias("n_files"),
        F.count_distinct("folder").alias("n_folders"),
        F.coalesce(F.sum("n_cells"), F.lit(0)).alias("n_cells"),
        F.coalesce(F.sum("n_bad"), F.lit(0)).alias("n_bad"),
        F.count_if(good).alias("n_clean_files"),
    )


def _append(out: str, schema: str, batch: DataFrame, number: int) -> None:
    """Write one batch under its number, so a repeated batch replaces itself, then refresh the totals."""
    spark = batch.sparkSession
    known = read_catalog(spark, out).where(F.col("batch") != number).select("filename")
    fresh = file_rows(batch, schema).join(known, "filename", "left_anti")
    fresh.write.mode("overwrite").parquet(f"{out}/rows/batch={number}")
    catalog_totals(read_catalog(spark, out)).write.mode("overwrite").parquet(f"{out}/totals/batch={number}")


def _writer(spark: SparkSession, folder: str, schema: str, out: str, checkpoint: str, files_per_batch: int):
    return (
        new_files(spark, folder, files_per_batch).writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, number: _append(out, schema, batch, number))
    )


def sweep(spark: SparkSession, folder: str, schema: str, out: str, checkpoint: str, files_per_batch: int = 1000) -> None:
    """Process all files that are there and stop; a later call goes on from the checkpoint."""
    query = _writer(spark, folder, schema, out, checkpoint, files_per_batch).trigger(availableNow=True).start()
    query.awaitTermination()


def exists(spark: SparkSession, path: str) -> bool:
    """Is there a file at ``path`` on its file system?"""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target))


def watch(
    spark: SparkSession, folder: str, schema: str, out: str, checkpoint: str, sentinel: str, every: str = "60 seconds"
) -> None:
    """Poll the folder until the sentinel file is there, then sweep once more and stop."""
    query: StreamingQuery = (
        _writer(spark, folder, schema, out, checkpoint, 1000).trigger(processingTime=every).start()
    )
    try:
        while query.isActive and not exists(spark, sentinel):
            time.sleep(1)
        if query.isActive:
            query.processAllAvailable()
    finally:
        query.stop()
    sweep(spark, folder, schema, out, checkpoint)
