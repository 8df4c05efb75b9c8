"""Writers: partitioned tables, CSV exports and JSON rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_samples(df: DataFrame, path: str, sample: str, per_sample: bool = True, combined: bool = False) -> None:
    """One folder per sample, and / or one combined table.

    A sample is written by as many tasks as hold its rows; a hot sample is not
    drawn into one task.
    """
    if per_sample:
        df.write.partitionBy(sample).parquet(f"{path}/samples")
    if combined:
        df.write.parquet(f"{path}/combined")


def write_csv_tables(tables: dict[str, DataFrame], path: str) -> None:
    """Every table as gzip CSV with a header below ``path``."""
    for name, table in tables.items():
        table.write.option("header", True).option("compression", "gzip").csv(f"{path}/{name}")


def json_rows(df: DataFrame, *columns: str) -> Column:
    """One JSON object per row of the given (or all) columns."""
    return F.to_json(F.struct(*(columns or df.columns)))
