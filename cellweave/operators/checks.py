"""Quality checks as tables; an empty or all-true result means the check holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return duplicate_keys(df, keys).agg(
        F.count("*").alias("n_duplicate_keys"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")
    ).withColumn("unique", F.col("n_duplicate_keys") == 0)


def required_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Per required field the rows where it is null; an absent field is null everywhere."""
    counts = [
        (F.count_if(F.col(f).isNull()) if f in df.columns else F.count("*")).alias(f) for f in fields
    ]
    return df.agg(F.count("*").alias("n_rows"), *counts).unpivot("n_rows", list(fields), "field", "n_missing").withColumn(
        "complete", F.col("n_missing") == 0
    )


def shape_match(declared: DataFrame, **tables: DataFrame) -> DataFrame:
    """Declared sizes (name, declared) against the rows of the named tables."""
    found = None
    for name, table in tables.items():
        one = table.agg(F.count("*").alias("found")).select(F.lit(name).alias("name"), "found")
        found = one if found is None else found.unionByName(one)
    return declared.join(found, "name", "left").withColumn("matches", F.col("declared") == F.col("found"))


def enough(df: DataFrame, group: str, n: int) -> DataFrame:
    """Per group the number of eligible features and whether it reaches ``n``."""
    return df.groupBy(group).agg(F.count("*").alias("n_eligible")).withColumn("enough", F.col("n_eligible") >= n)


def infer_types(df: DataFrame) -> DataFrame:
    """Per column the type its non-null texts allow: string, boolean or numeric, in one pass."""
    text = {c: F.col(c).cast("string") for c in df.columns}
    tests = []
    for c, t in text.items():
        tests += [
            F.count(t).alias(f"{c}__n"),
            F.count_if(F.lower(t).isin("true", "false")).alias(f"{c}__b"),
            F.count(t.try_cast("double")).alias(f"{c}__f"),
        ]
    sums = df.agg(*tests)
    rows = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"{c}__n").alias("n"), F.col(f"{c}__b").alias("b"), F.col(f"{c}__f").alias("f")) for c in df.columns]
    )
    kind = (
        F.when(F.col("n") == 0, "string")
        .when(F.col("b") == F.col("n"), "boolean")
        .when(F.col("f") == F.col("n"), "numeric")
        .otherwise("string")
    )
    return sums.select(F.explode(rows).alias("_r")).select("_r.*").select(
        "column", F.col("n").alias("n_values"), kind.alias("inferred")
    )
