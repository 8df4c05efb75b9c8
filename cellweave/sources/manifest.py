"""Operators over a manifest of input files (sample, kind, path)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_modalities(names: DataFrame, column: str = "name", first: str = "RNA", second: str = "ATAC") -> DataFrame:
    """Pair ``<sample>_RNA`` with ``<sample>_ATAC``; unpaired samples are reported."""
    kind = F.regexp_extract(column, f"^(.*)_({first}|{second})$", 2)
    sample = F.regexp_extract(column, f"^(.*)_({first}|{second})$", 1).alias("sample")
    a = names.where(kind == first).select(sample, F.col(column).alias("_a")).distinct()
    b = names.where(kind == second).select(sample, F.col(column).alias("_b")).distinct()
    status = F.when(F.col("_b").isNull(), f"missing {second}").when(F.col("_a").isNull(), f"missing {first}").otherwise("paired")
    return a.join(b, "sample", "full").select("sample", F.col("_a").alias("first"), F.col("_b").alias("second"), status.alias("status"))


def validate_inputs(manifest: DataFrame, requested: DataFrame, required: Sequence[str]) -> DataFrame:
    """Per available or requested sample: the required inputs it lacks, and what follows from it."""
    have = manifest.groupBy("sample").agg(F.collect_set(F.when(F.col("kind").isin(list(required)), F.col("kind"))).alias("_have"))
    wanted = requested.select("sample").distinct().withColumn("requested", F.lit(True))
    both = have.join(wanted, "sample", "full")
    need = F.array_sort(F.array(*[F.lit(r) for r in required]))
    lacking = F.when(F.col("_have").isNull(), need).otherwise(F.array_sort(F.array_except(need, "_have")))
    status = (
        F.when(F.col("_have").isNull(), "requested but absent")
        .when(F.size(lacking) == 0, "valid")
        .when(F.col("requested"), "requested but incomplete")
        .otherwise("incomplete")
    )
    return both.select("sample", F.array_join(lacking, ", ").alias("missing"), status.alias("status"))


def provenance(sizes: DataFrame, key: str, notes: dict[str, str]) -> DataFrame:
    """One provenance record per data set: its sizes and the fixed notes, also as one JSON text."""
    fixed = [F.lit(text).alias(name) for name, text in notes.items()]
    record = sizes.select("*", *fixed)
    return record.withColumn("record", F.to_json(F.struct(*[c for c in record.columns])))
