"""Shards of bounded bytes by extendible hashing.

A shard is a hash prefix.  The directory starts with one bucket of no bits; a
bucket over the byte limit is split on its next bit, and no other bucket is
touched, until every bucket fits.  A bucket's bytes are sums over prefixes, so
all splits are found from one table of sums per prefix: the depth of a row is
one more than that of its deepest oversized prefix.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.session import write_stage

LIMIT = 1 << 20
BITS = 60
#: Bits looked at beyond the expected depth in one round; deeper buckets take another round.
SPARE = 4


def _depths(rows: DataFrame, base: int, fine: int, limit: int) -> DataFrame:
    """(cell, depth, full): for every prefix of ``fine`` bits its bucket's depth, and whether it needs more bits."""
    cells = rows.groupBy(F.shiftright("hash", BITS - fine).alias("cell")).agg(F.sum("n_bytes").alias("n_bytes"))
    levels = cells.select("cell", "n_bytes", F.explode(F.sequence(F.lit(base), F.lit(fine))).alias("depth"))
    levels = levels.withColumn("prefix", F.expr(f"shiftright(cell, {fine} - depth)"))
    over = levels.groupBy("depth", "prefix").agg(F.sum("n_bytes").alias("total")).filter(F.col("total") > limit)
    deepest = levels.join(over, ["depth", "prefix"]).groupBy("cell").agg((F.max("depth") + 1).alias("depth"))
    return cells.select("cell").join(deepest, "cell", "left").select("cell", F.coalesce("depth", F.lit(base)).alias("depth"))


def shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, shard, depth, oversized) of every row.

    ``shard`` is the bucket's hash prefix in binary (empty for the whole table),
    ``depth`` its length.  The hash is taken over the key and the number of the
    copy, so rows with a repeated key (a null key counts as one) spread like any
    others.  A text longer than ``limit`` cannot fit any shard: it gets a shard
    of its own, named by all its bits and marked ``oversized``.  A null text has
    no bytes.  All other shards hold ``limit`` bytes at most.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).cast("long").alias("n_bytes"))
    folded = rows.groupBy("doc_id", "n_bytes").agg(F.count(F.lit(1)).alias("copies"))
    every = folded.select("doc_id", "n_bytes", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    digest = F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("n_bytes").cast("string"), F.col("copy").cast("string")))
    staged = write_stage(every.select("doc_id", "n_bytes", F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long").alias("hash")), "hashes")
    small = staged.filter(F.col("n_bytes") <= limit)
    total = small.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    out = staged.filter(F.col("n_bytes") > limit).select("doc_id", "n_bytes", "hash", F.lit(BITS).alias("depth"), F.lit(True).alias("oversized"))
    base, fine, pending = 0, min(BITS, max(1, math.ceil(math.log2(max(1, total / limit)))) + SPARE), small
    while True:
        depths = write_stage(_depths(pending, base, fine, limit), "directory")
        placed = pending.join(depths, F.shiftright("hash", BITS - fine) == F.col("cell")).select("doc_id", "n_bytes", "hash", F.least("depth", F.lit(BITS)).alias("depth"))
        out = out.unionAll(placed.filter((F.col("depth") <= fine) | F.lit(fine == BITS)).withColumn("oversized", F.lit(False)))
        if fine == BITS or depths.filter(F.col("depth") > fine).isEmpty():
            break
        pending = write_stage(placed.filter(F.col("depth") > fine).drop("depth"), "pending")
        base, fine = fine, min(BITS, fine + SPARE + 4)
    bits = F.lpad(F.conv(F.col("hash").cast("string"), 10, 2), BITS, "0")
    return out.select("doc_id", "n_bytes", F.substring(bits, F.lit(1), F.col("depth")).alias("shard"), "depth", "oversized")
