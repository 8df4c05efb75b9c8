"""SimHash near-duplicates, joined through pivot distance tables.

A fingerprint is placed by its Hamming distances to reference fingerprints.
Distances obey the triangle inequality, so two fingerprints that differ in at
most ``radius`` bits have no coordinate that differs by more than ``radius``.

Two families of references are used.

* Unit references: the zero fingerprint and the 64 fingerprints with one bit.
  The distance to a unit reference less the distance to zero is 1 or -1 by that
  one bit, so the table over a block of unit references *is* the block's bits
  and is read off as such.  Of ``2 * radius`` blocks at most ``radius`` hold a
  differing bit; two linked fingerprints hence agree in all coordinates of some
  ``radius`` blocks, which makes the search an equality join.
* Spread references: 16 fixed random fingerprints, whose distances are kept as
  one byte each.  A joined pair whose coordinates differ by more than ``radius``
  anywhere is discarded; the survivors are verified bit by bit.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.llm.common import key_and_text
from cellweave.llm.components import components
from cellweave.session import write_stage

SHINGLE = 3
RADIUS = 3
SPREAD = 16


def simhash(text: bytes, words: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text as an unsigned integer."""
    found = text.lower().split()
    if not found:
        return 0
    shingles = map(b" ".join, zip(*(found[i:] for i in range(words)))) if len(found) >= words else [b" ".join(found)]
    digest = xxhash.xxh64_intdigest
    return print_of(np.array([digest(s, 42) for s in shingles], dtype=np.uint64))


def print_of(hashes: np.ndarray) -> int:
    """The fingerprint of 64-bit hashes: a bit is 1 if it is set in over half of them."""
    hashes = hashes.astype(">u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


@F.pandas_udf(T.LongType())
def simhash_column(texts: pd.Series) -> pd.Series:
    prints = np.array([simhash(t.encode()) if t else 0 for t in texts], dtype=np.uint64)
    return pd.Series(prints.view(np.int64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, simhash) of every row; a null or wordless text has fingerprint 0."""
    return key_and_text(docs, id_col, text_col).select("doc_id", simhash_column("text").alias("simhash"))


def references() -> list[int]:
    """The spread references, as signed 64-bit integers; fixed by rule."""
    return [int(np.uint64(xxhash.xxh64_intdigest(b"reference %d" % i, 7)).astype(np.int64)) for i in range(SPREAD)]


def _table(print_col: Column) -> list[Column]:
    """Distances to the spread references, a byte each, eight to a long."""
    distances = [F.bit_count(print_col.bitwiseXOR(F.lit(r))).cast("long") for r in references()]
    packed = []
    for at in range(0, SPREAD, 8):
        one = distances[at]
        for k, d in enumerate(distances[at + 1 : at + 8], 1):
            one = one.bitwiseOR(F.shiftleft(d, 8 * k))
        packed.append(one)
    return packed


def _blocks(radius: int) -> list[int]:
    """Bit masks of 2 * radius blocks that cover 64 bits."""
    cuts = [round(64 * i / (2 * radius)) for i in range(2 * radius + 1)]
    return [((1 << b) - (1 << a)) for a, b in itertools.pairwise(cuts)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def linked_prints(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b), a < b: the distinct fingerprints that differ in at most ``radius`` bits.

    ``prints`` has one column ``simhash``.  Each pair is returned once: it counts
    only for the first choice of blocks in which it agrees.
    """
    masks = _blocks(radius)
    choices = [sum(c) for c in itertools.combinations(masks, radius)]
    own = prints.select("simhash").filter("simhash is not null").distinct()
    tables = own.withColumns({f"t{i}": t for i, t in enumerate(_table(F.col("simhash")))})
    keyed = write_stage(
        tables.select(
            F.posexplode(F.array(*[F.col("simhash").bitwiseAND(F.lit(_signed(m))) for m in choices])).alias("choice", "coordinates"), "simhash", "t0", "t1"
        ),
        "pivot-tables",
    )
    a, b = keyed.alias("a"), keyed.alias("b")
    near = [
        F.abs(F.shiftright(F.col(f"a.t{i}"), 8 * k).bitwiseAND(F.lit(255)) - F.shiftright(F.col(f"b.t{i}"), 8 * k).bitwiseAND(F.lit(255))) <= radius
        for i in range(SPREAD // 8)
        for k in range(8)
    ]
    differ = F.col("a.simhash").bitwiseXOR(F.col("b.simhash"))
    earlier = F.lit(len(choices))
    for n, m in reversed(list(enumerate(choices))):
        earlier = F.when(differ.bitwiseAND(F.lit(_signed(m))) == 0, n).otherwise(earlier)
    kept = F.col("a.simhash") < F.col("b.simhash")
    for one in near:
        kept = kept & one
    same = (F.col("a.choice") == F.col("b.choice")) & (F.col("a.coordinates") == F.col("b.coordinates"))
    return a.join(b, same & kept & (F.bit_count(differ) <= radius) & (earlier == F.col("a.choice"))).select(
        F.col("a.simhash").alias("a"), F.col("b.simhash").alias("b")
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """(doc_id, simhash, component_id) of every row.

    Rows with the same fingerprint, and rows whose fingerprints differ in at most
    ``radius`` bits, are linked; ``component_id`` is the smallest doc_id that can
    be reached.  Equal fingerprints are folded before the search, so copies cost
    one row.  Null and wordless texts share fingerprint 0 and are linked with one
    another.  A row without a doc_id is linked like any other but never names a
    component, unless no row of it has a key; repeated rows come back repeated;
    an empty table gives an empty result.
    """
    prints = write_stage(fingerprints(docs, id_col, text_col), "simhash")
    least = write_stage(prints.groupBy("simhash").agg(F.min("doc_id").alias("least")), "prints")
    links = write_stage(linked_prints(least, radius), "links")
    graph = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    grouped = graph.withColumnRenamed("node", "simhash").join(least, "simhash")
    smallest = grouped.groupBy("component").agg(F.min("least").alias("smallest"))
    moved = grouped.join(smallest, "component").select("simhash", "smallest")
    named = least.join(moved, "simhash", "left").select("simhash", F.coalesce("smallest", "least").alias("component_id"))
    return prints.join(named, "simhash").select("doc_id", "simhash", "component_id")
