"""Merkle trees over sections, paragraphs and spans of a text, and fingerprints of them.

A text is sections (parted by blank lines) of paragraphs (lines) of spans of
eight words.  Every level hashes the hashes below it, and joining the parts gives
the text back, so roots are equal when texts are, and two trees differ in the
branches that hold an edit.  A fingerprint is the root and a sketch of the tree's
spans: their 128 smallest hashes, from which the share of common spans is
estimated (exactly, for texts of up to 128 different spans).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.common import bound, key_and_text

SPAN_WORDS, SKETCH = 8, 128
#: Texts of a window partition, in bytes of the input, and at most so many partitions' bounds on the driver.
RANGE_BYTES, MOST_RANGES = 16 << 20, 4096


#: Up to eight words, each with the space after it; the matches of a paragraph join to it.
_SPAN = "(?:[^ ]* ){0,%d}[^ ]* ?" % (SPAN_WORDS - 1)


def tree(text: Column) -> Column:
    """sections: array of paragraphs, each the array of its spans' hashes."""
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n\n", -1),
        lambda section: F.transform(F.split(section, "\n", -1), lambda p: F.transform(F.regexp_extract_all(p, F.lit(_SPAN), 0), F.md5)),
    )


def paragraph_hashes(nodes: Column) -> Column:
    return F.transform(nodes, lambda section: F.transform(section, lambda spans: F.md5(F.array_join(spans, ""))))


def section_hashes(nodes: Column) -> Column:
    return F.transform(paragraph_hashes(nodes), lambda paragraphs: F.md5(F.array_join(paragraphs, "")))


def root(nodes: Column) -> Column:
    return F.sha2(F.array_join(section_hashes(nodes), ""), 256)


def sketch(nodes: Column) -> Column:
    """The smallest different span hashes, by their first eight digits."""
    spans = F.transform(F.flatten(F.flatten(nodes)), lambda h: F.substring(h, 1, 8))
    return F.slice(F.array_sort(F.array_distinct(spans)), 1, SKETCH)


def fingerprint(nodes: Column) -> Column:
    return bound(nodes, lambda t: F.concat(root(t), F.lit(":"), F.array_join(sketch(t), "")))


def spans_of(print_col: Column) -> Column:
    """The span hashes that a fingerprint holds."""
    return F.regexp_extract_all(F.substring_index(print_col, ":", -1), F.lit(".{8}"), 0)


def likeness(left: Column, right: Column) -> Column:
    """Share of common spans (Dice) estimated from two fingerprints, 1 when the roots are equal."""
    def dice(x: Column) -> Column:
        least = F.slice(F.array_sort(F.array_union(x["a"], x["b"])), 1, SKETCH)
        held = F.array_intersect(x["a"], x["b"])
        share = bound(least, lambda u: F.size(F.array_intersect(u, held)) / F.size(u))
        return bound(share, lambda j: 2 * j / (1 + j))

    apart = bound(F.struct(spans_of(left).alias("a"), spans_of(right).alias("b")), dice)
    return F.when(F.substring(left, 1, 64) == F.substring(right, 1, 64), 1.0).otherwise(apart)


def changed_sections(left: Column, right: Column) -> Column:
    """Indices of the sections whose branches differ; a missing section differs."""
    a, b = section_hashes(left), section_hashes(right)
    every = F.sequence(F.lit(0), F.greatest(F.size(a), F.size(b)) - 1)
    return F.filter(every, lambda i: ~F.get(a, i).eqNullSafe(F.get(b, i)))


def trees(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tree, fingerprint) of every row; a null text is empty and has one empty span."""
    return key_and_text(docs, id_col, text_col).withColumn("tree", tree(F.col("text"))).select("doc_id", "tree", fingerprint(F.col("tree")).alias("fingerprint"))


def with_next(rows: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """``rows`` with ``next_<column>`` of the row with the next larger key; after the last comes the first.

    Rows are cut into key ranges; every range also gets the first row of the range
    after it, so ranges are ordered each for itself and rows move once.  Keys are
    numbers; a null key counts as the smallest, rows of one key are ordered by
    their columns' hash.
    """
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    keyed = rows.withColumn("order", order)
    keys = keyed.select("order")
    size = keyed.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(columns[0])), F.lit(0))).first()
    n = int(min(MOST_RANGES, max(1, size[1] // RANGE_BYTES)))
    bounds = sorted({int(q) for q in keys.approxQuantile("order", [i / n for i in range(1, n)], 1 / (4 * n))}) if n > 1 and size[0] else []
    inside = keyed.withColumn("range", F.size(F.filter(F.array(*[F.lit(b) for b in bounds]).cast("array<long>"), lambda b: b <= F.col("order"))))
    firsts = sorted((r["range"], r["first"]) for r in inside.groupBy("range").agg(F.min("order").alias("first")).collect())
    after = {first: place for (_, first), place in zip(firsts[1:] + firsts[:1], [place for place, _ in firsts])}
    if not after:
        return rows.withColumns({f"next_{c}": F.col(c) for c in columns})
    before = F.element_at(F.create_map(*[F.lit(x) for pair in after.items() for x in pair]), F.col("order"))
    heads = keyed.filter(F.col("order").isin(list(after))).withColumn("range", before)
    both = inside.withColumn("extra", F.lit(0)).unionByName(heads.withColumn("extra", F.lit(1)))
    w = Window.partitionBy("range").orderBy("extra", "order", F.xxhash64(*columns))
    led = both.withColumns({f"next_{c}": F.lead(c).over(w) for c in columns})
    return led.filter("extra = 0").drop("order", "range", "extra")


def edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of texts, of their edited texts, and how alike they are.

    The edited text has its last quarter of code points replaced by the first as
    many of the next document in key order.  Null texts are empty.  Returns
    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next.
    """
    rows = key_and_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.withColumn("fingerprint", fingerprint(tree(F.col("text"))))
    paired = with_next(rows, "doc_id", ["text", "fingerprint"])
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    paired = paired.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next_text", F.lit(1), quarter)))
    paired = paired.withColumn("edited_fingerprint", fingerprint(tree(F.col("edited"))))
    return paired.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
