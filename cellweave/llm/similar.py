"""Near-duplicates by exact Jaccard similarity of word shingles.

Texts of one shingle set are folded first.  Candidates then come in two steps.

* SimHash: the fingerprints of the shingle sets are joined through the pivot
  distance tables of ``simhash``; every member of a linked group is held against
  one member of it.
* Min-hash bands, for texts that are similar but differ in more bits: every
  shingle set has ``BANDS`` keys, each of ``ROWS`` minima, and two sets of
  similarity s share a key with probability 1 - (1 - s ** ROWS) ** BANDS, which
  is 0.9996 at 0.8.  A key of one set alone is dropped at once.

A candidate is linked only when the similarity of its two texts, counted over
the shingles themselves, reaches the threshold.

In a crowded key one member of every component found so far is held against one
hub, round after round, so a large group of near copies costs a few rows per
member; pairs that are left apart when a round connects nothing are then
compared as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from cellweave.llm import simhash
from cellweave.llm.common import small_batches, split_by_keys, texts_of
from cellweave.llm.components import components
from cellweave.session import write_stage

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 5
#: The first rounds look at so many bands only.
FIRST_BANDS, FIRST_ROUNDS = 3, 2
#: Pairs left apart for each different text from which another round is worth its cost, and up to which a slow round is the last.
FEW, MANY = 2, 100
#: A round that leaves more than this share of the pairs apart is slow.
SLOW = 0.9
#: Different texts of which one task handles the keys in a round; small tables are written by few tasks, large ones by more.
NODES_A_TASK = 20_000
#: Texts of a group when pairs are verified, and shingles that a task keeps beyond those of the pair at hand.
CELL, HELD_SHINGLES = 64, 200_000
_FACTORS = np.random.default_rng(20).integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_MASKS = np.random.default_rng(21).integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)


def shingles(text: bytes, words: int = WORDS) -> set[bytes]:
    """The different shingles of a text; one shorter than a shingle is a shingle itself."""
    found = text.lower().split()
    if 0 < len(found) < words:
        return {b" ".join(found)}
    return set(map(b" ".join, zip(*(found[i:] for i in range(words)))))


def signature(text: bytes, words: int = WORDS) -> tuple[str, int, int, list[int]]:
    """A digest of the shingle set, its size, its SimHash and its band keys; a wordless text has no keys."""
    digest = xxhash.xxh64_intdigest
    hashes = np.unique(np.array([digest(s, 42) for s in shingles(text, words)], dtype=np.uint64))
    node = xxhash.xxh3_128_hexdigest(hashes.tobytes())
    if not len(hashes):
        return node, 0, 0, []
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(low), 4096):
        part = low[None, at : at + 4096] ^ _MASKS[:, None]
        part *= _FACTORS[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    keys = [xxhash.xxh64_intdigest(band.tobytes(), i) for i, band in enumerate(least.reshape(BANDS, ROWS))]
    return node, len(hashes), int(np.uint64(simhash.print_of(hashes)).astype(np.int64)), np.array(keys, dtype=np.uint64).view(np.int64).tolist()


def signatures(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, place, doc_id, text, node, n, simhash, keys) of every row: the row as a struct, its number, and its text's signature."""
    rows = docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            text = pc.struct_field(whole.column("row"), text_col).cast(pa.string())
            for batch in small_batches(iter([whole.append_column("_text", text)]), "_text"):
                found = [signature(t, words) for t in texts_of(batch, "_text")]
                node, n, fingerprint, keys = zip(*found) if found else ((), (), (), ())
                added = [pa.array(node, pa.string()), pa.array(n, pa.int64()), pa.array(fingerprint, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
                yield pa.record_batch([batch.column("row"), batch.column("place"), *added], schema.names)

    added = [StructField("node", StringType()), StructField("n", LongType()), StructField("simhash", LongType()), StructField("keys", ArrayType(LongType()))]
    schema = StructType([*rows.schema.fields, *added])
    found = write_stage(rows.mapInArrow(run, schema), "signatures")
    return found.select("row", "place", F.col(f"row.`{id_col}`").alias("doc_id"), F.col(f"row.`{text_col}`").cast("string").alias("text"), "node", "n", "simhash", "keys")


def _may_reach(n: Column, m: Column, similarity: float) -> Column:
    """Sets of these sizes can be that similar."""
    return F.least(n, m) >= F.lit(similarity) * F.greatest(n, m)


def verified(pairs: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs (a, b, ...) whose texts have at least this similarity.

    Nodes are dealt into groups of about ``CELL``; a cell holds the pairs of two groups and each of
    their texts once, so many pairs among few texts do not carry a text each.
    """
    asked = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node")))
    asked = write_stage(split_by_keys(texts, asked, "node")[0], "asked-texts")
    groups, columns = 1 + asked.count() // CELL, pairs.columns
    group = lambda node: F.pmod(F.xxhash64(node), F.lit(groups))
    celled = pairs.select((group("a") * groups + group("b")).alias("cell"), F.struct(*columns).alias("pair"))
    ends = celled.select("cell", F.col("pair.a").alias("node")).unionAll(celled.select("cell", F.col("pair.b").alias("node"))).distinct()
    rows = ends.join(asked, "node").select("cell", "node", "text").unionByName(celled, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, sets, size = None, {}, {}, 0  # texts of the cell, and shingles of some of them

        def of(node: object) -> set[bytes]:
            nonlocal size
            if node not in sets:
                if size > HELD_SHINGLES:
                    sets.clear()
                    size = 0
                sets[node] = shingles(held[node], words)
                size += len(sets[node])
            return sets[node]

        for batch in batches:
            ends, keep = batch.column("pair"), []
            a, b = (pc.struct_field(ends, c).to_pylist() for c in "ab")
            for at, (now, node, text) in enumerate(zip(batch.column("cell").to_pylist(), batch.column("node").to_pylist(), texts_of(batch))):
                if now != cell:
                    cell, held, size = now, {}, 0
                    sets.clear()
                if node is not None:
                    held[node] = text
                    continue
                left, right = of(a[at]), of(b[at])
                common = len(left & right)
                if common >= similarity * (len(left) + len(right) - common):
                    keep.append(at)
            yield pa.record_batch(ends.take(pa.array(keep, pa.int64())).flatten(), columns)

    # a cell's texts (without a pair) come before its pairs
    rows = rows.repartition("cell").sortWithinPartitions("cell", "pair")
    return write_stage(rows.mapInArrow(run, pairs.schema), "links")


def _relabelled(now: DataFrame, found: DataFrame) -> DataFrame:
    """``now`` with the components that the found pairs connect under one name; only components with a pair are looked at."""
    graph = components(found.select(F.col("ca").alias("u"), F.col("cb").alias("v"))).distinct()
    moved = now.join(graph.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
    return moved.select("node", F.coalesce("to", "component").alias("component"))


def print_links(nodes: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """(a, b): each node of a group of linked SimHashes with the hub of its group, as far as their texts are similar."""
    worded = nodes.filter("n > 0")
    near = write_stage(simhash.linked_prints(worded.select("simhash")), "print-links")
    graph = components(near.select(F.col("a").alias("u"), F.col("b").alias("v"))).distinct()
    grouped = worded.join(graph.select(F.col("node").alias("simhash"), "component"), "simhash", "left")
    grouped = write_stage(grouped.select("node", "n", F.coalesce("component", "simhash").alias("group")), "print-groups")
    pick = F.min(F.struct(F.xxhash64("node").alias("place"), "node", "n")).alias("hub")
    hubs = write_stage(grouped.groupBy("group").agg(pick, F.count(F.lit(1)).alias("m")).filter("m > 1").select("group", "hub"), "print-hubs")
    held = grouped.join(hubs, "group").filter(F.col("node") != F.col("hub.node")).filter(_may_reach(F.col("n"), F.col("hub.n"), similarity))
    return verified(write_stage(held.select(F.col("node").alias("a"), F.col("hub.node").alias("b")), "pairs"), texts, words, similarity)


def shared_keys(nodes: DataFrame) -> DataFrame:
    """(node, n, band, key): the band keys that more than one node has; the others can link nothing."""
    postings = nodes.select("node", "n", F.posexplode("keys").alias("band", "key"))
    shared = write_stage(postings.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("key"), "shared-keys")
    return write_stage(postings.join(shared, "key", "left_semi").select("node", "n", "band", "key"), "postings")


def links_of(rows: DataFrame, nodes: DataFrame, words: int, similarity: float) -> DataFrame:
    """(a, b): links that connect what pairs of that similarity among the candidates connect.

    ``nodes`` (node, n, simhash, keys) names a shingle set by the place of one of
    its ``rows``.  After the SimHash step a round compares, in every key whose
    members are not all connected, one member of each component with one hub; the
    hubs of a node's keys are mostly the same node, chosen by a hash of node and
    round.  When few pairs are left apart, or a round connects nothing or next to
    nothing, these pairs are compared as they are.
    """
    texts = rows.select(F.col("place").alias("node"), "text")
    links = print_links(nodes, texts, words, similarity)
    tried, total, held = links, nodes.count(), shared_keys(nodes)
    tasks = 1 + total // NODES_A_TASK
    now = write_stage(held.select("node", F.col("node").alias("component")).distinct().coalesce(tasks), "labelled")
    # only nodes with a shared key are asked for again, so the rounds do not read the other texts
    texts = write_stage(split_by_keys(texts, now.select("node"), "node")[0], "shared-texts")
    known = links.select("a", "b", F.col("a").alias("ca"), F.col("b").alias("cb"))
    now = write_stage(_relabelled(now, known).coalesce(tasks), "labelled")
    before = float("inf")
    for attempt in range(1 << 30):
        # the first rounds look at few bands, which connect most of a large group of near copies
        bands = FIRST_BANDS if attempt < FIRST_ROUNDS else BANDS
        postings = held.filter(F.col("band") < bands).join(now, "node")
        pick = F.min(F.struct(F.xxhash64("node", F.lit(attempt)).alias("place"), "node", "n", "component")).alias("pick")
        reps = write_stage(postings.coalesce(tasks).groupBy("key", "component").agg(pick, F.count(F.lit(1)).alias("m")).coalesce(tasks), "reps")
        apart = F.pow(F.sum("m"), 2) - F.sum(F.pow("m", F.lit(2)))
        hubs = write_stage(reps.groupBy("key").agg(F.min("pick").alias("hub"), apart.alias("apart")).filter("apart > 0").coalesce(tasks), "hubs")
        if attempt >= FIRST_ROUNDS:
            left = (hubs.agg(F.sum("apart")).first()[0] or 0) / 2
            if left <= FEW * total or (left > SLOW * before and left <= MANY * total):
                break
            before = left
        around = reps.join(hubs, "key").coalesce(tasks).filter(F.col("pick.node") != F.col("hub.node")).filter(_may_reach(F.col("pick.n"), F.col("hub.n"), similarity))
        ends = F.struct("pick.node", "pick.component").alias("x"), F.struct("hub.node", "hub.component").alias("y")
        around = around.select(*ends).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct().coalesce(tasks)
        pairs = around.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.component").alias("ca"), F.col("y.component").alias("cb"))
        pairs = write_stage(pairs.join(tried, ["a", "b"], "left_anti").coalesce(tasks), "pairs")
        tried = tried.unionAll(pairs.select("a", "b"))
        found = verified(pairs, texts, words, similarity)
        if found.isEmpty():
            if attempt >= FIRST_ROUNDS:
                break
            continue
        links = links.unionAll(found.select("a", "b"))
        now = write_stage(_relabelled(now, found).coalesce(tasks), "labelled")
    postings = write_stage(held.join(now, "node"), "postings")
    apart = postings.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("key")
    shared = write_stage(postings.join(apart, "key", "left_semi"), "shared")
    a, b = shared.alias("a"), shared.alias("b")
    both = (F.col("a.key") == F.col("b.key")) & (F.col("a.node") < F.col("b.node")) & (F.col("a.component") != F.col("b.component"))
    pairs = a.join(b, both & _may_reach(F.col("a.n"), F.col("b.n"), similarity)).select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()
    left = write_stage(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
    return links.unionAll(verified(left, texts, words, similarity).select("a", "b"))


def _named(rows: DataFrame, words: int, similarity: float) -> DataFrame:
    """(node, first): the first row (none, doc_id, place) of each node's group; rows without a key come last."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "place")
    same = [F.first(c).alias(c) for c in ("n", "simhash", "keys")]
    nodes = write_stage(rows.groupBy("node").agg(F.min(order).alias("first"), F.min("place").alias("at"), *same), "nodes")
    links = links_of(rows, nodes.select(F.col("at").alias("node"), "n", "simhash", "keys"), words, similarity)
    graph = components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))).distinct()
    least = nodes.select("node", "at", "first")
    grouped = graph.select(F.col("node").alias("at"), "component").join(least, "at")
    smallest = grouped.groupBy("component").agg(F.min("first").alias("smallest"))
    moved = grouped.join(smallest, "component").select("node", "smallest")
    return least.join(moved, "node", "left").select("node", F.coalesce("smallest", "first").alias("first"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, component_id) of every row.

    Texts whose sets of ``words``-word shingles have a Jaccard similarity of at
    least ``similarity`` are linked; ``component_id`` is the smallest doc_id that
    can be reached.  Null and wordless texts are linked with one another.  A row
    without a doc_id is linked like any other but never names a component, unless
    no row of it has a key; repeated rows come back repeated; an empty table gives
    an empty result.
    """
    rows = signatures(docs, words, id_col, text_col)
    named = _named(rows, words, similarity)
    return rows.select("doc_id", "node").join(named, "node").select("doc_id", F.col("first.doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one of the smallest doc_id, among equal keys the first by place.

    Groups are those of ``near_duplicates``.  Rows are told apart by their place, so a group
    of repeated rows, or of rows without keys, keeps exactly one, and keys that clash drop nothing.
    Whole rows are shuffled only where the bit table of dropped places leaves it open whether they stay.
    """
    rows = signatures(docs, words, id_col, text_col)
    kept = _named(rows, words, similarity).select("first.place").distinct()
    dropped = write_stage(rows.select("place").join(kept, "place", "left_anti"), "dropped")
    asked, staying = split_by_keys(rows.select("row", "place"), dropped, "place")
    return staying.unionAll(asked.join(dropped, "place", "left_anti").select("row", "place")).select("row.*")
