"""One query per operator, over its whole table."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm import bpe, ctw, divergence, merkle, pseudonyms, quality, sharding, simhash, spelling, suffixes, token_files, toxicity, winnow
from cellweave.llm.common import crc_fold, read
from cellweave.llm.registry import ORACLES, QUERIES, query  # noqa: F401


@query("op10_simhash")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components over three-word shingles, at three bits."""
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


_WORDS4 = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')"


@query(
    "op4_winnowing",
    f"""
    WITH d AS (SELECT doc_id, coalesce({_WORDS4}, []) AS w FROM documents),
    i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS4} AS w FROM benchmark),
    iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS words
           FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM i WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT n FROM iw),
    dw AS (SELECT doc_id, p, n, array_to_string(w[p : p + n - 1], ' ') AS words
           FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)),
    hit AS (SELECT doc_id, p, n, item_id FROM dw JOIN iw USING (n, words)),
    covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS pos FROM hit) GROUP BY doc_id),
    named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
              FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents inside ten-word windows of benchmark items."""
    found = winnow.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op7_byte_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text and the bytes they decode to."""
    return bpe.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op9_suffix_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes inside 400-byte strings that start more than once."""
    found = suffixes.repeated_spans(read(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op3_context_tree")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every text, next to that of its words alone."""
    return ctw.score(read(spark, sf_dir, "documents"), crc_fold(F.col("doc_id"), 7) == 2)


def _judged(found: DataFrame, held_out: Column) -> DataFrame:
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text after noisy-channel restoration."""
    held_out = crc_fold(F.col("doc_id"), 5) == 0
    return _judged(toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), ~held_out), held_out)


@query("op8_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated quality of every whole text."""
    held_out = crc_fold(F.col("doc_id"), 3) == 1
    return _judged(quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), ~held_out), held_out)


@query("op5_merkle")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text."""
    return merkle.edits(read(spark, sf_dir, "documents"))


@query(
    "op6_sharding",
    """
    WITH d AS (SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes FROM documents),
    c AS (SELECT *, row_number() OVER (PARTITION BY doc_id, n_bytes) AS copy FROM d),
    h AS (SELECT doc_id, n_bytes, CAST('0x' || substr(md5(concat_ws(':', CAST(doc_id AS VARCHAR), CAST(n_bytes AS VARCHAR), CAST(copy AS VARCHAR))), 1, 15) AS BIGINT) AS hash FROM c),
    levels AS (SELECT doc_id, n_bytes, hash, unnest(range(0, 60)) AS depth FROM h WHERE n_bytes <= 1048576),
    over AS (SELECT depth, hash >> (60 - depth) AS prefix FROM levels GROUP BY 1, 2 HAVING sum(n_bytes) > 1048576),
    deep AS (SELECT hash, max(l.depth) + 1 AS depth FROM levels l JOIN over o ON l.depth = o.depth AND l.hash >> (60 - l.depth) = o.prefix GROUP BY hash)
    SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes,
           substr(lpad(bin(hash), 60, '0'), 1, CASE WHEN n_bytes > 1048576 THEN 60 ELSE coalesce(depth, 0) END) AS shard,
           CAST(CASE WHEN n_bytes > 1048576 THEN 60 ELSE coalesce(depth, 0) END AS INTEGER) AS depth, n_bytes > 1048576 AS oversized
    FROM h LEFT JOIN deep USING (hash)
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash-prefix shards of one mebibyte at most."""
    return sharding.shards(read(spark, sf_dir, "documents"))


@query("op2_pseudonyms")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms for personal data, and how many values were changed."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = pseudonyms.pseudonymize(docs, pseudonyms.session_key(spark))
    changed = F.size(F.filter("pii", lambda p: p["value"] != p["pseudonym"])).cast("long")
    shown = F.transform("pii", lambda p: F.struct(p["kind"].alias("kind"), p["pseudonym"].alias("pseudonym"), (p["value"] != p["pseudonym"]).alias("changed")))
    # values that failed validation stay in the text; of the others only the pseudonym leaves
    return found.select("doc_id", "text", changed.alias("n_changed"), F.filter(shown, lambda p: p["changed"]).alias("pii"))


@query(
    "op11_divergence",
    """
    WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                      regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{80}-\\x{10FFFF}]+') AS w
               FROM documents),
    groups AS (SELECT DISTINCT lang, source FROM d),
    t AS (SELECT doc, lang, source, unnest(w) AS term FROM d),
    keep AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
    sizes AS (SELECT lang, count(*) AS v FROM keep GROUP BY lang),
    c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN keep USING (lang, term) GROUP BY ALL),
    grid AS (SELECT lang, source, term, coalesce(n, 0) AS n FROM groups JOIN keep USING (lang) LEFT JOIN c USING (lang, source, term)),
    p AS (SELECT *, 1 + (1000000000 * CAST(n + 5 AS HUGEINT)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p FROM grid JOIN sizes USING (lang)),
    q AS (SELECT lang, term, 1 + (1000000000 * CAST(n + 5 AS HUGEINT)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q
          FROM (SELECT lang, term, v, sum(n) AS n FROM p GROUP BY ALL)),
    pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
             FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
              FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
    terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
               FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
    SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of the sources of each language, and the terms that set each apart."""
    return divergence.divergence(read(spark, sf_dir, "documents"))


@query("op12_token_files")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text, written to shards and read back by key."""
    docs = read(spark, sf_dir, "documents")
    files = token_files.write(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    found = token_files.read(files, docs)
    return found.select("doc_id", "start", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@query("op13_spelling")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words one edit apart, and the form each of them is a variant of."""
    return spelling.variants(read(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


query("pipeline")(corpus_pipeline.run)
