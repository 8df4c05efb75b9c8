"""The corpus pipeline: documents in, tokenised clean documents out.

Every stage takes the documents that the stage before it kept and returns a
table of the same columns; the last returns token counts and digests.  Each
stage's result is written to the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm import bpe, pseudonyms, similar, toxicity, winnow
from cellweave.llm.common import read
from cellweave.session import write_stage


#: Rows of one Arrow batch: whole texts travel, and a batch is held by the JVM and by the Python worker.
BATCH_ROWS = 1000


def hold_batches_small(spark: SparkSession) -> None:
    """From now on the session's Arrow batches have at most BATCH_ROWS rows; a smaller setting stays."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(setting))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(setting, str(BATCH_ROWS))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score is below one half; labels of all rows are learned from.

    Each row is judged by its own text, so repeated or missing keys need no rule.
    """
    hold_batches_small(spark)
    judged = toxicity.toxicity(docs, read(spark, sf_dir, "labels"), F.lit(True), whole_rows=True)
    return judged.filter("score < 0.5").select("row.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: that with the smallest doc_id, of equal ones the first.

    Near-duplicates share 0.8 or more of their five-word shingles.  SimHashes that the pivot distance tables link are
    candidates first; at that similarity fingerprints differ in up to 14 bits, too many for pivot distances to tell pairs
    apart, so min-hash bands name the candidates that are left.  Rows are judged by themselves, so null, repeated or
    clashing keys drop no other row; a group of rows without keys keeps one too.
    """
    hold_batches_small(spark)
    return similar.one_of_each(docs, words=5, similarity=0.8)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that share no ten-word window with a benchmark item.

    Each row is judged by its own text, so repeated or missing keys need no rule.
    """
    hold_batches_small(spark)
    rows = docs.select(F.struct("*").alias("doc_id"), "text")
    return winnow.contamination(rows, read(spark, sf_dir, "benchmark")).filter("n_hit = 0").select("doc_id.*")


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data; n_chars is counted again."""
    return pseudonyms.pseudonymize(docs, pseudonyms.session_key(spark)).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of the bytes they decode to."""
    hold_batches_small(spark)
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("near-dedup by simhash and min-hash", keep_one_of_each),
    ("benchmark decontamination", drop_contaminated),
    ("pii pseudonyms", replace_pii),
    ("byte-level bpe", tokenise),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
