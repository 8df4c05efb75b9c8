"""Context-tree scores: contract counts by brute force, blank blocks, odd rows, no training texts."""

import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cellweave.llm import ctw
from cellweave.llm.common import crc_fold

SCHEMA = "doc_id long, text string, block string, answers int, score double"
HELD = lambda: crc_fold(F.col("doc_id"), 7) == 2


def table(spark, rows):
    return spark.createDataFrame([(k, t, "b", 1, 0.5) for k, t in rows], SCHEMA)


def words(text):
    return [w for w in "".join(c if c not in "\t\n\x0b\x0c\r" else " " for c in (text or "").lower()).split(" ") if w]


@pytest.mark.parametrize("texts", [[""], ["", None], [" \n", "", None, "\t"], ["", "one word", None, " ", "One one two"]])
def test_blank_blocks_are_scored(spark, texts):
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in ctw.score(table(spark, rows).repartition(len(rows)), HELD()).collect()}
    train = [w for k, t in rows if zlib.crc32(str(k).encode()) % 7 != 2 for w in [*words(t), ""]]
    count = Counter(train)
    assert sorted(got) == list(range(len(rows)))
    for k, t in rows:
        own = [*words(t), ""]
        base = sum(math.log10((count[w] + 1) / (len(train) + len(count) + 1)) for w in own)
        assert (got[k].n_tokens, got[k].n_known, got[k].train_tokens) == (len(own), sum(count[w] > 0 for w in own), len(train))
        assert got[k].base_score == pytest.approx(base, abs=1e-9) and got[k].score <= 0 and math.isfinite(got[k].score)


def test_empty_table_and_no_training_texts(spark):
    assert ctw.score(table(spark, []), HELD()).count() == 0
    row = ctw.score(table(spark, [(1, "ab"), (None, None)]), F.lit(True)).orderBy("doc_id").collect()
    assert [r.train_tokens for r in row] == [0, 0] and row[1].score == pytest.approx(-3 * 8 * math.log10(2), rel=0.01)


def test_known_text_is_cheaper(spark):
    known, new = "the quick brown fox jumps over the lazy dog " * 4, "zqx vkj wpy qqz jxk vvw zzq kxj pqy wvk jqz xkq " * 4
    got = {r.doc_id: r for r in ctw.score(table(spark, [(1, known), (3, known), (4, known), (5, new)]), F.col("doc_id") == 5).collect()}
    assert got[1].bits_per_byte < 0.5 * got[5].bits_per_byte and got[1].score == got[3].score
