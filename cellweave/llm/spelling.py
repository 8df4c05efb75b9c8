"""Words that are one edit apart, found with blocked Gram matrices of letter counts.

An inserted, deleted or replaced letter moves a word's letter counts by a squared
distance of one or two.  Words are therefore dealt to blocks by their length and
by how many letters of each of a few letter classes they hold: these sums move
no further than the counts themselves, so only blocks at most two apart (squared), of equal
or adjacent length, can hold words that are near.  For two such blocks the
squared distances of all their words come from one NumPy product of the
letter-count matrices, |a|^2 + |b|^2 - 2ab; pairs at most two apart are verified
letter by letter.

Blocks are packed in tiles of bounded size, so a crowded block is only more
tiles.  A tile meets its partners one after another and answers with a count and
the best near word for each word, never with pairs.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import key_and_text, small_batches, texts_of
from cellweave.session import write_stage

SHORTEST, LEAST, RATIO = 7, 2, 10
#: One run in so many loses a letter.
SLIPS = 31
#: Words of one tile.
TILE = 1024
#: Distinct words that a counting task holds before it hands them on.
MOST_WORDS = 500_000
#: Fixed: A-Z lower-cased, then the letters U+00C0 to U+00FF, is the whole alphabet.
ALPHABET = "".join(map(chr, [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]))
_RUNS = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+").findall  # of lower-cased UTF-8


def _slip(word: bytes, crc: int) -> bytes:
    """The word without the letter that its crc points at."""
    letters = word.decode("utf-8")
    at = crc % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode("utf-8")


def runs_of(text: bytes, prefix: int, shortest: int) -> list[bytes]:
    """The words of one text that may have ``shortest`` letters, slips applied; ``prefix`` is the crc of the text's own key."""
    words = [w for w in _RUNS(text.lower()) if len(w) >= shortest]
    hashes = np.fromiter(map(crc32, words, repeat(prefix)), dtype=np.uint32, count=len(words))
    for i in np.flatnonzero(hashes % SLIPS == 0).tolist():
        words[i] = _slip(words[i], int(hashes[i]))
    return words


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST, least: int = LEAST, most: int = MOST_WORDS) -> DataFrame:
    """(word, n): distinct words of at least ``shortest`` letters that occur ``least`` times or more.

    One run in 31, by the crc32 of ``<key>:<run>``, loses a letter first, as a
    made misspelling.  Null keys count as empty text there, null texts as empty.
    """
    rows = key_and_text(docs, id_col, text_col).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.record_batch({"word": pa.array(list(held), pa.binary()).cast(pa.string()), "n": pa.array(list(held.values()), pa.int64())})

        for batch in small_batches(batches):
            for key, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                held.update(runs_of(text, crc32(key.encode("utf-8") + b":"), shortest))
            if len(held) >= most:
                yield out()
                held.clear()
        yield out()

    counted = rows.mapInArrow(run, "word string, n long").filter(F.char_length("word") >= shortest)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def class_count(words: int) -> int:
    """Letter classes for that many words: finer blocks for more words, with the same pairs found."""
    return int(np.clip(np.log2(max(words, 1)) // 2 - 2, 2, 12))


def letter_classes(classes: int) -> np.ndarray:
    """The class of each letter of the alphabet."""
    return np.arange(len(ALPHABET)) % classes


_PLACE = np.full(0x100, 0, dtype=np.int64)
_PLACE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))


def codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters as numbers from 1, one row per word, zeros behind; and the lengths."""
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    flat = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
    inside = np.arange(length.max(initial=0))[None, :] < length[:, None]
    out = np.zeros(inside.shape, dtype=np.uint8)
    out[inside] = _PLACE[flat] + 1
    return out, length


def letter_counts(code: np.ndarray) -> np.ndarray:
    """How often each letter occurs in each word."""
    n = len(code)
    flat = code + (len(ALPHABET) + 1) * np.arange(n)[:, None]
    return np.bincount(flat.ravel(), minlength=n * (len(ALPHABET) + 1)).reshape(n, -1)[:, 1:].astype(np.float32)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of codes are one insertion, deletion or replacement apart; ``b`` is as long or one letter longer."""
    width = max(a.shape[1], b.shape[1]) + 1
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    differs = a != b
    first = np.argmax(differs, axis=1)
    shifted = np.concatenate([b[:, 1:], np.zeros((len(b), 1), dtype=b.dtype)], axis=1)
    behind = np.arange(width)[None, :] >= first[:, None]
    longer = (b != 0).sum(axis=1) > (a != 0).sum(axis=1)
    return np.where(longer, ~((a != shifted) & behind).any(axis=1), differs.sum(axis=1) == 1)


def near_pairs(left: list[str], right: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places of near words; those on the right have the same length or one letter more."""
    a, b = codes(left)[0], codes(right)[0]
    p, q = letter_counts(a), letter_counts(b)
    squared = (p * p).sum(axis=1)[:, None] + (q * q).sum(axis=1)[None, :] - 2 * (p @ q.T)
    i, j = np.nonzero(squared <= 2)
    keep = one_edit(a[i], b[j])
    return i[keep], j[keep]


def blocks(words: DataFrame, classes: int, tile: int = TILE) -> DataFrame:
    """(block, tile, words, ns): the words as tiles, joined by blanks; a block is the word's number of letters in each class."""
    kind = letter_classes(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, _ = codes(batch.column("word").to_pylist())
            counts = letter_counts(code).astype(np.int64)
            sums = np.stack([counts[:, kind == c].sum(axis=1) for c in range(classes)], axis=1)
            yield pa.record_batch([*batch.columns, pa.array(sums.tolist(), pa.list_(pa.int32()))], ["word", "n", "block"])

    placed = write_stage(words.mapInArrow(run, "word string, n long, block array<int>"), "placed-words")
    sizes = placed.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / tile).alias("tiles"))
    dealt = placed.join(sizes, "block").withColumn("tile", F.pmod(F.xxhash64("word"), "tiles").cast("int"))
    packed = dealt.groupBy("block", "tile").agg(F.collect_list(F.struct("word", "n")).alias("w"))
    return write_stage(packed.select("block", "tile", F.array_join("w.word", " ").alias("words"), F.col("w.n").alias("ns")), "tiles")


def _moves(classes: int) -> list[list[int]]:
    """Differences of two blocks, one of each pair: none, one letter more, or one letter changed for another class."""
    unit = np.eye(classes, dtype=int)
    changed = [unit[c] - unit[d] for c in range(classes) for d in range(classes) if c < d]
    return [m.tolist() for m in [np.zeros(classes, dtype=int), *unit, *changed]]


def _pairs(tiles: DataFrame, classes: int) -> DataFrame:
    """Every pair of tiles that can hold near words, once, the shorter words left."""
    moves = F.array(*(F.array(*map(F.lit, m)) for m in _moves(classes)))
    heads = tiles.select("block", "tile")
    left = heads.select(F.col("block").alias("block_a"), F.col("tile").alias("tile_a"), F.explode(moves).alias("move"))
    left = left.withColumn("block_b", F.zip_with("block_a", "move", lambda x, m: x + m)).drop("move")
    right = heads.select(F.col("block").alias("block_b"), F.col("tile").alias("tile_b"))
    return left.join(right, "block_b").filter((F.col("block_a") != F.col("block_b")) | (F.col("tile_a") <= F.col("tile_b")))


class Best:
    """How many near words each word has, and the best of them."""

    def __init__(self) -> None:
        self.count: Counter = Counter()
        self.best: dict[str, tuple[int, str]] = {}

    def add(self, left: list[str], n: list[int], right: list[str], m: list[int], inside: bool) -> None:
        """Near words of two tiles; each pair is told once, so ``inside`` one tile only the second of two words."""
        for i, j in zip(*(x.tolist() for x in near_pairs(left, right))):
            if not inside or i < j:
                for word, other in ((left[i], (-m[j], right[j])), (right[j], (-n[i], left[i]))):
                    self.count[word] += 1
                    self.best[word] = min(self.best.get(word, other), other)

    def out(self) -> pa.RecordBatch:
        words, best = list(self.best), list(self.best.values())
        found = {"word": words, "n_near": [self.count[w] for w in words], "form_n": [-b[0] for b in best], "form": [b[1] for b in best]}
        self.__init__()
        return pa.record_batch({k: pa.array(v, pa.string() if k in ("word", "form") else pa.int64()) for k, v in found.items()})


def near(words: DataFrame, tile: int = TILE, classes: int | None = None) -> DataFrame:
    """(word, n_near, form_n, form): for each word with near words, how many, and the most frequent of them (ties: first by code point).

    A tile's partners follow it in one task, the tile itself first, and are
    multiplied a few tiles at a time.
    """
    tiles = blocks(words, classes := classes or class_count(words.count()), tile)
    right = tiles.select(*(F.col(c).alias(f"{c}_b") for c in ("block", "tile")), "words", "ns")
    both = _pairs(tiles, classes).join(right, ["block_b", "tile_b"])
    inside = (F.col("block_a") == F.col("block_b")) & (F.col("tile_a") == F.col("tile_b"))
    own = F.xxhash64("block_a", "tile_a")
    tasks = max(1, int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = both.select("block_a", "tile_a", inside.alias("inside"), "words", "ns").repartition(tasks, own)
    dealt = dealt.sortWithinPartitions("block_a", "tile_a", F.desc("inside"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, left, n, right, m = Best(), [], [], [], []
        for batch in batches:
            for inside, words, ns in zip(*(batch.column(c).to_pylist() for c in ("inside", "words", "ns"))):
                if (inside or len(right) >= 4 * tile) and right:
                    found.add(left, n, right, m, False)
                    right, m = [], []
                words = words.split(" ")
                if inside:
                    left, n = words, ns
                    found.add(left, n, left, n, True)
                else:
                    right += words
                    m += ns
                if len(found.best) >= 50_000:
                    yield found.out()
        if right:
            found.add(left, n, right, m, False)
        yield found.out()

    found = dealt.select("inside", "words", "ns").mapInArrow(run, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("minus"), "form"))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", (-F.col("best.minus")).alias("form_n"), F.col("best.form").alias("form"))


def _rooted(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: pointers are doubled until none moves."""
    now = write_stage(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = write_stage(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        now = moved.select("word", "root")
        if not moved.filter("moved").limit(1).count():
            return now


def variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shortest: int = SHORTEST, least: int = LEAST, ratio: int = RATIO, tile: int = TILE, classes: int | None = None,
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word.

    Near words are one inserted, deleted or replaced letter apart.  ``form`` is
    the most frequent near word where it occurs ``ratio`` times as often or
    more, ``root`` the last of the chain of forms, the word itself without one;
    chains end, since counts grow along them.  Null and wordless texts give no
    words, an empty table none; repeated rows count again.  ``tile`` and
    ``classes`` change the work, not the result.
    """
    counted = write_stage(words(docs, id_col, text_col, shortest, least), "words")
    joined = counted.join(near(counted, tile, classes), "word", "left")
    has = F.col("form_n") >= ratio * F.col("n")
    when: dict[str, Column] = {c: F.when(has, F.col(c)).alias(c) for c in ("form", "form_n")}
    graded = write_stage(joined.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), *when.values()), "graded")
    roots = _rooted(graded.filter("form is not null"))
    return graded.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
