"""Toxicity through a noisy channel: restore obfuscated words, then score the restored text.

A written token is taken as a clean word sent through a channel that replaces
letters by look-alikes, repeats letters and inserts separators or spaces.  The
possible originals of a token form a lattice: a column of candidate letters per
symbol, with a cost for each substitution, repetition and deletion.  Where a
separator or space was written the lattice may also end a word, so joined and
spelled-out words come apart.  Viterbi decoding finds the original of least cost
under a trigram model of letters that is counted over the whole corpus.

Restored words are scored with a lexicon learned from labels: words are chosen
one at a time by the toxic documents that the words before them leave
unexplained, so words that merely keep company with toxic ones are not learned.
A logistic regression on the hits gives the score.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from cellweave.llm.common import key_and_text, small_batches, texts_of
from cellweave.session import write_stage

#: Symbols that stand for letters.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "abcdefghijklmnopqrstuvwxyz",
}
SEPARATORS = set(".-_~/\\'")
SWAP, REPEAT, DROP, EDGE = 1.0, 0.7, 6.0, 0.3
#: A letter written twice is mostly meant so; dropping one has to pay more than the letter that it saves.
DOUBLED = 2.5
#: Labelled rows that the classifier is fitted on, chosen by hash, and words looked at for the lexicon.
FIT_ROWS, CANDIDATES = 20_000, 2_000
#: Weight of the lexicon in the letter model that decodes documents.
LEXICON_SHARE = 0.05
_MEMO = 300_000
_CODE = np.zeros(256, dtype=np.int64)
_CODE[ord("a") : ord("z") + 1] = np.arange(1, 27)
_CODE[0x80:] = 27
_SYMBOLS = 28


def letter_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of letter trigrams over all texts, lower-cased; anything else bounds a word.

    At most 28 ** 3 = 21,952 sums reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SYMBOLS**3, dtype=np.int64)
        for batch in small_batches(batches, limit=1 << 20):
            code = _CODE[np.frombuffer(b"  ".join([b"", *texts_of(batch), b""]).lower(), dtype=np.uint8)]
            total += np.bincount((code[:-2] * _SYMBOLS + code[1:-1]) * _SYMBOLS + code[2:], minlength=_SYMBOLS**3)
        some = np.flatnonzero(total)
        yield pa.record_batch({"code": pa.array(some, pa.int64()), "n": pa.array(total[some], pa.int64())})

    rows = key_and_text(docs, text_col, text_col).select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(_SYMBOLS**3)
    for row in rows:
        out[row["code"]] = row["n"]
    return out


class Restorer:
    """Viterbi decoding of tokens under a letter trigram model."""

    def __init__(self, counts: np.ndarray) -> None:
        table = counts.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS) + 0.05
        self.cost = (-np.log(table / table.sum(axis=2, keepdims=True))).tolist()

    @staticmethod
    def noisy(token: str) -> bool:
        """Whether the lattice of a token has more than one path."""
        return not token.isalpha() or any(a == b for a, b in zip(token, token[1:]))

    @staticmethod
    def columns(token: str) -> list[list[tuple[str, float]]]:
        """Candidates (letters, channel cost) for each run of one symbol."""
        out = []
        runs = [(s, len(list(g))) for s, g in itertools.groupby(token)]
        for at, (symbol, n) in enumerate(runs):
            edge = at in (0, len(runs) - 1)
            options: list[tuple[str, float]] = []
            if symbol.isalpha():
                options += [(symbol, (0.0, 0.0, DOUBLED, REPEAT)[min(n, 3)]), *([(symbol * 2, REPEAT * (n > 2))] if n > 1 else [])]
            for letter in LOOK_ALIKES.get(symbol, ""):
                wild = math.log(26) if symbol == "*" else 0.0
                options += [(letter, SWAP + wild + REPEAT * (n > 1)), *([(letter * 2, SWAP + wild + REPEAT * (n > 2))] if n > 1 else [])]
            if not symbol.isalpha():
                options.append(("", EDGE if symbol in SEPARATORS or (edge and symbol not in "0123456789@$") else DROP))
                if symbol not in LOOK_ALIKES:
                    options.append((" ", EDGE))
            out.append(options)
        return out

    @staticmethod
    def spelled(letters: str) -> list[list[tuple[str, float]]]:
        """Columns of symbols written with a space after each, any of which may end a word."""
        out: list[list[tuple[str, float]]] = []
        for symbol, group in itertools.groupby(letters):
            n = len(list(group))
            options = Restorer.columns(symbol * n)[0]
            if n > 1:
                options = options + [(a + " " + a, price) for a, price in Restorer.columns(symbol)[0] if a not in ("", " ")]
            out += [options, [("", 0.0), (" ", 0.0)]]
        return out[:-1]

    def restore(self, token: str) -> str:
        """The likeliest clean word, or words with spaces between; clean tokens stay as they are."""
        token = token.strip(".,;:?#%&\"'()[]{}<>")
        for symbol in "!$*":
            if token.endswith(symbol * 2):
                token = token.rstrip(symbol)
        if not token or not self.noisy(token):
            return token
        return self.decode(self.columns(token))

    def decode(self, columns: list[list[tuple[str, float]]]) -> str:
        """The path of least cost through the lattice."""
        best = {(0, 0): (0.0, None, "")}
        for options in columns:
            step: dict[tuple[int, int], tuple] = {}
            for (a, b), path in best.items():
                for letters, price in options:
                    cost, x, y = path[0] + price, a, b
                    for letter in letters:
                        z = ord(letter) - 96 if "a" <= letter <= "z" else 27 * (letter != " ")
                        cost, x, y = cost + self.cost[x][y][z], y, z
                    if (x, y) not in step or cost < step[x, y][0]:
                        step[x, y] = (cost, path, letters)
            best = step
        path = min(((p[0] + self.cost[a][b][0], p) for (a, b), p in best.items()), key=lambda item: item[0])[1]
        letters = []
        while path is not None:
            letters.append(path[2])
            path = path[1]
        return " ".join("".join(reversed(letters)).split())

    def segment(self, letters: str) -> list[str]:
        """The words of a spelled-out run; as a whole, or without either end, it may be one word too."""
        out = self.decode(self.spelled(letters)).split()
        return out + [w for w in dict.fromkeys(self.restore(t) for t in (letters, letters[1:], letters[:-1])) if w not in out]

    def words(self, text: bytes) -> list[str]:
        """Restored words of a whole text, spaced-out words joined."""
        tokens = text.decode("utf-8", "replace").lower().split()
        return [*itertools.chain.from_iterable(self.restore(t).split() for t in tokens), *itertools.chain.from_iterable(self.segment(t) for t in spaced(tokens))]


def spaced(tokens: list[str]) -> list[str]:
    """Words written with spaces: joined runs of three or more tokens of one symbol."""
    out = []
    if sum(len(t) == 1 for t in tokens) >= 3:
        for single, run in itertools.groupby(tokens, key=lambda t: len(t) == 1 or (len(t) == 2 and t[1] in ".,!?-")):
            letters = [t[0] for t in run] if single else []
            if len(letters) >= 3:
                out.append("".join(letters))
    return out


class Hits:
    """Counts lexicon words in texts; what a token restores to is remembered."""

    def __init__(self, restorer: Restorer, lexicon: set[str]) -> None:
        self.restorer, self.lexicon, self.memo = restorer, lexicon, {}

    def one(self, token: str) -> list[str]:
        """Lexicon words of a token; one that starts with a space is a spelled-out run."""
        words = self.restorer.segment(token[1:]) if token[0] == " " else self.restorer.restore(token).split()
        found = [w for w in words if w in self.lexicon]
        if len(self.memo) >= _MEMO:
            self.memo.clear()
        if len(token) <= 40:
            self.memo[token] = found
        return found

    def of(self, text: bytes) -> list[str]:
        tokens = text.decode("utf-8", "replace").lower().split()
        memo, missing, out = self.memo, object(), []
        for token in itertools.chain(tokens, (" " + run for run in spaced(tokens))):
            found = memo.get(token, missing)
            if found is missing:
                found = self.one(token)
            if found:
                out += found
        return out


def _word_rows(sample: DataFrame, counts: np.ndarray) -> DataFrame:
    """(word, toxic, clean): in how many documents of either label a restored word occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(counts)
        for batch in small_batches(batches):
            seen: dict[str, list[int]] = {}
            for text, label in zip(texts_of(batch), batch.column("label").to_pylist()):
                for word in {w for w in restorer.words(text) if 3 <= len(w) <= 40}:
                    seen.setdefault(word, [0, 0])[1 - label] += 1
            yield pa.record_batch({"word": pa.array(list(seen), pa.string()), "toxic": pa.array([v[0] for v in seen.values()], pa.int64()), "clean": pa.array([v[1] for v in seen.values()], pa.int64())})

    rows = sample.select("text", "label").mapInArrow(run, "word string, toxic long, clean long")
    return rows.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _hit_rows(docs: DataFrame, counts: np.ndarray, lexicon: set[str]) -> DataFrame:
    """``docs`` with the lexicon words hit, without the text."""
    kept = [f for f in docs.schema.fields if f.name != "text"]

    told = counts.copy()
    for word in lexicon:  # the letter model also expects what the lexicon holds
        code = [0, 0, *(ord(c) - 96 if "a" <= c <= "z" else 27 for c in word), 0]
        for x, y, z in zip(code, code[1:], code[2:]):
            told[(x * _SYMBOLS + y) * _SYMBOLS + z] += LEXICON_SHARE * counts.sum() / len(lexicon) / len(word)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = Hits(Restorer(told), lexicon)
        for batch in small_batches(batches):
            found = pa.array([hits.of(t) for t in texts_of(batch)], pa.list_(pa.string()))
            yield pa.record_batch([*(batch.column(f.name) for f in kept), found], [*(f.name for f in kept), "hits"])

    return docs.mapInArrow(run, StructType([*kept, StructField("hits", ArrayType(StringType()))]))


def learn_lexicon(sample: DataFrame, counts: np.ndarray, toxic: int, clean: int) -> set[str]:
    """Words that mark toxic documents, chosen greedily by what is still unexplained.

    ``sample`` has at most FIT_ROWS rows, so the words of its toxic documents fit
    the driver.
    """
    odds = ((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("clean") + 0.5) / (clean + 1))
    asked = _word_rows(sample, counts).filter((F.col("toxic") >= 3) & (odds >= 8)).orderBy(F.desc("toxic"), "word").limit(CANDIDATES)
    candidates = {r["word"] for r in asked.collect()}
    rows = _hit_rows(sample.filter("label = 1").select("text"), counts, candidates).collect()
    left = [set(r["hits"]) for r in rows]
    found = Counter(itertools.chain.from_iterable(left))
    lexicon: set[str] = set()
    while left:
        tally = Counter(itertools.chain.from_iterable(left))
        word = min(tally, key=lambda w: (-tally[w], w)) if tally else None
        if word is None or tally[word] < max(3, 0.002 * len(rows)):
            break
        lexicon.add(word)
        left = [words for words in left if word not in words]
    # a word that others mostly cover is as telling as they are: keep all that are half as frequent as the most frequent
    often = {w: found[w] for w in candidates if found[w] >= 0.5 * max((found[c] for c in lexicon), default=1)}
    return lexicon | set(often)


def toxicity(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", whole_rows: bool = False) -> DataFrame:
    """(doc_id, score, hits) of every row of ``docs``; ``hits`` are the restored toxic words.

    With ``whole_rows`` a fourth column ``row`` holds the row as it came, so a
    caller can filter by the score without joining texts again.

    Labels are learned from rows where ``learn`` (over ``doc_id``) is true, at
    most FIT_ROWS of them.  Null and empty texts have no hits.  When the labels
    learned from lack one of the two classes, the score is their toxic share (0
    without any).  Rows without a label are scored only; repeated rows come back
    repeated; a label given twice counts by its largest value, and a labelled key
    that several rows share is learned from once, by its smallest text.
    """
    rows = key_and_text(docs, id_col, text_col)
    asked = rows if not whole_rows else docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.struct("*").alias("row"))
    carried = ["row"] if whole_rows else []
    counts = letter_counts(docs, text_col)
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter("label in (0, 1) and doc_id is not null")
    known = known.groupBy("doc_id").agg(F.max("label").alias("label")).filter(learn)
    total = known.count()
    kept = known if total <= FIT_ROWS else known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * 0.95 * FIT_ROWS / total))
    # at most about FIT_ROWS keys are broadcast, so only the texts of the sample move, once
    labelled = rows.join(F.broadcast(write_stage(kept, "labels")), "doc_id")
    sample = write_stage(labelled.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label")).select("text", "label"), "sample")
    tally = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = tally.get(1, 0), tally.get(0, 0)
    if not toxic or not clean:
        share = toxic / (toxic + clean) if toxic + clean else 0.0
        return asked.select("doc_id", F.lit(share).alias("score"), F.array().cast("array<string>").alias("hits"), *carried)
    lexicon = learn_lexicon(sample, counts, toxic, clean)
    features = array_to_vector(F.array(F.log1p(F.size("hits").cast("double")), F.log1p(F.size(F.array_distinct("hits")).cast("double")), (F.size("hits") > 0).cast("double")))
    seen = write_stage(_hit_rows(sample, counts, lexicon), "sample-hits")
    fitted = LogisticRegression(regParam=0.001, maxIter=50).fit(seen.select(features.alias("features"), F.col("label").cast("double").alias("label")))
    a, (b, c, d) = float(fitted.intercept), (float(x) for x in fitted.coefficients)
    margin = F.lit(a) + b * F.log1p(F.size("hits").cast("double")) + c * F.log1p(F.size(F.array_distinct("hits")).cast("double")) + d * (F.size("hits") > 0).cast("double")
    return _hit_rows(asked, counts, lexicon).select("doc_id", (1 / (1 + F.exp(-margin))).alias("score"), "hits", *carried)
