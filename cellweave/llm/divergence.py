"""How far the sources of a language stand apart, from stripes of term counts.

A task folds whole documents into stripes: for each language and term, in how
many documents the term occurs and how often it occurs in each source.  Stripes
that outgrow a task's memory are written out and folding starts anew, so every
task sends a term once for many documents.  Spark merges the stripes by key.

Merged stripes are dealt in bounded parts of a language's vocabulary.  A part
lays its stripes out as a matrix of terms and sources and gives the summed
differences of all pairs of sources over its terms, and each source's best
terms; sums and best terms of the parts are then put together.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.common import small_batches, texts_of
from cellweave.session import write_stage

LEAST_DOCUMENTS = 30
BEST = 50
#: Fixed values of the smoothed share: parts of one milliard, and what is added to every count.
SCALE_STEPS, ADDED = (1000, 1000, 1000), 5
#: (term, source) entries that a task holds before it writes its stripes out.
MOST_ENTRIES = 1_000_000
#: Cells of the matrix of terms and sources that one part of a vocabulary is meant to fill.
PART_CELLS = 1 << 20
_TERMS = re.compile(rb"[a-z\x80-\xff]+").findall  # of lower-cased UTF-8: letters, and all that is not ASCII


class Stripes:
    """Document frequency and source counts by language and term."""

    def __init__(self) -> None:
        self.df: dict[str, Counter] = {}
        self.counts: dict[tuple[str, str], Counter] = {}

    def fold(self, lang: str, source: str, texts: list[bytes]) -> None:
        """Add the documents of one source."""
        words = [_TERMS(t.lower()) for t in texts]
        self.df.setdefault(lang, Counter()).update(chain.from_iterable(map(set, words)))
        self.counts.setdefault((lang, source), Counter()).update(chain.from_iterable(words))

    def __len__(self) -> int:
        return sum(map(len, self.counts.values()))

    def spill(self, rows: int = 100_000) -> Iterator[pa.RecordBatch]:
        """The stripes as rows: one for each (language, term), with its sources as a list."""
        by_term: dict[str, dict[bytes, list]] = {lang: {} for lang in self.df}
        for (lang, source), counts in self.counts.items():
            stripes = by_term[lang]
            for term, n in counts.items():
                stripes.setdefault(term, []).append({"source": source, "n": n})
        kind = pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())]))
        for lang, stripes in by_term.items():
            terms, df = list(stripes), self.df[lang]
            for at in range(0, len(terms), rows):
                some = terms[at : at + rows]
                yield pa.record_batch(
                    {
                        "lang": pa.array([lang] * len(some), pa.string()), "term": pa.array(some, pa.binary()).cast(pa.string()),
                        "df": pa.array([df[t] for t in some], pa.int64()), "stripe": pa.array([stripes[t] for t in some], kind),
                    }
                )
        self.df.clear()
        self.counts.clear()


def stripes(docs: DataFrame, most: int = MOST_ENTRIES) -> DataFrame:
    """(lang, term, df, stripe) of every task; a term may come several times."""
    rows = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Stripes()
        for batch in small_batches(batches):
            texts = texts_of(batch)
            groups: dict[tuple, list[bytes]] = {}
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts):
                groups.setdefault((lang, source), []).append(text)
            for (lang, source), some in groups.items():
                held.fold(lang, source, some)
            if len(held) >= most:
                yield from held.spill()
        yield from held.spill()

    return rows.mapInArrow(run, "lang string, term string, df long, stripe array<struct<source:string, n:long>>")


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(1e9 * (count + 5) / total) by long division, exact while total is below 9e15."""
    rest, out = np.broadcast_arrays(count + ADDED, total)
    rest, out = rest.copy(), np.zeros(rest.shape, dtype=np.int64)
    for step in SCALE_STEPS:
        rest *= step
        out = out * step + rest // total
        rest %= total
    return out + 1


def _part(stripes: pa.Table, sources: pa.Table, best: int) -> pa.Table:
    """Pair sums and best terms of one part of a language's vocabulary."""
    names = sources.column("source").to_pylist()
    place = {s: i for i, s in enumerate(names)}
    lang = sources.column("lang")[0].as_py()
    total = sources.column("total").to_numpy()
    terms = stripes.column("term").to_pylist()
    sums = np.zeros((len(names), len(names)), dtype=np.int64)
    top: list[list[tuple[int, bytes, str]]] = [[] for _ in names]
    for at in range(0, len(terms), max(1, PART_CELLS // max(1, len(names)))):
        some = terms[at : at + max(1, PART_CELLS // max(1, len(names)))]
        counts = np.zeros((len(some), len(names)), dtype=np.int64)
        for row, stripe in enumerate(stripes.column("stripe").slice(at, len(some)).to_pylist()):
            for entry in stripe:
                counts[row, place[entry["source"]]] = entry["n"]
        p = share(counts, total[None, :])
        q = share(counts.sum(axis=1), np.int64(sources.column("lang_total")[0].as_py()))
        for i in range(len(names)):
            sums[i, i + 1 :] += np.abs(p[:, i + 1 :] - p[:, i : i + 1]).sum(axis=0)
            ahead = p[:, i] - q
            found = np.flatnonzero((counts[:, i] > 0) & (ahead > 0))
            if len(found) > best:  # those that tie with the last one stay for the order by name
                found = found[ahead[found] >= np.partition(ahead[found], len(found) - best)[len(found) - best]]
            top[i] += [(-int(ahead[t]), some[t].encode("utf-8"), some[t]) for t in found.tolist()]
            top[i] = sorted(top[i])[:best]
    i, j = np.triu_indices(len(names), 1)
    left = [*(names[a] for a in i), *(names[a] for a, t in enumerate(top) for _ in t)]
    item = [*(names[b] for b in j), *(x[2] for t in top for x in t)]
    value = [*sums[i, j].tolist(), *(-x[0] for t in top for x in t)]
    part = ["pair"] * len(i) + ["term"] * (len(left) - len(i))
    return pa.table(
        {
            "lang": pa.array([lang] * len(left), pa.string()), "source": pa.array(left, pa.string()), "part": pa.array(part, pa.string()),
            "item": pa.array(item, pa.string()), "value": pa.array(value, pa.int64()),
        }
    )


def divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, best: int = BEST, part_cells: int = PART_CELLS, most: int = MOST_ENTRIES) -> DataFrame:
    """(lang, source, part, item, value, rank): distances of sources, and the terms that set each apart.

    A null ``lang``, ``source`` or ``text`` counts as empty text; other columns
    are not looked at.  Terms of a language are those in at least ``least`` of
    its documents.  Part ``pair`` holds the summed difference of shares to each
    other source of the language (0 where no term is kept), part ``term`` the
    ``best`` terms that a source has above the language.  Every source that
    occurs has its pairs, even without terms; repeated rows count as often as
    they occur; an empty table gives an empty result.
    """
    mapped = write_stage(stripes(docs, most), "stripes")
    entries = mapped.select("lang", "term", F.explode("stripe").alias("entry")).groupBy("lang", "term", F.col("entry.source").alias("source"))
    frequent = mapped.groupBy("lang", "term").agg(F.sum("df").alias("df")).filter(F.col("df") >= least).select("lang", "term")
    kept = write_stage(entries.agg(F.sum("entry.n").alias("n")).join(frequent, ["lang", "term"]), "kept-terms")
    seen = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    sizes = kept.groupBy("lang").agg(F.countDistinct("term").alias("v"), F.sum("n").alias("lang_n"))
    sources = seen.join(kept.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left").join(sizes, "lang", "left")
    width = seen.groupBy("lang").agg(F.count(F.lit(1)).alias("width"))
    smooth = ADDED * F.coalesce("v", F.lit(0))
    sources = write_stage(
        sources.join(width, "lang").select(
            "lang", "source", (F.coalesce("n", F.lit(0)) + smooth).alias("total"), (F.coalesce("lang_n", F.lit(0)) + smooth).alias("lang_total"),
            F.ceil(F.coalesce("v", F.lit(0)) * F.col("width") / part_cells).alias("parts"),
        ),
        "sources",
    )
    parts = sources.groupBy("lang").agg(F.first("parts").alias("parts"))
    merged = kept.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "n")).alias("stripe")).join(parts, "lang")
    merged = merged.select("lang", F.pmod(F.xxhash64("term"), "parts").alias("piece"), "term", "stripe")
    beside = sources.filter("parts > 0")
    beside = beside.select("lang", "source", "total", "lang_total", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("piece"))

    def run(stripes: pa.Table, sources: pa.Table) -> pa.Table:
        return _part(stripes, sources, best)

    schema = "lang string, source string, part string, item string, value long"
    found = write_stage(merged.groupBy("lang", "piece").cogroup(beside.groupBy("lang", "piece")).applyInArrow(run, schema), "divergences")
    sums = found.filter("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    others = seen.join(seen.withColumnRenamed("source", "item"), "lang").filter("source <> item").join(both, ["lang", "source", "item"], "left")
    pairs = others.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    terms = found.filter("part = 'term'").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(terms)
