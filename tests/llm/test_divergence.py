"""Source divergences against brute force: spilled stripes, small parts, nulls, ties, no kept terms."""

import re
from collections import Counter

import numpy as np
import pytest

from cellweave.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, n int, item string"


def brute(rows, least, best):
    docs = [(r.lang or "", r.source or "", re.findall("[A-Za-z\x80-\U0010ffff]+", r.text or "")) for r in rows]
    docs = [(lang, source, ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]) for lang, source, words in docs]
    out = set()
    for lang in {d[0] for d in docs}:
        df = Counter(w for d in docs if d[0] == lang for w in set(d[2]))
        keep = sorted(w for w in df if df[w] >= least)
        groups = {}
        for d in docs:
            if d[0] == lang:
                groups.setdefault(d[1], Counter()).update(w for w in d[2] if w in df and df[w] >= least)
        share = lambda c: {w: 1 + 1_000_000_000 * (c[w] + 5) // (sum(c.values()) + 5 * len(keep)) for w in keep}
        q = share(sum(groups.values(), Counter()))
        for source, counts in groups.items():
            p = share(counts)
            pairs = [(sum(abs(p[w] - o[w]) for w in keep), other) for other, c in groups.items() if other != source for o in [share(c)]]
            terms = [(p[w] - q[w], w) for w in keep if counts[w] > 0 and p[w] > q[w]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, source, part, item, v, k) for k, (v, item) in enumerate(found, 1) if part == "pair" or k <= best}
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(4)
    terms = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(70)] + ["É", "日本", "é"]
    rows = []
    for i in range(150):
        words = [terms[min(int(rng.exponential(9)) + (i % 4), len(terms) - 1)] for _ in range(int(rng.integers(0, 40)))]
        rows.append((i, " 7_".join(words).title() if i % 2 else ", ".join(words), ["en", "de", None][i % 3], [f"s{i % 5}", None, ""][int(i % 11 == 0) + int(i % 13 == 0)], 1, "x"))
    rows += [(None, None, "en", "silent", 1, "x"), (None, None, "en", "silent", 1, "x"), (500, "rare words only", "xx", "a", 1, "x"), (501, "", "xx", "b", 1, "x")]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.mark.parametrize("limits", [{}, {"most": 20, "part_cells": 12}])
def test_divergence_matches_brute_force(docs, limits):
    got = divergence.divergence(docs, least=10, best=6, **limits).collect()
    want = brute(docs.collect(), 10, 6)
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert {w[2] for w in want} == {"pair", "term"} and ("xx", "a", "pair", "b", 0, 1) in want


def test_empty_table_and_exact_shares(docs):
    assert divergence.divergence(docs.filter("false")).count() == 0
    for count, total in ((0, 7), (10**12, 10**13 + 7), (3, 3_000_000_019), (8_999_999_999_999_990, 8_999_999_999_999_999)):
        assert divergence.share(np.array([count]), np.array([total])).tolist() == [1 + 10**9 * (count + 5) // total]
