"""Near words and their forms against brute force, with small tiles and few classes."""

import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from cellweave.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int, block string"


def brute(rows, shortest=7, least=2, ratio=10):
    count = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= shortest:
                count[w] += 1
    n = {w: c for w, c in count.items() if c >= least}
    near = {w: set() for w in n}
    for a, b in combinations(n, 2):
        a, b = sorted((a, b), key=len)
        same = len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1
        if same or len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b))):
            near[a].add(b)
            near[b].add(a)
    form = {w: min(near[w], key=lambda v: (-n[v], v)) for w in n if near[w]}
    form = {w: f for w, f in form.items() if n[f] >= ratio * n[w]}
    root = {}
    for w in n:
        root[w] = w
        while root[w] in form:
            root[w] = form[root[w]]
    return {(w, form.get(w), root[w], n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(7)
    base = ["letters", "wonderful", "señoritas", "Øresunds", "abcdefgh", "hgfedcba", "stopping", "xxxxxxxx", "ÀÈÌÒÙÂÊÎ"]
    rows = []
    for i in range(60):
        words = []
        for _ in range(80):
            w = base[min(int(rng.exponential(1.2)), len(base) - 1)]
            at, kind = int(rng.integers(len(w))), rng.integers(14)
            new = "aeßxé"[rng.integers(5)]
            words.append(w[:at] + w[at + 1 :] if kind == 0 else w[:at] + new + w[at:] if kind == 1 else w[:at] + new + w[at + 1 :] if kind == 2 else w)
        rows.append((i if i % 9 else None, ", ".join(words), "w", 1, "b"))
    rows += [(100, None, "w", 1, "b"), (101, "", "w", 1, "b"), (102, "日本 1234 short", "w", 1, "b"), (3, rows[3][1], "w", 1, "b"), (3, rows[3][1], "w", 1, "b")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("limits", [{}, {"tile": 3, "classes": 3}])
def test_variants_match_brute_force(docs, limits):
    got = spelling.variants(docs, **limits).collect()
    want = brute(docs.collect())
    assert len(got) == len(want) and {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in got} == want
    assert any(form for _, form, *_ in want) and any(n > 2 for *_, n, _ in want)


def test_no_words(spark, docs):
    assert spelling.variants(docs.filter("false")).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id int, text string")).count() == 0


def test_chain_of_forms(spark):
    text = " ".join(["abcdefgh"] * 400 + ["abcdefgx"] * 40 + ["abcdefyx"] * 2)
    got = {r.word: (r.form, r.root) for r in spelling.variants(spark.createDataFrame([(1, text)], "doc_id int, text string")).collect()}
    want = {w: (f, root) for w, f, root, *_ in brute(spark.createDataFrame([(1, text)], "doc_id int, text string").collect())}
    assert got == want


def test_spilled_words_are_counted_whole(docs):
    whole = {(r.word, r.n) for r in spelling.words(docs).collect()}
    assert {(r.word, r.n) for r in spelling.words(docs, most=5).collect()} == whole
