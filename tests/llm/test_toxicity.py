"""Every channel of the noise reaches the lattice: doubled letters, spelled-out and joined words."""

import numpy as np
import pytest

from cellweave.llm import toxicity

CLEAN = "you are an idiot and a stupid moron but the letter is good and all will see the pretty summer off tree of a book".split()


@pytest.fixture(scope="module")
def restorer():
    counts = np.zeros(28**3)
    for before, word in zip([" ", *CLEAN], CLEAN):
        code = [ord(before[-1]) - 96 if before != " " else 0, 0, *(ord(c) - 96 for c in word), 0]
        for x, y, z in zip(code, code[1:], code[2:]):
            counts[(x * 28 + y) * 28 + z] += 100
    return toxicity.Restorer(counts)


@pytest.mark.parametrize("written,words", [
    ("stuupid", "stupid"), ("iddiot", "idiot"), ("mooronn", "moron"), ("you-idiot", "you idiot"), ("stupid_m0ron", "stupid moron"),
    ("letter", "letter"), ("pretty", "pretty"), ("summer", "summer"), ("good", "good"), ("s.t.u.p.i.d", "stupid"),
])
def test_tokens(restorer, written, words):
    assert restorer.words(written.encode()) == words.split()
    assert toxicity.Hits(restorer, set(words.split())).of(written.encode()) == words.split()


@pytest.mark.parametrize("written,found", [
    ("y o u i d i o t", "idiot"), ("see y o u s t u p i d m o r o n", "stupid moron"), ("a s t u p p i d", "stupid"), ("1 d 1 0 t a n d", "idiot"),
])
def test_spelled_words(restorer, written, found):
    assert toxicity.Hits(restorer, {"idiot", "stupid", "moron"}).of(written.encode()) == found.split()
