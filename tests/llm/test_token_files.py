"""Token shards: equal to the tokenizer library per document, keyed access, copies, nulls, lost attempts."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cellweave.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"Word{i * i % 97} it's {i}," for i in range(400))
TEXTS = ["", None, "One", LONG, LONG, " \n\t ", "héllo  日本　ÉTÉ é ́x don't <|endoftext|>!\x0b?\x1c." * 3, "a" * 900]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3 - 5, t, "s", 1) for i, t in enumerate(TEXTS)] + [(4, "a copy", "s", 1)] * 30 + [(None, "no key", "s", 2), (None, None, "s", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, shard string, start int").repartition(5)


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    out, start = [], 0
    for key, text in sorted(((r.doc_id, r.text or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        out.append((key, start, ids))
        start += len(ids)
    return out


@pytest.mark.parametrize("limits", [{}, {"shard_ids": 50, "task_bytes": 700, "bucket_keys": 2}])
def test_read_back_in_key_order(docs, limits):
    files = token_files.write(docs, PATH, 2, **limits)
    got = [(r.doc_id, r.start, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in token_files.read(files, docs).collect()]
    got.sort(key=lambda r: r[1])
    want = expected(docs.collect())
    assert [(k, len(ids)) for k, _, ids in got if k != 4 and k is not None] == [(k, len(ids)) for k, _, ids in want if k != 4 and k is not None]
    assert [k for k, _, _ in got] == [k for k, _, _ in want]
    assert sorted((str(k), ids) for k, _, ids in got) == sorted((str(k), ids) for k, _, ids in want)
    assert [s for _, s, _ in got] == np.cumsum([0, *(len(ids) for _, _, ids in got)])[:-1].tolist()


def test_absent_keys_and_empty_tables(spark, docs):
    files = token_files.write(docs, PATH, 2, shard_ids=100)
    asked = spark.createDataFrame([(1,), (1,), (777,)], "k long")
    assert [r.doc_id for r in token_files.read(files, asked, "k").collect()] == [1]
    empty = token_files.write(docs.filter("false"), PATH, 2)
    assert token_files.read(empty, docs).count() == 0
    assert token_files.read(files, asked.filter("false"), "k").count() == 0


def test_odd_parts_and_a_full_memory():
    encoder = token_files.Encoder(open(PATH, encoding="utf-8").read(), "<u2", most=3)
    tokenizer = Tokenizer.from_file(PATH)
    for text in ["a\x01b c \x01 \x01\x01 d", "one two three four", "one five", "\x01", "<|ENDOFTEXT|> <|endoftext|>x J\u030c ÉA É \u0301"]:
        assert np.frombuffer(encoder.encode(text.encode(), b""), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_parts_are_encoded_as_whole_texts():
    encoder = token_files.Encoder(open(PATH, encoding="utf-8").read(), "<u2")
    tokenizer, rng = Tokenizer.from_file(PATH), np.random.default_rng(8)
    marks = ["'s", "'LL", "12", "Ab", "c", "É", "é", "ß", "ÿ", "×", "÷", "µ", "\u0301", "İ", "Σ", "—", "!", "<|", "|>", "endoftext", "\x7f", "日", " ", "\n", "\xa0"]
    for _ in range(3000):
        text = "".join(marks[i] for i in rng.integers(0, len(marks), rng.integers(1, 10)))
        assert np.frombuffer(encoder.encode(text.encode(), b""), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_perfect_hash_is_one():
    rng = np.random.default_rng(2)
    h, k = rng.integers(0, 1 << 63, (2, 20_000), dtype=np.uint64)
    table = token_files.PerfectHash.build(h, k)
    assert sorted(table.slots(h, k).tolist()) == list(range(len(h)))
    with pytest.raises(ValueError):
        token_files.PerfectHash.build(np.repeat(h[:1], 2), np.repeat(k[:1], 2))


def test_files_of_lost_attempts_do_not_count(docs):
    files = token_files.write(docs, PATH, 2)
    token_files.write_shard(f"{files.folder}/00000000-lost-000000.ids", "<u2", [b"\x01\x00"])
    assert token_files.read(files, docs).count() == docs.count()
