"""Operators on small tables: brute force, nulls, empty and repeated rows, clashing column names."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash

from cellweave.llm import bpe, merkle, pseudonyms, sharding, simhash, suffixes, toxicity, winnow

SCHEMA = "doc_id long, text string, `block` string, `row` string, `u` string, answer string"
LONG = " ".join(f"word{i * i % 97} and{i}" for i in range(120))
TEXTS = ["", None, "one", LONG, LONG, "x" + LONG + " tail", "  \n\t ", "héllo 日本 " * 30, "a" * 900, LONG[:500] + " other end of it"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "b", "r", "u", "z") for i, t in enumerate(TEXTS)] + [(None, LONG, "b", "r", "u", "z")]
    return spark.createDataFrame(rows, SCHEMA)


def test_simhash_components_match_brute_force(docs):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(TEXTS) + 1
    prints = {i: simhash.simhash((t or "").encode()) for i, t in enumerate(TEXTS)}
    reach = {i: {j for j in prints if (prints[i] ^ prints[j]).bit_count() <= 3} for i in prints}
    for _ in prints:
        reach = {i: set().union(*(reach[j] for j in near)) for i, near in reach.items()}
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == {i: min(near) for i, near in reach.items()}


def test_simhash_bits():
    h = xxhash.xxh64_intdigest(b"a b c", 42)
    assert simhash.simhash(b"A b\tC") == h
    assert simhash.simhash(b" ") == 0


def test_winnowing_finds_every_window(spark, docs):
    words = LONG.split()
    items = spark.createDataFrame([(7, " ".join(words[20:34])), (3, "one"), (4, None), (5, "absent words only")], "item_id int, text string")
    got = {r.doc_id: r for r in winnow.contamination(docs, items).collect() if r.doc_id is not None}
    assert got[3].n_hit == 14 and got[3]["items"] == ["7"] and [tuple(s) for s in got[3].spans] == [(20, 34)]
    assert got[2].n_hit == 1 and got[2]["items"] == ["3"]
    assert got[0].n_words == got[1].n_hit == 0
    assert all(r.n_hit == 0 for r in winnow.contamination(docs, items.filter("false")).collect())


def test_bpe_equals_the_library_and_round_trips(docs):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = bpe.load_ranks(path)
    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path, public_tokenizers.PATTERN, chunk=3).collect():
        text = LONG if r.doc_id is None else TEXTS[r.doc_id] or ""
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == whole.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode() and r.valid


def test_bpe_texts_cut_before_blanks_split_as_a_whole():
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder, rng = bpe.Encoder(ranks, public_tokenizers.PATTERN), np.random.default_rng(3)
    assert encoder.cut
    for _ in range(3000):
        text = "".join(rng.choice([" ", " ", "\n", "\t", "\xa0", "\x1c", "ab", "1", "'s", "é", "!", "日", "\u3000"], rng.integers(0, 12)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == whole.encode_ordinary(text), repr(text)


def test_bpe_decoder_states():
    ranks = {bytes([b]): b for b in range(256)} | {"é".encode(): 256, b"\x97\xa5 ": 257}
    feed = lambda decoder, *ids: decoder.feed(np.array(ids, dtype="<u4"))
    decoder = bpe.Decoder(ranks)
    assert feed(decoder, 0xE6) == b"" and feed(decoder) == b"" and feed(decoder, 257, 256) == "日 é".replace("日", "\u65e5").encode()
    assert feed(decoder, 65, 0xE6, 0x97) == b"A" and decoder.finish() == b"\xe6\x97" and not decoder.valid
    decoder.reset()
    assert feed(decoder, 0xE6, 65, 66) == b"\xe6AB" and not decoder.valid
    decoder.reset()
    assert feed(decoder, 256) == "é".encode() and decoder.finish() == b"" and decoder.valid


def test_repeated_spans_match_brute_force(docs):
    texts = {i: (t or "").encode() for i, t in enumerate(TEXTS)} | {None: LONG.encode()}
    starts = {}
    for i, t in texts.items():
        for a in range(len(t) - 399):
            starts.setdefault(t[a : a + 400], []).append((i, a))
    for r in suffixes.repeated_spans(docs).collect():
        gone = np.zeros(len(texts[r.doc_id]), dtype=bool)
        for places in starts.values():
            for i, a in places if len(places) > 1 else []:
                if i == r.doc_id:
                    gone[a : a + 400] = True
        assert bytes(r.kept) == bytes(np.frombuffer(texts[r.doc_id], np.uint8)[~gone])
        assert sum(s.stop - s.start for s in r.spans) == gone.sum()


def test_difference_cover_holds():
    for r in (1, 2, 3):
        cover, period = suffixes.difference_cover(r)
        assert len({(a - b) % period for a in cover for b in cover}) == period


def test_merkle_edit_and_equality(docs):
    got = {r.doc_id: r for r in merkle.edits(docs).collect()}
    assert got[3].fingerprint == got[4].fingerprint != got[5].fingerprint and got[3].near_next == 1.0
    assert got[0].fingerprint == got[1].fingerprint and got[1].n_chars == 0
    n = len(LONG)
    edited = LONG[: n - n // 4] + TEXTS[5][: n // 4]
    assert got[4].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and 0.5 < got[4].near_edited < 1


def test_shards_fit(docs):
    got = sharding.shards(docs, limit=2000).collect()
    assert len(got) == len(TEXTS) + 1
    held = {}
    for r in got:
        held[r.shard] = held.get(r.shard, 0) + r.n_bytes
        assert r.oversized == (r.n_bytes > 2000)
    assert all(v <= 2000 or any(r.oversized for r in got if r.shard == k) for k, v in held.items())
    assert sharding.shards(docs.filter("false")).count() == 0


def test_pseudonyms_keep_format_and_link(spark):
    rows = [(1, "card 4111 1111 1111 1111 on 2024-02-29, ip 10.0.0.1, ssn 123-45-6789"), (2, "4111111111111111 / 29.02.2024"), (3, None), (4, ""), (5, "999.1.1.1 2024-02-30 4111111111111112")]
    got = {r.doc_id: r for r in pseudonyms.pseudonymize(spark.createDataFrame(rows, "doc_id long, text string"), "a key").collect()}
    first, second = [p.pseudonym for p in got[1].pii], [p.pseudonym for p in got[2].pii]
    assert first[0].replace(" ", "") == second[0] != "4111111111111111"
    digits = [int(c) for c in second[0]][::-1]
    assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0
    assert first[1] == "-".join(reversed(second[1].split("."))) != "2024-02-29"
    assert got[3].text is None and got[4].text == "" and got[5].text == rows[4][1]


def test_pseudonyms_permute_under_a_key(spark):
    """Different values stay different, valid and of one format; another key gives other pseudonyms."""
    import re

    ips = [f"10.{i % 7}.{i % 250}.{i // 250}" for i in range(700)]
    dates = [f"20{i % 30:02d}-0{1 + i % 9}-{1 + i % 28:02d}" for i in range(252)]
    texts = spark.createDataFrame([(1, " ; ".join(dict.fromkeys([*ips, *dates, "ann@x.org", "bob@x.org", "555-123-4567"])))], "doc_id long, text string")
    one, other = (pseudonyms.pseudonymize(texts, key).first().pii for key in ("first", "second"))
    assert len({p.value for p in one}) == len({p.pseudonym for p in one}) == len(one) == len(set(ips)) + len(set(dates)) + 3
    assert {p.kind for p in one} == {"ip", "date", "email", "phone"}
    for p in one:
        assert re.sub("[0-9]", "0", p.value) == re.sub("[0-9]", "0", p.pseudonym) or p.kind in ("ip", "email")
        assert p.kind != "ip" or all(int(x) < 256 for x in p.pseudonym.split("."))
    assert sum(a.pseudonym == b.pseudonym for a, b in zip(one, other)) < 0.05 * len(one)
    spark.conf.unset(pseudonyms.KEY_SETTING)
    assert pseudonyms.session_key(spark) == pseudonyms.session_key(spark) != "cellweave"


def test_restoring_obfuscated_words():
    counts = np.zeros(28**3)
    for word in ("idiot", "stupid", "trash", "worthless", "the", "and"):
        code = [0, 0, *(ord(c) - 96 for c in word), 0]
        for x, y, z in zip(code, code[1:], code[2:]):
            counts[(x * 28 + y) * 28 + z] += 100
    r = toxicity.Restorer(counts)
    for written, clean in (("1d10t", "idiot"), ("stuuupid", "stupid"), ("tr@$h", "trash"), ("s.t.u.p.i.d", "stupid"), ("the!!", "the"), ("and,", "and")):
        assert r.restore(written) == clean
    assert "stupid" in toxicity.spaced("so s t u p i d they".split())
