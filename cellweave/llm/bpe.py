"""Byte-level BPE as a lazily determinised transducer, and streaming decoding.

Rank files give every token's bytes and merge rank.  In such a vocabulary each
prefix of a piece has one encoding, and it ends in the only token that is a
suffix of the prefix and *compatible* with the last token of what stands before
it; two tokens are compatible when encoding their joined bytes gives the two
back.  The transducer follows this byte by byte:

* a *boundary* is a position of the piece, with the last token that ends there;
  its length leads to the boundary before;
* a boundary is live while the bytes since it can still grow into a token (a
  walk in the trie of the vocabulary), which bounds the lookahead by the longest
  token;
* tokens through which all live boundaries pass are certain and are emitted.

A state is the list of live boundaries, each as its trie node and last token,
without positions; a transition tells the last token of the prefix read so far.
States and transitions are built when first met and kept, as in a lazily
determinised automaton.

Decoding runs an incremental UTF-8 state machine over token bytes: whole
characters are handed out as they become complete.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from cellweave.llm.common import key_and_text, small_batches

#: States, and memorised pieces, after which a worker starts anew; results do not depend on them.
MOST_STATES = 300_000
MOST_PIECES = 600_000
#: Fixed value: the split pattern of the published byte-level vocabularies.  None of its matches runs from other
#: characters into white space, and a match that starts in white space before a blank ends there at a blank that other
#: characters follow; so a text whose blanks are all followed by other characters may be cut before each of them.
CUT_BEFORE_BLANKS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes after which certain tokens of a long piece are emitted; more than twice the longest token.
HOLD = 1024
_NEVER = 1 << 60


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Transducer:
    """Encodes one piece after another; the automaton grows as it is used."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.length = {rank: len(token) for token, rank in ranks.items()}
        self.child: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [-1]
        self.depth: list[int] = [0]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                nxt = self.child[node].get(byte)
                if nxt is None:
                    nxt = self.child[node][byte] = len(self.child)
                    self.child.append({})
                    self.token_at.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = nxt
            self.token_at[node] = rank
        self.pairs: dict[tuple[int, int], bool] = {}
        self.spines: dict[int, tuple[list, list]] = {}
        self.forget()

    def forget(self) -> None:
        """Drop all states but the start."""
        start = ((0, -1),)
        self.states, self.number = [start], {start: 0}
        self.moves: list[dict[int, tuple[int, int]]] = [{}]

    def edges(self, token: int) -> tuple[list, list]:
        """The tokens that stood at the right and at the left edge while ``token`` was merged.

        Each comes with the rank of the merge that used it up.  Both lists are
        empty when merging the token's bytes does not give the token.
        """
        known = self.spines.get(token)
        if known is None:
            parts = [bytes([b]) for b in self.tokens[token]]
            while len(parts) > 2:
                best, at = min((self.ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if best == _NEVER:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            data = self.tokens[token]
            if len(parts) > 2:
                known = [], []
            elif len(parts) == 1:
                known = [(data, _NEVER)], [(data, _NEVER)]
            else:
                right, left = self.edges(self.ranks[parts[1]])[0], self.edges(self.ranks[parts[0]])[1]
                known = [*right[:-1], (parts[1], token), (data, _NEVER)], [*left[:-1], (parts[0], token), (data, _NEVER)]
            self.spines[token] = known
        return known

    def compatible(self, left: int, right: int) -> bool:
        """Whether encoding the joined bytes gives the two tokens back; at the start (-1) ``right`` alone.

        Merges happen in the order of their ranks.  A merge across the border
        takes place when its rank comes before the merges that use up the two
        tokens at the border; of equal ranks the left one goes first.
        """
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > MOST_PIECES:
                self.pairs.clear()
            rank, starts = self.ranks.get, self.edges(right)[1]
            ends = self.edges(left)[0] if left >= 0 else []
            known = bool(starts) and not any(rank(a + b, _NEVER) < used and rank(a + b) <= spent for a, used in ends for b, spent in starts)
            self.pairs[left, right] = known
        return known

    def move(self, state: int, byte: int) -> tuple[int, int]:
        """The next state, and the last token of the prefix that this byte ends."""
        live, last = [], -1
        for trie, token in self.states[state]:
            grown = self.child[trie].get(byte, -1)
            if grown >= 0:
                ends = self.token_at[grown]
                if last < 0 <= ends and self.compatible(token, ends):
                    last = ends
                if self.child[grown]:
                    live.append((grown, token))
        if last < 0:
            raise ValueError(f"byte {byte} has no encoding in this vocabulary")
        key = (*live, (0, last))
        number = self.number.get(key)
        if number is None:
            number = self.number[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
        found = self.moves[state][byte] = (number, last)
        return found

    def settled(self, lasts: list[int], state: int) -> int:
        """The latest boundary through which every live boundary's tokens pass."""
        lively = {len(lasts) - self.depth[trie] for trie, _ in self.states[state]}
        while len(lively) > 1:
            at = max(lively)
            lively.remove(at)
            lively.add(at - self.length[lasts[at - 1]])
        return lively.pop()

    def trace(self, lasts: list[int], stop: int) -> list[int]:
        """The tokens of the prefix that ends at ``stop``."""
        out = []
        while stop:
            token = lasts[stop - 1]
            out.append(token)
            stop -= self.length[token]
        out.reverse()
        return out

    def encode(self, piece: bytes) -> list[int]:
        if len(self.states) > MOST_STATES:
            self.forget()
        state, out, lasts = 0, [], []
        moves = self.moves
        for byte in piece:
            found = moves[state].get(byte)
            state, last = found if found is not None else self.move(state, byte)
            lasts.append(last)
            if len(lasts) >= HOLD:
                sure = self.settled(lasts, state)
                out += self.trace(lasts, sure)
                del lasts[:sure]
        return out + self.trace(lasts, len(lasts)) if out else self.trace(lasts, len(lasts))


class Encoder(dict):
    """Parts of texts to packed ids (little-endian unsigned 32-bit), memorised; short parts repeat a lot."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        super().__init__()
        self.transducer = Transducer(ranks)
        self.split = regex.compile(pattern).findall
        self.cut = pattern == CUT_BEFORE_BLANKS
        self.loose = regex.compile(r" (?!\S)").search
        self.pieces: dict[str, bytes] = {}

    def piece(self, piece: str) -> bytes:
        """The ids of one match of the pattern."""
        packed = self.pieces.get(piece)
        if packed is None:
            ids = self.transducer.encode(piece.encode("utf-8"))
            packed = struct.pack(f"<{len(ids)}I", *ids)
            if len(piece) <= 32:
                if len(self.pieces) >= MOST_PIECES:
                    self.pieces.clear()
                self.pieces[piece] = packed
        return packed

    def __missing__(self, part: str) -> bytes:
        packed = b"".join(map(self.piece, self.split(part)))
        if len(part) <= 48:
            if len(self) >= MOST_PIECES:
                self.clear()
            self[part] = packed
        return packed

    def encode(self, text: str) -> bytes:
        if not self.cut or self.loose(text):
            return b"".join(map(self.piece, self.split(text)))
        first, *rest = text.split(" ")
        return b"".join(map(self.__getitem__, [first, *map(" ".__add__, rest)]))


#: No character is open.
_READY = (0, 0, 0)


def utf8_step(state: tuple[int, int, int], byte: int) -> tuple[int, int, int] | None:
    """One step of the UTF-8 state machine: (bytes still due, least, largest next byte); None is an error."""
    due, low, high = state
    if due:
        return None if not low <= byte <= high else (due - 1, 0x80, 0xBF) if due > 1 else _READY
    if byte < 0x80:
        return _READY
    if 0xC2 <= byte <= 0xDF:
        return (1, 0x80, 0xBF)
    if 0xE0 <= byte <= 0xEF:
        return (2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF)
    if 0xF0 <= byte <= 0xF4:
        return (3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF)
    return None


def _run(state: tuple | None, data: bytes) -> tuple | None:
    """The state after ``data``; None is an error."""
    for byte in data:
        state = utf8_step(state, byte)
        if state is None:
            return None
    return state


class Decoder:
    """Token ids to bytes; ``feed`` hands out whole characters only.

    Bytes are gathered from one array of all tokens.  The UTF-8 state machine
    runs over the tokens that are no whole characters by themselves; the others
    leave its state as it is.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        size = max(ranks.values(), default=0) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.tokens = tokens
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.length = np.array([len(t) for t in tokens], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.clean = np.array([_run(_READY, t) == _READY for t in tokens], dtype=bool)
        self.steps: dict[tuple, tuple | None] = {}
        self.reset()

    def reset(self) -> None:
        self.state, self.held, self.valid = _READY, b"", True

    def feed(self, ids: np.ndarray) -> bytes:
        """Bytes of the characters that these ids complete; bytes that are no UTF-8 pass as they are."""
        length = self.length[ids]
        ends = np.cumsum(length)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[ids] - ends + length, length)
        data = self.held + self.bytes[places].tobytes()
        state, behind = self.state, -1
        odd = np.flatnonzero(~self.clean[ids])
        for k, token in zip(odd.tolist(), ids[odd].tolist()):
            if state != _READY and k != behind + 1:  # a clean token breaks the character off
                state, self.valid = _READY, False
            found = self.steps.get((state, token))
            if found is None:
                found = self.steps[state, token] = _run(state, self.tokens[token])
            state, behind = found, k
            if state is None:
                state, self.valid = _READY, False
        if state != _READY and behind != len(ids) - 1 and len(ids):
            state, self.valid = _READY, False
        whole = len(data)
        if state != _READY:  # the open character starts at the last byte that continues none
            whole -= 1
            while data[whole] & 0xC0 == 0x80:
                whole -= 1
        self.state, self.held = state, data[whole:]
        return data[:whole]

    def finish(self) -> bytes:
        """What is left open, and makes the stream invalid."""
        rest, self.held = self.held, b""
        self.valid = self.valid and not rest
        return rest


def pieces(decoder: Decoder, ids: np.ndarray, chunk: int) -> Iterable[bytes]:
    """The bytes of one document's ids, ``chunk`` ids at a time."""
    decoder.reset()
    for at in range(0, len(ids), chunk):
        yield decoder.feed(ids[at : at + chunk])
    yield decoder.finish()


_SHARED: dict[tuple, tuple[Encoder, Decoder]] = {}


def _worker(key: str, ranks: dict[bytes, int], pattern: str) -> tuple[Encoder, Decoder]:
    """One automaton per worker process, which later tasks find again."""
    if key not in _SHARED:
        _SHARED.clear()
        _SHARED[key] = (Encoder(ranks, pattern), Decoder(ranks))
    return _SHARED[key]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): each text's token ids as packed little-endian unsigned 32-bit integers.

    ``path`` is a rank file on the driver; its few hundred thousand bytes travel
    with the tasks.  Each match of ``pattern`` is encoded by itself.  A null or
    empty text has no ids; keys may be null or repeated; rows come back as they
    are, one for one.
    """
    ranks = load_ranks(path)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    rows = key_and_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = _worker(f"{path}|{pattern}", shared.value, pattern)
        for batch in small_batches(batches):
            texts = pc.fill_null(batch.column("text"), "").to_pylist()
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "ids": pa.array([encoder.encode(t) for t in texts], pa.binary())})

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str, chunk: int = 1 << 16) -> DataFrame:
    """(doc_id, ids, decoded, valid): the bytes of packed ids, and whether they are UTF-8.

    Ids are decoded ``chunk`` at a time, as a stream would bring them.  Null ids
    give no bytes.
    """
    ranks = load_ranks(path)
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = _worker(f"{path}|{pattern}", shared.value, pattern)
        for batch in small_batches(batches, "ids"):
            out, valid = [], []
            for packed in batch.column("ids").to_pylist():
                out.append(b"".join(pieces(decoder, np.frombuffer(packed or b"", dtype="<u4"), chunk)))
                valid.append(decoder.valid)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "ids": batch.column("ids"), "decoded": pa.array(out, pa.binary()), "valid": pa.array(valid)})

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids binary, decoded binary, valid boolean")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoded and decoded again, with the digests of both sides.

    Both ways run in one pass, so ids never leave the worker; rules for nulls,
    empty texts and keys are those of ``encode``.
    """
    ranks = load_ranks(path)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    rows = key_and_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _worker(f"{path}|{pattern}", shared.value, pattern)
        for batch in small_batches(batches):
            sizes, digests, decoded = [], [], []
            for text in pc.fill_null(batch.column("text"), "").to_pylist():
                packed = encoder.encode(text)
                sizes.append(len(packed) // 4)
                digests.append(hashlib.sha256(packed).hexdigest())
                both = hashlib.sha256()
                for part in pieces(decoder, np.frombuffer(packed, dtype="<u4"), 1 << 16):
                    both.update(part)
                decoded.append(both.hexdigest())
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"), "n_tokens": pa.array(sizes, pa.int64()),
                    "ids_sha256": pa.array(digests, pa.string()), "decoded_sha256": pa.array(decoded, pa.string()),
                }
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
