"""Byte-level BPE: exact encoding in linear time, and decoding.

A byte sequence is split into pieces by a pattern; each piece is encoded by itself.
Bytes are mapped to Latin-1 characters, an Aho-Corasick automaton gives the longest
token at every position, and the encoder goes left to right, takes the longest token
that is compatible with the one before, and backtracks where none is. Two adjacent
tokens are compatible if merging their joined bytes would end in just these two; a
sequence is the BPE encoding exactly if all its neighbours are compatible, so the result
equals that of the merges. A position that led nowhere is marked and never entered
again, which bounds the work by the length of the piece.

Null text counts as empty: no ids, no bytes. Texts of any length are encoded whole; a
batch is taken in slices of bounded size. Decoding null gives empty bytes.
"""

from array import array
from base64 import b64decode
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F

from sensorlake.llm.words import text_slices

#: Known chunks, pieces and pairs per process; beyond it the memory starts anew.
KNOWN_CHUNKS = 250_000
KNOWN_PIECES = 800_000
KNOWN_PAIRS = 1 << 18
_NEVER = 1 << 62


class Vocabulary:
    """Tokens by rank, with the merges that the ranks imply."""

    def __init__(self, ranks):
        self.rank = ranks
        self.piece = [b""] * (max(ranks.values()) + 1)
        for piece, token in ranks.items():
            self.piece[token] = piece
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks the bytes {missing}")
        self.size = [len(p) for p in self.piece]
        self.halves = [None] * len(self.piece)
        self.automaton = ahocorasick.Automaton()
        reachable = {}
        for piece, token in sorted(ranks.items(), key=lambda x: len(x[0])):
            if len(piece) > 1:
                halves = self.merged(piece, stop=2)
                if len(halves) != 2 or ranks.get(b"".join(halves)) != token:
                    continue
                self.halves[token] = tuple(ranks[h] for h in halves)
            reachable[piece] = token
            self.automaton.add_word(piece.decode("latin-1"), token)
        self.automaton.make_automaton()
        self.shorter = [-1] * len(self.piece)
        for piece, token in reachable.items():
            self.shorter[token] = next(
                (reachable[piece[:n]] for n in range(len(piece) - 1, 0, -1) if piece[:n] in reachable),
                -1,
            )
        self.compatible = lru_cache(maxsize=KNOWN_PAIRS)(self._compatible)

    def merged(self, piece, stop=1):
        """Merges by lowest rank, leftmost first, until nothing merges or ``stop`` parts are left."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > stop:
            found = [
                (rank, i)
                for i, (a, b) in enumerate(zip(parts, parts[1:]))
                if (rank := self.rank.get(a + b)) is not None
            ]
            if not found:
                break
            _, i = min(found)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _compatible(self, left, right):
        """Whether merging the bytes of both never joins something across their border.

        It goes back in time: the later formed of the two tokens at the border is undone
        until both are single bytes. At each state the border breaks if its pair ranks
        before the merge that ended this state; of equal ranks the leftmost merges first.
        """
        left_until = right_until = _NEVER
        while True:
            pair = self.rank.get(self.piece[left] + self.piece[right])
            if pair is not None and pair < left_until and pair <= right_until:
                return False
            a, b = self.halves[left], self.halves[right]
            if a is None and b is None:
                return True
            if b is None or (a is not None and left > right):
                left_until, left = left, a[1]
            else:
                right_until, right = right, b[0]

    def encode(self, piece):
        """The ids of one piece of bytes."""
        whole = self.rank.get(piece)
        if whole is not None:
            return (whole,)
        n, size, shorter, compatible = len(piece), self.size, self.shorter, self.compatible
        longest = [-1] * (n + 1)
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - size[token]] = token  # ends ascend, so the longest stays
        dead = bytearray(n + 1)
        out, pos, token = [], 0, longest[0]
        while pos < n:
            last = out[-1] if out else -1
            while token >= 0:
                end = pos + size[token]
                if not dead[end] and (last < 0 or compatible(last, token)):
                    break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                pos = end
                token = longest[pos]
            else:
                dead[pos] = 1
                token = out.pop()
                pos -= size[token]
        return tuple(out)


class _Known(dict):
    """Ids, as the bytes of 32-bit integers, of what was met so far."""

    def __init__(self, most, ids):
        self.most, self.ids = most, ids

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        ids = self[key] = self.ids(key)
        return ids


class _Encoder:
    """Texts to ids.

    If ``cut_spaces``, a text is first cut before every space that a character other than
    white space follows, which must be a border of pieces anyway; chunks come back often.
    """

    def __init__(self, vocabulary, pattern, cut_spaces):
        self.split = regex.compile(pattern).findall
        pieces = _Known(KNOWN_PIECES, lambda p: array("i", vocabulary.encode(p.encode())).tobytes())
        piece = pieces.__getitem__

        def ids(text):
            return b"".join(map(piece, self.split(text)))

        self.ids = ids
        self.chunk = _Known(KNOWN_CHUNKS, lambda c: ids(" " + c)).__getitem__
        self.uneven = regex.compile(r" (?:\s|\Z)").search if cut_spaces else lambda text: True

    def __call__(self, text):
        if self.uneven(text):
            return self.ids(text)
        first, *rest = text.split(" ")
        return self.ids(first) + b"".join(map(self.chunk, rest))


@lru_cache(maxsize=2)
def _vocabulary(path):
    with open(path, "rb") as lines:
        return Vocabulary({b64decode(a): int(b) for a, b in map(bytes.split, lines)})


@lru_cache(maxsize=2)
def _encoder(path, pattern, cut_spaces):
    return _Encoder(_vocabulary(path), pattern, cut_spaces)


@lru_cache(maxsize=2)
def _bytes_of(path):
    with open(path, "rb") as lines:
        ranks = {int(b): b64decode(a) for a, b in map(bytes.split, lines)}
    pieces = [ranks.get(i, b"") for i in range(max(ranks) + 1)]
    size = np.array([len(p) for p in pieces], np.int64)
    start = np.concatenate([[0], np.cumsum(size)])[:-1]
    return np.frombuffer(b"".join(pieces), np.uint8), start, size


def encode_array(texts, path, pattern, cut_spaces=True):
    """Lists of ids for an Arrow array of texts."""
    encoder = _encoder(path, pattern, cut_spaces)
    values, counts = [], []
    for _, offsets, data in text_slices(texts):
        for lo, hi in zip(offsets, offsets[1:]):
            ids = encoder(data[lo:hi].tobytes().decode())
            values.append(ids)
            counts.append(len(ids) >> 2)
    ends = np.concatenate([[0], np.cumsum(np.array(counts, np.int64))])
    flat = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(values))])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat)


def decode_array(lists, path):
    """Bytes for an Arrow array of id lists."""
    table, start, size = _bytes_of(path)
    out = []
    for ids in lists:
        ids = np.asarray(ids.values, np.int64) if ids.is_valid else np.zeros(0, np.int64)
        parts = []
        for at in range(0, len(ids), 1 << 20):
            some = ids[at : at + (1 << 20)]
            n = size[some]
            shift = np.repeat(start[some] - np.concatenate([[0], np.cumsum(n)])[:-1], n)
            parts.append(table[shift + np.arange(len(shift))].tobytes())
        out.append(b"".join(parts))
    return pa.array(out, pa.binary())


def encode(text, path, pattern, cut_spaces=True):
    """Column of token ids of a text column.

    ``path`` names a file of base64 tokens and ranks that every executor can open, and
    ``pattern`` splits a text into pieces. ``cut_spaces`` must be off for a pattern whose
    pieces may go on over a space that a character other than white space follows.
    """

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        return encode_array(texts, path, pattern, cut_spaces)

    return ids(text)


def decode(ids, path):
    """Column of the bytes that a column of token ids stands for."""

    @F.arrow_udf("binary")
    def joined(lists: pa.Array) -> pa.Array:
        return decode_array(lists, path)

    return joined(ids)


def with_tokens(docs, path, pattern, text="text"):
    """(doc_id, n_tokens, ids, decoded) of every row, null text as empty.

    Every row gives one row, repeated ones too; other columns are left out, whatever
    their names.
    """
    coded = docs.select("doc_id", encode(F.col(text), path, pattern).alias("ids"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        decode(F.col("ids"), path).alias("decoded"),
    )


def digests(coded, keep_ids=False):
    """Rows of ``with_tokens`` with digests in place of ids and bytes."""
    decimal = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select(
        "doc_id",
        "n_tokens",
        *(["ids"] if keep_ids else []),
        F.sha2(decimal, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
