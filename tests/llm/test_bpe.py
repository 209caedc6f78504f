"""Byte-level BPE against the library and against plain merges."""

import hashlib
import random
from base64 import b64decode

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from llm_fixtures import odd_texts, rows_of

from sensorlake.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts(library):
    rng = random.Random(1)
    letters = "abcdefg  .,'s \n\t éß漢\U0001f600'"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(2000)]
    texts += ["a" * 3000, " " * 1000, "ab" * 2000 + "c", "x  \n y", " x", "x ", None, ""]
    coded = bpe.encode_array(pa.array(texts), PATH, PATTERN)
    plain = bpe.encode_array(pa.array(texts), PATH, PATTERN, cut_spaces=False)
    for text, ids, other in zip(texts, coded.to_pylist(), plain.to_pylist()):
        assert ids == other == library.encode_ordinary(text or ""), text
    decoded = bpe.decode_array(coded, PATH).to_pylist()
    assert decoded == [(t or "").encode() for t in texts]


def test_neighbours_agree_with_merges():
    """Any two tokens are compatible exactly if their bytes merge into just them."""
    vocabulary, rng = bpe._vocabulary(PATH), random.Random(2)
    reachable = [i for i, p in enumerate(vocabulary.piece) if len(p) == 1 or vocabulary.halves[i]]
    for _ in range(20_000):
        a, b = rng.choice(reachable[:3000]), rng.choice(reachable)
        pieces = [vocabulary.piece[a], vocabulary.piece[b]]
        assert vocabulary.compatible(a, b) == (vocabulary.merged(b"".join(pieces)) == pieces)


def test_small_vocabulary_needs_backtracking():
    ranks = {bytes([b]): b for b in range(256)}
    for piece in (b"ab", b"bc", b"abc", b"cd", b"bcd", b"de"):
        ranks[piece] = len(ranks)
    vocabulary, rng = bpe.Vocabulary(ranks), random.Random(3)
    for _ in range(3000):
        piece = bytes(rng.choices(b"abcde", k=rng.randint(1, 14)))
        merged = [piece] if piece in ranks else vocabulary.merged(piece)
        assert [vocabulary.piece[i] for i in vocabulary.encode(piece)] == merged


def test_a_vocabulary_needs_all_bytes():
    with pytest.raises(ValueError):
        bpe.Vocabulary({b"a": 0})


def test_digests(odd, no_docs, library):
    found = rows_of(bpe.digests(bpe.with_tokens(odd, PATH, PATTERN)))
    expected = []
    for doc_id, text in odd_texts():
        ids = library.encode_ordinary(text or "")
        decimal = ",".join(map(str, ids)).encode()
        expected.append(
            (doc_id, len(ids), hashlib.sha256(decimal).hexdigest(),
             hashlib.sha256((text or "").encode()).hexdigest())
        )
    assert found == sorted(expected, key=repr)
    assert bpe.digests(bpe.with_tokens(no_docs, PATH, PATTERN)).count() == 0
