"""Unigram token counts against the tokenizers library."""

import random

import public_tokenizers
import pytest
from llm_fixtures import odd_texts, rows_of
from tokenizers import Tokenizer, models, pre_tokenizers

from sensorlake.llm import token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")


def library(scores, byte_fallback):
    tokenizer = Tokenizer(models.Unigram(list(scores.items()), unk_id=0, byte_fallback=byte_fallback))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(
        replacement=token_counts.BLANK, prepend_scheme="always", split=True
    )
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def texts():
    rng = random.Random(4)
    letters = "ab the e▁  \n<s>0x41 é漢字\U0001f600zq\t"
    random_texts = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(1500)]
    return [t for _, t in odd_texts() if t] + random_texts + ["", " ", "  a", " a", "<0x0A></s>"]


@pytest.mark.parametrize("byte_fallback", [True, False])
def test_counts(byte_fallback):
    scores = token_counts.vocabulary(PATH)
    if not byte_fallback:
        scores = dict([x for x in scores.items() if not x[0].startswith("<0x")][:2000])
    known, count = token_counts._Known(token_counts.Counter(scores)), library(scores, byte_fallback)
    for text in texts():
        assert token_counts.count_text(text, known) == count(text), text


def test_ties_go_to_the_longer_last_piece():
    scores = {"<unk>": 0.0, "a": -1.0, "b": -1.0, "ab": -2.0, "ba": -2.0, "aba": -3.0}
    count = library(scores, False)
    known = token_counts._Known(token_counts.Counter(scores))
    for text in ("ab", "aba", "abab", "babab", "abaabbaab", "zzab", "azzb"):
        assert token_counts.count_text(text, known) == count(text), text


def test_rows(odd, no_docs):
    count = library(token_counts.vocabulary(PATH), True)
    expected = [(i, count(t) if t else 0) for i, t in odd_texts()]
    assert rows_of(token_counts.counted(odd, PATH)) == sorted(expected, key=repr)
    assert token_counts.counted(no_docs, PATH).count() == 0
