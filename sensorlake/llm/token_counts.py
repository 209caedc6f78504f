"""Token counts of a unigram tokenizer without its tokens: count-only Viterbi.

An Aho-Corasick automaton lists all pieces of the vocabulary that end at a place; the
best score up to there and the number of pieces on the way are all that is carried on.
The rules of the tokenizer at ties and gaps:

* Of ways with the same score the one whose last piece is longest is taken, as pieces are
  offered from their start and only a better score replaces.
* A character that is no piece itself may be an unknown piece with a score of 10 less than
  the lowest of the vocabulary. Unknown pieces in a row are one; if the vocabulary has
  all bytes, each counts as its bytes.

Blanks become U+2581, one is put in front, and the text is cut before each: the parts
are counted by themselves, and often seen before.

Null and empty texts have no tokens. Texts of any length are counted whole. Repeated rows
give repeated rows; an empty table gives none. Other columns are left out.
"""

from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sensorlake.llm.words import text_slices

KNOWN_PARTS = 500_000
BLANK = "▁"
UNKNOWN_PENALTY = 10.0


class Counter:
    """Counts the tokens of parts, by pieces and their scores."""

    def __init__(self, scores):
        self.automaton = ahocorasick.Automaton()
        for piece, score in scores.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p in scores if len(p) == 1}
        self.unknown = min(scores.values()) - UNKNOWN_PENALTY
        self.has_bytes = all(f"<0x{b:02X}>" in scores for b in range(256))

    def count(self, part):
        """The number of tokens of one part."""
        n = len(part)
        if not n:
            return 0
        best, pieces, gap = [0.0] * (n + 1), [0] * (n + 1), bytearray(n + 1)
        waiting = self.automaton.iter(part)
        end, found = next(waiting, (n, None))
        for i in range(n):
            score = None
            while end == i:  # longest first
                size, own = found
                start = i + 1 - size
                if score is None or best[start] + own > score:
                    score, count = best[start] + own, pieces[start] + 1
                end, found = next(waiting, (n, None))
            if part[i] not in self.single:
                other = best[i] + self.unknown
                if score is None or other > score:
                    score = other
                    if self.has_bytes:
                        count = pieces[i] + len(part[i].encode())
                    else:
                        count = pieces[i] + (not gap[i])
                        gap[i + 1] = 1
            best[i + 1], pieces[i + 1] = score, count
        return pieces[n]


class _Known(dict):
    def __init__(self, counter):
        self.count = counter.count

    def __missing__(self, part):
        if len(self) >= KNOWN_PARTS:
            self.clear()
        n = self[part] = self.count(part)
        return n


def vocabulary(path):
    """Pieces and scores of a sentencepiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return {model.id_to_piece(i): model.get_score(i) for i in range(model.vocab_size())}


@lru_cache(maxsize=1)
def _known(path):
    return _Known(Counter(vocabulary(path)))


def count_text(text, known):
    """Tokens of a text: those of its parts, each with the blank before it."""
    if not text:
        return 0
    parts = text.replace(BLANK, " ").split(" ")
    if not parts[0]:
        parts = parts[1:]  # a text that begins with a blank gets none in front
    return sum(map(known.__getitem__, [BLANK + p for p in parts]))


def counts(text, path):
    """Column of token counts of a text column, by the model file at ``path``."""

    @F.arrow_udf("bigint")
    def counted(texts: pa.Array) -> pa.Array:
        known, out = _known(path), []
        for _, offsets, data in text_slices(texts):
            for lo, hi in zip(offsets, offsets[1:]):
                out.append(count_text(data[lo:hi].tobytes().decode(), known))
        return pa.array(np.array(out, np.int64))

    return counted(text)


def counted(docs, path):
    """(doc_id, n_tokens) of every row."""
    return docs.select("doc_id", counts(F.col("text"), path).alias("n_tokens"))
