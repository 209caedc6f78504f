"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 of ``DIMENSIONS`` places, made from a hash
of its code point. A trigram is the product of the vectors of its letters, the first one
rotated by two places, the second by one; a text is the sum of its trigrams, and a
language the sum of the unit vectors of its texts, less what all languages share. A text
gets the language of the largest cosine; the score is that cosine, not below 0.

Letters are lowered, words are set off by one blank on either side, and everything that
is no letter separates words. The distinct trigrams of a slice of texts are looked up
once and their vectors are multiplied with the table of counts, so the cost per text is
that of its distinct trigrams.

Learning reads at most about ``FIT_ROWS`` texts per language, drawn by a hash of doc_id
with the rate that the counted rows give: the profiles do not get better beyond that.
Every task adds up its texts; the sums of the tasks meet per language and block of
places. The languages are few: their profiles are sent out.

Texts without a letter, null included, are ``und`` with score 0. Without any row to learn
from, every text is. Equal cosines go to the first language by name. Repeated rows are
judged alike. A null doc_id counts as an empty one. An empty table gives no rows. Other
columns are left out.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sensorlake.llm.words import mix, text_slices

DIMENSIONS = 2048
FIT_ROWS = 5_000
FOLDS = 5
#: Places per row of the sums of a task.
BLOCK = 256
#: Trigrams of which vectors are multiplied at once.
STEP = 512


def _letters():
    """For each code point: 0 for no letter, else the code point of its lower case."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


_state = {}


def _table():
    if "letters" not in _state:
        _state["letters"] = _letters()
    return _state["letters"]


def letter_vectors(codes, dimensions=DIMENSIONS):
    """The vectors of some code points, as +1 and -1."""
    words = np.arange(dimensions // 64, dtype=np.uint64) + np.uint64(1)
    seeds = mix(codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(7))
    bits = mix(seeds[:, None] + words[None, :] * np.uint64(0xD1B54A32D192ED03))
    bits = np.unpackbits(bits.astype("<u8").view(np.uint8), axis=1, bitorder="little")
    return bits.astype(np.int8) * 2 - 1


def trigram_vectors(grams, dimensions=DIMENSIONS):
    """The vectors of packed trigrams (21 bits per letter)."""
    out = None
    for place in range(3):
        codes = (grams >> np.uint64(21 * (2 - place))) & np.uint64((1 << 21) - 1)
        own, at = np.unique(codes, return_inverse=True)
        turned = np.roll(letter_vectors(own, dimensions), 2 - place, axis=1)[at]
        out = turned if out is None else out * turned
    return out


def text_trigrams(offsets, data):
    """(text, trigram) of all trigrams of some texts, packed, with blanks around words."""
    text = data.tobytes().decode()
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    # where each text begins, in code points: bytes that do not continue a character
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    letter = _table()[codes]
    inside = letter > 0
    cut = np.zeros(len(codes) + 1, bool)
    cut[begins] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | cut[1:-1]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    # letters of all words in a row, with a blank before each word and after the last
    word_starts = starts[at]
    place = np.arange(len(at)) + np.cumsum(word_starts)
    line = np.zeros(place[-1] + 2, np.uint64)
    line[place] = letter[at]
    owner = np.zeros(len(line), np.int64)
    owner[place] = np.searchsorted(begins, at, "right") - 1
    middle = place
    grams = (line[middle - 1] << np.uint64(42)) | (line[middle] << np.uint64(21)) | line[middle + 1]
    return owner[middle], grams


def profiles(texts, dimensions=DIMENSIONS):
    """Per slice of an Arrow array: its first text, and the summed vectors of its texts."""
    for row, offsets, data in text_slices(texts):
        owner, grams = text_trigrams(offsets, data)
        n = len(offsets) - 1
        sums = np.zeros((n, dimensions), np.float32)
        known, column = np.unique(grams, return_inverse=True)
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        edges = np.searchsorted(column, np.arange(0, len(known) + STEP, STEP))
        for i in range(len(edges) - 1):
            part = slice(edges[i], edges[i + 1])
            first = i * STEP
            some = known[first : first + STEP]
            if not len(some):
                continue
            counts = np.zeros((n, len(some)), np.float32)
            np.add.at(counts, (owner[part], column[part] - first), 1)
            sums += counts @ trigram_vectors(some, dimensions).astype(np.float32)
        yield row, sums


def _unit(vectors):
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(length > 0, length, 1)


def held_out(doc_id):
    """Whether a row is kept out of learning."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "utf-8")) % FOLDS == 0


def fit(docs, fit_rows=FIT_ROWS, dimensions=DIMENSIONS):
    """Languages, sorted, and their vectors as rows of a matrix."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    labelled = labelled.where(~held_out(F.col("doc_id")))
    n = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    rate = F.lit(None).cast("double")
    for lang, count in n.items():
        rate = F.when(F.col("lang") == lang, min(1.0, fit_rows / count)).otherwise(rate)
    chance = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 30)) / float(1 << 30)
    drawn = labelled.where(chance < rate).select("lang", "text")

    def sums(batches):
        total = {}
        for batch in batches:
            langs = np.array(batch["lang"].to_pylist(), object)
            for row, vectors in profiles(batch["text"], dimensions):
                units = np.rint(_unit(vectors) * (1 << 20)).astype(np.int64)
                some = langs[row : row + len(units)]
                for lang in set(some):
                    add = units[some == lang].sum(axis=0)
                    total[lang] = total.get(lang, 0) + add
        for lang, vector in total.items():
            blocks = vector.reshape(-1, BLOCK)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(blocks), pa.string()),
                    pa.array(range(len(blocks)), pa.int32()),
                    pa.array(list(blocks), pa.list_(pa.int64())),
                ],
                ["lang", "block", "part"],
            )

    parts = drawn.mapInArrow(sums, "lang string, block int, part array<long>")
    added = parts.groupBy("lang", "block").agg(
        F.array(*[F.sum(F.col("part")[i]) for i in range(BLOCK)]).alias("part")
    )
    found = {}
    for r in added.collect():
        found.setdefault(r["lang"], {})[r["block"]] = r["part"]
    langs = sorted(found)
    vectors = np.array(
        [np.concatenate([found[x][b] for b in sorted(found[x])]) for x in langs], np.float64
    ).reshape(len(langs), dimensions)
    return langs, vectors


def centred(vectors):
    """Unit profiles less what all languages share, and that shared part."""
    units = _unit(vectors)
    shared = units.mean(axis=0) if len(units) > 1 else np.zeros(units.shape[1:])
    return _unit(units - shared).astype(np.float32), shared.astype(np.float32)


def predict(text, model, dimensions=DIMENSIONS):
    """Column (lang, score) for a text column."""
    langs, vectors = model
    targets, shared = centred(vectors) if langs else (None, None)

    @F.arrow_udf("struct<lang:string,score:double>")
    def told(texts: pa.Array) -> pa.Array:
        names, scores = [], []
        for _, sums in profiles(texts, dimensions):
            if not langs:
                names += ["und"] * len(sums)
                scores += [0.0] * len(sums)
                continue
            some = np.abs(sums).sum(axis=1) > 0
            cosines = _unit(_unit(sums) - shared) @ targets.T
            best = cosines.argmax(axis=1)
            top = np.clip(cosines[np.arange(len(sums)), best], 0, 1).astype(float)
            names += [langs[b] if ok else "und" for b, ok in zip(best, some)]
            scores += [round(t, 6) if ok else 0.0 for t, ok in zip(top.tolist(), some)]
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"]
        )

    return told(text)


def identified(docs, fit_rows=FIT_ROWS):
    """(doc_id, held_out, lang_pred, score) of every row."""
    model = fit(docs.select("doc_id", "text", "lang"), fit_rows)
    found = docs.select("doc_id", predict(F.col("text"), model).alias("p"))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("p.lang").alias("lang_pred"),
        F.col("p.score").alias("score"),
    )
