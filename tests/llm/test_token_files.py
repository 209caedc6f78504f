"""Directly addressable codes: round trips, access at any place, whole files."""

import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import odd_texts
from tokenizers import Tokenizer

from sensorlake.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("most", [2, 300, 70_000, 1 << 30])
def test_segment(most):
    rng = np.random.default_rng(most)
    for n in (1, 2, 63, 64, 511, 512, 513, 5000):
        values = (rng.random(n) ** 4 * most).astype(np.uint32)
        segment = token_files.Segment(token_files.encode_segment(values))
        assert (segment.all() == values).all()
        assert [segment[i] for i in range(n)] == values.tolist()


def test_widths_are_the_cheapest():
    def cost(values, widths):
        total, low = 0, 0
        for i, w in enumerate(widths):
            n = sum(int(v) >> low > 0 for v in values) if low else len(values)
            total += n * (w + (i < len(widths) - 1))
            low += w
        return total

    def splits(n):
        yield (n,)
        for first in range(1, n):
            for rest in splits(n - first):
                yield (first, *rest)

    rng = random.Random(1)
    for _ in range(20):
        values = np.array([int(rng.random() ** 3 * 200) for _ in range(100)], np.uint32)
        longest = max(1, int(values.max()).bit_length())
        best = min(cost(values, w) for w in splits(longest))
        assert cost(values, token_files.best_widths(values)) == best


def test_shard_over_several_segments(monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT", 100)
    rng = np.random.default_rng(3)
    docs = [(i - 1 if i else None, rng.integers(0, 50_000, n).astype(np.uint32))
            for i, n in enumerate([0, 5, 250, 1, 99, 100, 0, 7])]
    out = io.BytesIO()
    writer = token_files.Writer(out)
    for doc, ids in docs:
        writer.add(doc, ids)
    writer.close()

    class Stream(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    shard = token_files.Shard(Stream(out.getvalue()))
    flat = np.concatenate([ids for _, ids in docs])
    assert [shard[i] for i in range(len(flat))] == flat.tolist()
    starts = np.cumsum([0] + [len(ids) for _, ids in docs])
    assert list(shard.documents()) == [
        (d, int(s), len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
        for (d, ids), s in zip(docs, starts)
    ]
    with pytest.raises(ValueError):
        token_files.Shard(Stream(out.getvalue()[:-3]))


def test_files(odd, no_docs):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    files = token_files.write(odd, PATH)
    found = token_files.read(files).collect()
    ids = sorted(
        (i is not None, i or 0, tokenizer.encode(t or "", add_special_tokens=False).ids + [1])
        for i, t in odd_texts()
    )
    expected, at = [], 0
    for known, i, x in ids:
        expected.append((i if known else None, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        at += len(x)
    assert sorted(((r[0], r[2], r[3]) for r in found), key=repr) == sorted(expected, key=repr)
    found.sort(key=lambda r: r["start"])
    assert found[0]["start"] == 0 and found[-1]["start"] + found[-1]["n_tokens"] == at
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(found, found[1:]))
    order = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in found]
    assert order == sorted(order)
    assert token_files.read(token_files.write(no_docs, PATH)).count() == 0


def test_literals_of_special_pieces(spark):
    """Ids are the plain library's, also where a text holds a special piece."""
    tokenizer = Tokenizer.from_file(PATH)
    literals = ["<|endoftext|>", "<|startoftext|>"]
    texts = [form.replace("#", x) for x in literals for form in (
        "#", "see # here", "in#side a word", "#x and x#", "##\n#", "<# #> <|endoftext #|", "É#é\t#.",
    )]
    texts += ["see <|endoftext|> here and <|startoftext|>x", "<|ENDOFTEXT|> <|end oftext|>", "none"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = token_files.read(token_files.write(docs, PATH)).orderBy("doc_id").collect()
    ids = [tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    assert ids[14] == [862, 49407, 763, 537, 49406, 343, 1]
    starts = np.cumsum([0] + [len(x) for x in ids]).tolist()
    assert [tuple(r) for r in found] == [
        (i, starts[i], len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in enumerate(ids)
    ]


def test_memory_is_bounded_by_bytes(monkeypatch):
    """Chunks of 10 KB without blanks are encoded and not kept; the rest turns over."""
    monkeypatch.setattr(token_files, "MEMORY_BYTES", 20_000)
    encode = token_files._Encoder(PATH)
    rng = random.Random(9)
    plain = Tokenizer.from_file(PATH)
    for _ in range(12):
        long = "".join(rng.choice("漢字かな交じ文字列") for _ in range(3400))
        short = " ".join("".join(rng.choice("abcde*&.,") for _ in range(6)) for _ in range(60))
        for text in (long, short, long + " " + short):
            want = plain.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(encode([text])[0], np.int32).tolist() == want
        for memory in (encode.known, encode.words):
            held = sum(len(k) + len(v) for k, v in memory.older.items())
            assert held <= 20_000 and memory.size <= 20_000
            assert all(len(k) <= token_files.LONGEST_KEY for k in memory.older)


def test_little_is_held_at_a_time(monkeypatch):
    """Texts are taken as they are needed, and few new chunks go to the tokenizer at once."""
    monkeypatch.setattr(token_files, "LETTERS_AT_ONCE", 1000)
    monkeypatch.setattr(token_files, "NEW_AT_ONCE", 7)
    encode, taken, batches = token_files._Encoder(PATH), [], []

    class Counting:
        def __init__(self, inner):
            self.inner = inner

        def encode_batch_fast(self, texts, **options):
            batches.append(len(texts))
            return self.inner.encode_batch_fast(texts, **options)

    encode.tokenizer = Counting(encode.tokenizer)
    texts = [" ".join(f"{i}x{j}" for j in range(20)) for i in range(200)]
    found = encode.each(taken.append(t) or t for t in texts)
    first = next(found)
    assert len(taken) < 30
    assert [first, *found] == token_files._Encoder(PATH)(texts)
    assert max(batches) <= 7 and sum(batches) == 4000


def test_processes_hold_no_chunks_after_a_shard(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(50))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert token_files.read(token_files.write(docs, PATH)).count() == 400

    def held(batches):
        for batch in batches:
            encode = token_files._encoder(PATH)
            batch["n"] = len(encode.known) + len(encode.known.older) + len(encode.words)
            yield batch

    found = spark.range(32, numPartitions=32).selectExpr("id AS n").mapInPandas(held, "n long")
    assert found.agg({"n": "max"}).first()[0] == 2  # the empty chunk and the empty word
