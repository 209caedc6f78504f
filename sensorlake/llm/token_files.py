"""Token ids in binary files of directly addressable codes (DACs).

Documents are dealt by ranges of doc_id, so that shard after shard the ids stand in
ascending order; each task encodes its documents and writes one shard. A shard is a row
of segments of ``SEGMENT`` ids and a footer. A segment splits each id into chunks of
given widths: level 0 holds the lowest chunk of every id and a bitmap that tells which
ids go on; level 1 holds the next chunk of those only, and so on. A rank directory
counts the set bits before each block of a bitmap, so any id is found with one chunk
and one rank per level, without decoding what stands before it. The widths of a segment
are those with the fewest bits for its ids (dynamic programming over bit lengths).

Ids are those of the library with ``add_special_tokens=False``: a special piece that stands
as a literal in a text, such as ``<|endoftext|>``, has its own id.

Null text has only the end id. Documents come in order of doc_id, null first; equal
doc_ids in order of a hash and then their text. An empty table gives no shards and no
rows. Other columns are left out.
"""

import json
import os
import re
import struct
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake.llm.files import listed, new_file, new_folder, opened
from sensorlake.llm.words import text_slices

SEGMENT = 1 << 18
END_ID = 1
#: Bits of a bitmap per entry of its rank directory.
RANK_BLOCK = 512
#: Bytes of a generation of known chunks per task (of words half as much), what an entry
#: takes besides its key and value, and the longest key that outlives a generation.
MEMORY_BYTES, ENTRY_BYTES, LONGEST_KEY = 48 << 20, 200, 256
#: Rows, characters and new chunks at a time: more take memory that the process then keeps.
ROWS_AT_ONCE, LETTERS_AT_ONCE, NEW_AT_ONCE = 500, 1 << 20, 2000
_MAGIC = b"DACTOK01"


# Encoding --------------------------------------------------------------------------


class _Memory(dict):
    """Values by key, in two generations of bounded size: what was not used for a whole
    generation is forgotten."""

    def __init__(self, most_bytes):
        self.most_bytes, self.size, self.older = most_bytes, 0, {}
        super().__init__({"": b""})

    def missing(self, keys):
        """The keys among these that are not known."""
        new = set(keys).difference(self)
        if self.older:
            again = new.intersection(self.older)
            self.learn({key: self.older[key] for key in again})
            new -= again
        return new

    def learn(self, found):
        self.update(found)
        lengths = sum(map(len, found)) + sum(map(len, found.values()))
        self.size += lengths + ENTRY_BYTES * len(found)

    def tidy(self):
        """Starts a generation if this one is full; long keys are not kept."""
        if self.size > self.most_bytes:
            self.older = {k: v for k, v in self.items() if len(k) <= LONGEST_KEY}
            self.clear()
            self[""], self.size = b"", 0


class _Encoder:
    """Texts to ids of a tokenizer whose pieces never hold white space.

    A text is cut at spaces and line feeds, and each chunk met for the first time goes
    through the tokenizer. A new chunk that is a word, maybe with closing marks, is one
    piece, or two; many words go through the tokenizer as one text, where the end of a
    word shows in its last id.
    """

    def __init__(self, path):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        for piece, token in vocabulary.items():
            self.last[token] = piece.endswith("</w>")
        # letters of one code point, that no normal form joins or takes apart
        self.simple = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?#$%&*]*)\Z").match
        self.forget()
        self.word_tokenizer = self._for_words(path, vocabulary)

    def _for_words(self, path, vocabulary):
        """The tokenizer without the steps that do nothing to lower-case words of single
        letters between blanks, if it then gives the same ids for words of its pieces."""
        from tokenizers import Tokenizer, pre_tokenizers

        light = Tokenizer.from_file(path)
        light.normalizer = None
        light.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        pieces = [p.removesuffix("</w>").lower() for p in sorted(vocabulary)[::11]]
        letters = "".join(c for c in map(chr, range(0xDF, 0x100)) if c.isalpha())
        words = [p for p in pieces if p and self.simple(p)]
        words += [a + letters[i] + b for i in range(len(letters)) for a, b in zip(words, words[1:40])]
        sample = [" ".join(words)]
        plain, fast = next(self._ids(sample)), next(self._ids(sample, light))
        return light if plain.tolist() == fast.tolist() else self.tokenizer

    def forget(self):
        """Starts anew: a process that waits, or reads shards, holds no chunks."""
        self.known, self.words = _Memory(MEMORY_BYTES), _Memory(MEMORY_BYTES // 2)

    def _ids(self, texts, tokenizer=None):
        encode = (tokenizer or self.tokenizer).encode_batch_fast
        for i in range(0, len(texts), NEW_AT_ONCE):
            for x in encode(texts[i : i + NEW_AT_ONCE], add_special_tokens=False):
                yield np.array(x.ids, np.int32)

    def _learn_words(self, words):
        words, found = list(self.words.missing(words)), {}
        for i in range(0, len(words), 500):
            some = words[i : i + 500]
            (ids,) = self._ids([" ".join(some)], self.word_tokenizer)
            ends = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
            if len(ends) != len(some):  # not the kind of tokenizer that marks ends
                found.update((w, x.tobytes()) for w, x in zip(some, self._ids(some)))
                continue
            data = ids.tobytes()
            found.update(zip(some, [data[a:b] for a, b in zip([0, *ends], ends)]))
        self.words.learn(found)

    def each(self, texts):
        """The bytes of the 32-bit ids of each text, with few texts held at a time."""
        some, size = [], 0
        for text in texts:
            some.append(text)
            size += len(text)
            if size >= LETTERS_AT_ONCE:
                yield from self(some)
                some, size = [], 0
        yield from self(some)

    def __call__(self, texts):
        """The bytes of the 32-bit ids of each text."""
        split = [t.replace("\n", " ").split(" ") for t in texts]
        plain, other = [], []
        for c in self.known.missing(chain.from_iterable(split)):
            m = self.simple(c)
            if m:
                plain.append((c, m[1].lower(), m[2]))
            else:
                other.append(c)
        self._learn_words({w for _, a, b in plain for w in (a, b)})
        words = self.words
        found = {c: words[a] + words[b] for c, a, b in plain}
        found.update((c, x.tobytes()) for c, x in zip(other, self._ids(other)))
        self.known.learn(found)
        known = self.known.__getitem__
        out = [b"".join(map(known, chunks)) for chunks in split]
        self.known.tidy()
        self.words.tidy()
        return out


@lru_cache(maxsize=1)
def _encoder(path):
    return _Encoder(path)


# Directly addressable codes ----------------------------------------------------------


def best_widths(values):
    """Chunk widths, lowest first, with the fewest bits for these values."""
    bits = np.zeros(33, np.int64)
    lengths = np.maximum(1, np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64))
    bits[: lengths.max() + 1] = np.bincount(lengths)
    longest = int(lengths.max())
    over = len(values) - np.cumsum(bits)  # how many need more than so many bits
    best = {longest: (0, ())}  # cost of what lies above a border
    for lo in range(longest - 1, -1, -1):
        n = int(over[lo]) if lo else len(values)
        best[lo] = min(
            (n * (hi - lo + (hi < longest)) + best[hi][0], (hi - lo,) + best[hi][1])
            for hi in range(lo + 1, longest + 1)
        )
    return best[0][1]


def _packed(values, width):
    raw = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4)
    bits = np.unpackbits(raw, axis=1, count=width, bitorder="little")
    return np.packbits(bits, bitorder="little").tobytes()


def _unpacked(data, n, width):
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width, bitorder="little")
    out = np.zeros(n, np.uint32)
    for j, column in enumerate(bits.reshape(n, width).T):
        out |= column.astype(np.uint32) << np.uint32(j)
    return out


def encode_segment(values):
    """Levels of chunks with their bitmaps and rank directories, as bytes."""
    widths = best_widths(values)
    parts, rest, head = [], values.astype(np.uint32), []
    for level, width in enumerate(widths):
        chunk = rest & np.uint32((1 << width) - 1)
        above = rest >> np.uint32(width)
        chunks, bitmap, ranks = _packed(chunk, width), b"", b""
        if level < len(widths) - 1:
            # an id goes on if it needs more bits than the levels so far hold
            on = above > 0
            bitmap = np.packbits(on, bitorder="little").tobytes()
            before = np.concatenate([[0], np.cumsum(on)])[:-1:RANK_BLOCK]
            ranks = before.astype("<u4").tobytes()
            rest = above[on]
        head.append((width, len(chunk), len(chunks), len(bitmap), len(ranks)))
        parts += [chunks, bitmap, ranks]
    heads = b"".join(struct.pack("<5I", *h) for h in head)
    return struct.pack("<I", len(head)) + heads + b"".join(parts)


class Segment:
    """An encoded segment: all of it decoded, or any one id."""

    def __init__(self, data):
        (levels,) = struct.unpack_from("<I", data)
        at = 4 + 20 * levels
        self.levels = []
        for i in range(levels):
            width, n, *sizes = struct.unpack_from("<5I", data, 4 + 20 * i)
            parts = []
            for size in sizes:
                parts.append(data[at : at + size])
                at += size
            self.levels.append((width, n, *parts))

    def all(self):
        out, place, shift = None, None, 0
        for width, n, chunks, bitmap, _ in self.levels:
            chunk = _unpacked(chunks, n, width) if n else np.zeros(0, np.uint32)
            if out is None:
                out, place = chunk, np.arange(n)
            else:
                out[place] |= chunk << np.uint32(shift)
            shift += width
            if bitmap:
                on = np.unpackbits(np.frombuffer(bitmap, np.uint8), count=n, bitorder="little")
                place = place[on.astype(bool)]
        return out

    def __getitem__(self, i):
        value = shift = 0
        for width, _, chunks, bitmap, ranks in self.levels:
            first = i * width
            word = int.from_bytes(chunks[first >> 3 : ((first + width - 1) >> 3) + 1], "little")
            value |= ((word >> (first & 7)) & ((1 << width) - 1)) << shift
            shift += width
            if not bitmap or not bitmap[i >> 3] >> (i & 7) & 1:
                return value
            block = i // RANK_BLOCK
            (rank,) = struct.unpack_from("<I", ranks, 4 * block)
            begin = block * RANK_BLOCK
            before = int.from_bytes(bitmap[begin >> 3 : (i >> 3) + 1], "little")
            i = rank + (before & ((1 << (i - begin)) - 1)).bit_count()
        return value


# Shards ------------------------------------------------------------------------------


class Writer:
    """Ids of documents, one after another, to an open stream."""

    def __init__(self, out):
        self.out, self.at, self.waiting, self.n_waiting = out, 0, [], 0
        self.segments, self.docs, self.n = [], [], 0
        self._put(_MAGIC)

    def _put(self, data):
        self.out.write(data)
        self.at += len(data)

    def add(self, doc_id, ids):
        self.add_bytes(doc_id, np.asarray(ids, "<u4").tobytes())

    def add_bytes(self, doc_id, ids):
        """A document and its ids as little-endian bytes."""
        self.docs.append((doc_id, self.n))
        self.waiting.append(ids)
        self.n += len(ids) // 4
        self.n_waiting += len(ids) // 4
        if self.n_waiting >= SEGMENT:
            self._flush(SEGMENT)

    def _flush(self, least):
        ids = np.frombuffer(b"".join(self.waiting), "<u4")
        at = 0
        while at < len(ids) and len(ids) - at >= least:
            data = encode_segment(ids[at : at + SEGMENT])
            self.segments.append((self.at, len(data)))
            self._put(data)
            at += SEGMENT
        self.waiting, self.n_waiting = [ids[at:].tobytes()], len(ids) - at

    def close(self):
        self._flush(1)
        known = np.array([d is not None for d, _ in self.docs], np.uint8)
        ids = np.array([d or 0 for d, _ in self.docs], "<i8")
        starts = np.array([s for _, s in self.docs], "<i8")
        table = zlib.compress(known.tobytes() + ids.tobytes() + starts.tobytes(), 1)
        foot = json.dumps(
            {"n": self.n, "docs": len(self.docs), "table": len(table), "segments": self.segments}
        ).encode()
        self._put(table + foot + struct.pack("<Q", len(foot)) + _MAGIC)


class Shard:
    """An open shard: its documents, its ids in order, or the id at any place."""

    def __init__(self, stream):
        self.stream = stream
        size = stream.size()
        tail = self._bytes(size - 16, 16)
        if tail[8:] != _MAGIC:
            raise ValueError("not a token file, or cut off")
        (length,) = struct.unpack("<Q", tail[:8])
        foot = json.loads(self._bytes(size - 16 - length, length))
        self.n, self.segments = foot["n"], foot["segments"]
        table = zlib.decompress(self._bytes(size - 16 - length - foot["table"], foot["table"]))
        n = foot["docs"]
        known = np.frombuffer(table, np.uint8, n)
        ids = np.frombuffer(table, "<i8", n, n)
        self.starts = np.append(np.frombuffer(table, "<i8", n, 9 * n), self.n)
        self.doc_ids = [int(d) if k else None for d, k in zip(ids, known)]
        self._open = None

    def _bytes(self, at, n):
        self.stream.seek(at)
        return self.stream.read(n)

    def segment(self, i):
        if self._open is None or self._open[0] != i:
            self._open = (i, Segment(self._bytes(*self.segments[i])))
        return self._open[1]

    def __getitem__(self, i):
        return self.segment(i // SEGMENT)[i % SEGMENT]

    def documents(self):
        """(doc_id, start, number of ids, crc32 of the ids), read in order."""
        segment, ids, first = -1, np.zeros(0, "<u4"), 0
        for doc, start, end in zip(self.doc_ids, self.starts, self.starts[1:]):
            crc, at = 0, int(start)
            while at < end:
                if at >= first + len(ids):
                    segment += 1
                    first = segment * SEGMENT
                    ids = self.segment(segment).all().astype("<u4")
                some = ids[at - first : int(end) - first]
                crc = zlib.crc32(some.tobytes(), crc)
                at += len(some)
            yield doc, int(start), int(end - start), crc


def _texts(column):
    """The texts of a column one by one, null as empty, never with a copy of them all."""
    for start in range(0, len(column), ROWS_AT_ONCE):
        for _, offsets, data in text_slices(column.slice(start, ROWS_AT_ONCE)):
            for lo, hi in zip(offsets, offsets[1:]):
                yield data[lo:hi].tobytes().decode()


def write(docs, path, folder=None, end_id=END_ID):
    """Writes shards; a table of (shard, path, documents, ids), shards in order."""
    folder = folder or new_folder(docs.sparkSession, "tokens")

    def shard(batches):
        batches = (b for b in batches if b.num_rows)
        head = next(batches, None)
        if head is None:
            return
        encode, end = _encoder(path), struct.pack("<I", end_id)
        with new_file(folder, ".dac") as (uri, out):
            writer = Writer(out)
            while head is not None:
                for doc_id, ids in zip(head["doc_id"].to_pylist(), encode.each(_texts(head["text"]))):
                    writer.add_bytes(doc_id, ids + end)
                head = next(batches, None)
            encode.forget()
            writer.close()
        yield pa.RecordBatch.from_pydict(
            {
                "shard": [TaskContext.get().partitionId()],
                "path": [uri],
                "documents": [len(writer.docs)],
                "ids": [writer.n],
            },
        )

    order = ["doc_id", F.xxhash64("text")]
    dealt = docs.select("doc_id", "text").repartitionByRange(*order)
    files = dealt.sortWithinPartitions(*order, "text").mapInArrow(
        shard, "shard long, path string, documents long, ids long"
    )
    return listed(files, "token-files")


def read(files):
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the shards.

    ``start`` counts the ids of all documents before. One row per shard goes through the
    running sum.
    """
    before = F.sum("ids").over(W.orderBy("shard")) - F.col("ids")
    shards = files.select("path", before.alias("before"))

    def scan(batches):
        for batch in batches:
            for path, base in zip(batch["path"].to_pylist(), batch["before"].to_pylist()):
                with opened(path, random=True) as stream:
                    rows = [(d, base + s, n, c) for d, s, n, c in Shard(stream).documents()]
                names = ("doc_id", "start", "n_tokens", "ids_crc32")
                columns = list(zip(*rows)) or [()] * 4
                arrays = [pa.array(c, pa.int64()) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return shards.repartition(max(1, files.count())).mapInArrow(
        scan, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
