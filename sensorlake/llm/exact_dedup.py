"""Exact copies by a minimal perfect hash over the digests of what was kept before.

1. Each text, with A-Z lowered, gives its SHA-256 digest; texts are not moved again.
2. The history is an index in shards by digest. A shard has a minimal perfect hash of its
   distinct digests and, per slot, the full digest, the number of rows and the locator of
   the winner: the largest doc_id, and of rows that repeat it the last place in the table.
3. Digests that arrive are grouped first, one row each however many copies there are. The
   hash names one slot for each; where its bytes are the same the digest is known and the
   slot's winner and count move on, else it is new and groups on its own.
4. ``repeats`` takes the older half of a table (by doc_id) as the history and the rest as
   what arrives. A later load calls ``arrive`` with the index of the earlier ones.

The hash is a cascade of bitmaps: a digest takes the bit it hashes to if it is alone there,
else it goes to the next, smaller bitmap. The slot is the rank of its bit.

Null text is empty text; empty texts are copies of each other. Repeated rows are copies,
and exactly one row of a group stays. Rows without doc_id take part; they stay only in a
group without any doc_id. An empty table gives no rows and an index without shards. Other
columns are left out here and kept by ``drop_repeats``, whatever their names.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sensorlake.llm.words import mix, text_slices
from sensorlake.session import written

#: Distinct digests of a shard, about: some 60 bytes each in memory.
SHARD_DIGESTS = 1 << 18
#: Bits per digest of the first bitmap, and of every later one for the digests that are left.
ROOM = 2
#: Groups of copies go to all executors up to so many, else they are joined by shuffle.
BROADCAST_GROUPS = 1_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# Digests -------------------------------------------------------------------------------


def digests(texts):
    """SHA-256 of each text of an Arrow array, with A-Z lowered."""
    out = []
    for _, offsets, data in text_slices(texts):
        low = memoryview(_LOWER[data])
        out += [hashlib.sha256(low[a:b]).digest() for a, b in zip(offsets, offsets[1:])]
    return pa.array(out, pa.binary())


def digest(text):
    @F.arrow_udf("binary")
    def of(texts: pa.Array) -> pa.Array:
        return digests(texts)

    return of(text)


def grouped(digested):
    """One row per digest: the winner's locator (doc_id, place) and the number of rows."""
    return digested.groupBy("digest").agg(
        F.max(F.struct("doc_id", "place")).alias("winner"), F.count(F.lit(1)).alias("n")
    )


# The hash ------------------------------------------------------------------------------


def _words(digest_bytes):
    return np.frombuffer(digest_bytes, "<u8").reshape(-1, 4)


def _places(words, level, size):
    """Bit of each digest in the bitmap of a level."""
    salt = (level + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
    value = mix(words[:, 0] + np.uint64(salt))
    for j in range(1, 4):
        value = mix(value ^ words[:, j])
    return value % np.uint64(size)


class PerfectHash:
    """Slot of each of n known digests, 0 to n - 1, no two the same; of any other digest
    some slot or -1."""

    def __init__(self, sizes, bits):
        self.sizes = sizes
        self.bits = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
        self.rank = np.cumsum(self.bits, dtype=np.int64) - 1

    @staticmethod
    def of(words):
        """(sizes, bits) for distinct digests."""
        sizes, maps = [], []
        while len(words):
            size = -(-ROOM * len(words) // 8) * 8
            place = _places(words, len(sizes), size).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            maps.append(np.packbits(alone, bitorder="little").tobytes())
            words = words[~alone[place]]
        return sizes, b"".join(maps)

    def slots(self, words):
        out = np.full(len(words), -1, np.int64)
        left, first = np.arange(len(words)), 0
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = first + _places(words[left], level, size).astype(np.int64)
            hit = self.bits[at] > 0
            out[left[hit]] = self.rank[at[hit]]
            left, first = left[~hit], first + size
        return out


INDEX = (
    "shard long, shards long, sizes array<int>, bits binary, digests binary, "
    "known binary, doc_ids binary, places binary, counts binary"
)
_FOUND = "digest binary, doc_id long, place long, n long, known boolean"


def _shard_of(shards):
    """Shard of a digest by its first bytes, which are as good as random."""
    head = F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long")
    return F.pmod(head, F.lit(shards)).alias("shard")


def _columns(table):
    """Whether a group has a doc_id, that id, the winner's place and the number of rows."""
    if not len(table):
        none = np.zeros(0, np.int64)
        return none.astype(bool), none, none, none
    winner = table["winner"].combine_chunks()
    ids = winner.field("doc_id")
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    places = winner.field("place").to_numpy()
    return known, ids.fill_null(0).to_numpy(), places, table["n"].to_numpy()


def _packed_shard(key, table):
    """One row of the index."""
    raw = b"".join(table["digest"].to_pylist())
    words = _words(raw)
    sizes, bits = PerfectHash.of(words)
    order = np.argsort(PerfectHash(sizes, bits).slots(words))
    known, ids, places, counts = (c[order] for c in _columns(table))
    fields = {
        "shard": [key[0].as_py()],
        "shards": [table["shards"][0].as_py()],
        "sizes": [sizes],
        "bits": [bits],
        "digests": [words[order].tobytes()],
        "known": [known.astype(np.uint8).tobytes()],
        "doc_ids": [ids.astype("<i8").tobytes()],
        "places": [places.astype("<i8").tobytes()],
        "counts": [counts.astype("<i8").tobytes()],
    }
    types = [pa.int64(), pa.int64(), pa.list_(pa.int32()), *[pa.binary()] * 6]
    return pa.table([pa.array(v, t) for v, t in zip(fields.values(), types)], list(fields))


def build(groups, shards):
    """The index of some groups, a row per shard."""
    rows = groups.select("*", _shard_of(shards), F.lit(shards).cast("long").alias("shards"))
    return rows.groupBy("shard").applyInArrow(_packed_shard, INDEX)


def _arrived(key, table, index):
    """What arrives at a shard, looked up in it, and the slots that nothing hits."""
    raw = b"".join(table["digest"].to_pylist()) if len(table) else b""
    words = _words(raw)
    known, ids, places, counts = _columns(table)
    same = np.zeros(len(words), bool)
    rest = None
    if len(index):
        row = index.slice(0, 1).to_pylist()[0]
        slot_words = _words(row["digests"])
        slots = PerfectHash(row["sizes"], row["bits"]).slots(words)
        at = np.maximum(slots, 0)
        same = (slots >= 0) & (slot_words[at] == words).all(axis=1)
        old_known = np.frombuffer(row["known"], np.uint8).astype(bool)
        old_ids, old_places, old_counts = (
            np.frombuffer(row[c], "<i8") for c in ("doc_ids", "places", "counts")
        )
        counts = counts + np.where(same, old_counts[at], 0)
        # the slot's winner stays if it is the larger (doc_id, place), null first
        mine = np.stack([known.astype(np.int64), ids, places])
        other = np.stack([old_known[at].astype(np.int64), old_ids[at], old_places[at]])
        less = np.zeros(len(words), bool)
        for a, b in zip(mine[::-1], other[::-1]):
            less = (a < b) | ((a == b) & less)
        stays = same & less
        known, ids, places = (np.where(stays, b, a) for a, b in zip(mine, other))
        hit = np.zeros(len(slot_words), bool)
        hit[slots[same]] = True
        rest = [x[~hit] for x in (slot_words, old_known, old_ids, old_places, old_counts)]
    parts = [(words, known, ids, places, counts, same)]
    if rest is not None:
        parts.append((*rest, np.ones(len(rest[0]), bool)))
    words, known, ids, places, counts, same = (np.concatenate(x) for x in zip(*parts))
    flat = words.tobytes()
    return pa.table(
        [
            pa.array([flat[i : i + 32] for i in range(0, len(flat), 32)], pa.binary()),
            pa.array(ids.astype(np.int64), pa.int64(), mask=~known.astype(bool)),
            pa.array(places.astype(np.int64), pa.int64()),
            pa.array(counts.astype(np.int64), pa.int64()),
            pa.array(same, pa.bool_()),
        ],
        ["digest", "doc_id", "place", "n", "known"],
    )


def arrive(groups, index, shards):
    """Groups of the history and of what arrives together: digest, winner, n, and whether
    the history knew it. ``index`` has ``shards`` shards; those without a row are empty."""
    rows = groups.select("*", _shard_of(shards))
    found = rows.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(_arrived, _FOUND)
    return found.select("digest", F.struct("doc_id", "place").alias("winner"), "n", "known")


# The operator --------------------------------------------------------------------------


def _shards(spark, n):
    """Enough shards for their size, and for all tasks of a shuffle to have several."""
    return max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // SHARD_DIGESTS))


def _digested(docs, *keep):
    """The columns ``keep``, doc_id, place and digest of each row, as a table."""
    rows = docs.select(
        *keep,
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("place"),
        digest(F.coalesce("text", F.lit(""))).alias("digest"),
    )
    return written(rows, "digests")


def _groups(digested):
    """Groups of a table: its older half is the history, the rest arrives."""
    spark = digested.sparkSession
    lo, hi, n = digested.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    middle = (lo + hi) // 2 if lo is not None else 0
    older = F.col("doc_id").isNull() | (F.col("doc_id") <= middle)
    shards = _shards(spark, n)
    index = written(build(grouped(digested.where(older)), shards), "history")
    return arrive(grouped(digested.where(~older)), index, shards)


def _with_groups(digested):
    """Each row with the winner and size of its group; null if it is alone."""
    copies = written(_groups(digested).where("n > 1").select("digest", "winner", "n"), "copies")
    copies = F.broadcast(copies) if copies.count() <= BROADCAST_GROUPS else copies
    return digested.join(copies, "digest", "left")


def repeats(docs):
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row."""
    rows = _with_groups(_digested(docs))
    alone = F.col("n").isNull()
    return rows.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("winner.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("winner.place") == F.col("place"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_repeats(docs):
    """``docs`` with one row of each group of equal texts."""
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    rows = _with_groups(_digested(rows, "row"))
    kept = F.col("n").isNull() | (F.col("winner.place") == F.col("place"))
    return rows.where(kept).select("row.*")
