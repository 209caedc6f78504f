"""Near copies: all links of documents whose sets of five-word shingles have a Jaccard
similarity of at least 0.8, by MinHash bands and full verification.

1. A sketch of each text: a key of its words, and one hash per band. Bands and rows are
   chosen for a target recall at the threshold.
2. Equal texts are one class from here on, so copies cost nothing more.
3. Classes that share a band hash meet in a bucket. Buckets of the same members are one;
   the rest of the work only sees classes that share a bucket.
4. A large bucket is cut into blocks, bounded in rows and bytes, and each pair of blocks
   is a piece of work: no task gets more than two blocks, however large the bucket. A
   pair of texts is compared in the first bucket that both are in, on their full sets.
   A piece gives sums of links per text and a spanning forest, never its pairs.
5. Connected components by alternating large and small stars, each round written to the
   shared folder.

A text of fewer than five words is one shingle of all of them. A text without words, null
included, links to nothing and is its own class. Repeated rows are copies of each other.
Rows without doc_id take part; a class id is the smallest doc_id of its class, null if
there is none. An empty table gives no rows. Columns beyond doc_id and text are left out
here and kept by ``drop_near_copies``, whatever their names.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sensorlake.llm.words import Words, grams, mix, text_slices, whole
from sensorlake.session import written

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
MOST_HASHES = 80
#: Bounds of a block: texts, and their bytes.
BLOCK_ROWS, BLOCK_BYTES = 256, 8 << 20
#: Keys go to all executors up to so many (16 bytes each), else they are joined by shuffle.
BROADCAST_KEYS = 1_000_000


def bands_for(threshold=THRESHOLD, recall=RECALL, most=MOST_HASHES):
    """(bands, rows): the most rows per band that reach the recall within ``most`` hashes."""
    best = None
    for rows in range(1, most + 1):
        miss = math.log(1 - threshold**rows) if threshold < 1 else -math.inf
        bands = max(1, math.ceil(math.log(1 - recall) / miss))
        if bands * rows > most:
            break
        best = (bands, rows)
    if best is None:
        raise ValueError("the recall needs more hashes")
    return best


# Sketches ------------------------------------------------------------------------------


def shingles(w, k=SHINGLE):
    """Shingle hashes of some texts, and where those of each text begin."""
    n = w.counts()
    gram = grams(w.hash, k)
    inside = whole(w.row, k)
    for row in np.flatnonzero((n > 0) & (n < k)):
        lo = w.first[row]
        gram[lo] = grams(w.hash[lo : lo + n[row]], n[row])[0]
        inside[lo] = True
    each = np.maximum(np.minimum(n, 1), n - (k - 1))
    return gram[inside], np.concatenate([[0], np.cumsum(each)])


def _keys(w):
    """16 bytes per text that tell its words in their order."""
    halves = []
    for salt in (0x9E6C63D0876A9A35, 0xC2B2AE3D27D4EB4F):
        at = np.arange(len(w), dtype=np.uint64) - np.repeat(
            w.first[:-1].astype(np.uint64), w.counts()
        )
        terms = mix(w.hash + mix((at + np.uint64(1)) * np.uint64(salt)))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        halves.append(mix(total[w.first[1:]] - total[w.first[:-1]]))
    return np.stack(halves, axis=1)


def _sketches(texts, bands, rows):
    """Keys (null without words) and band hashes of an Arrow array of texts."""
    rng = np.random.default_rng(20240229)
    factors = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
    keys, hashes = [], []
    for _, offsets, data in text_slices(texts):
        w = Words(offsets, data)
        gram, first = shingles(w)
        some = np.diff(first) > 0
        out = np.zeros((len(some), bands), np.uint64)
        if len(gram):
            begin = first[:-1][some]
            for band in range(bands):
                value = np.full(len(begin), band + 1, np.uint64)
                for j in range(band * rows, band * rows + rows):
                    least = np.minimum.reduceat(gram * factors[j] + shifts[j], begin)
                    value = mix(value * np.uint64(0x9E3779B97F4A7C15) + least)
                out[some, band] = value
        keys += [k.tobytes() if ok else None for k, ok in zip(_keys(w), some)]
        hashes.append(out)
    flat = np.concatenate(hashes).reshape(-1) if hashes else np.zeros(0, np.uint64)
    ends = np.arange(len(keys) + 1, dtype=np.int32) * bands
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))
    return pa.StructArray.from_arrays([pa.array(keys, pa.binary()), lists], ["key", "bands"])


def sketch(text, bands, rows):
    @F.arrow_udf("struct<key:binary,bands:array<bigint>>")
    def sketches(texts: pa.Array) -> pa.Array:
        return _sketches(texts, bands, rows)

    return sketches(text)


# Candidates ----------------------------------------------------------------------------


def _small(keys):
    """The keys with a broadcast hint if they are counted to be few."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def _classes(sketched):
    """key, rep (the smallest doc_id), n (rows), size (bytes of the text), bands."""
    return (
        sketched.where("key is not null")
        .groupBy("key")
        .agg(
            F.min("doc_id").alias("rep"),
            F.count(F.lit(1)).alias("n"),
            F.max(F.octet_length("text")).alias("size"),
            F.min("bands").alias("bands"),
        )
    )


def _memberships(classes):
    """key, rep, n, buckets: of each class in a bucket with another one."""
    members = classes.select(
        "key", "size", F.posexplode("bands").alias("pos", "bucket")
    )
    buckets = (
        members.groupBy("bucket")
        .agg(
            F.min("pos").alias("pos"),
            F.count(F.lit(1)).alias("n"),
            F.sum("size").alias("bytes"),
            F.bit_xor(F.xxhash64("key")).alias("a"),
            F.bit_xor(F.xxhash64("key", F.lit(1))).alias("b"),
        )
        .where("n > 1")
    )
    # buckets of the same members compare the same pairs: the first band's is enough
    kept = buckets.groupBy("a", "b", "n", "bytes").agg(
        F.min(F.struct("pos", "bucket")).alias("first")
    )
    blocks = F.greatest(
        F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("bytes") / BLOCK_BYTES)
    ).cast("int")
    kept = kept.select(F.col("first.bucket").alias("bucket"), blocks.alias("blocks"))
    return (
        members.join(kept, "bucket")
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "bucket", "blocks"))).alias("buckets"))
        .join(classes.select("key", "rep", "n"), "key")
    )


def _pieces(sketched, members):
    """A row per text and pair of blocks it is in: piece (bucket, lo, hi), block, and so on."""
    own = F.struct(F.col("key"), F.col("rep").alias("doc_id"))
    wanted = members.select(own.alias("own"))
    texts = sketched.select(
        F.struct("key", "doc_id").alias("own"), "key", "doc_id", "text"
    ).where("key is not null")
    texts = texts.join(_small(wanted), "own", "left_semi").dropDuplicates(["key"])
    rows = texts.select("key", "text").join(members.drop("rep"), "key")
    rows = rows.select("key", "n", "text", "buckets", F.explode("buckets").alias("at"))
    earlier = F.transform(
        F.filter("buckets", lambda b: b["pos"] < F.col("at")["pos"]), lambda b: b["bucket"]
    )
    block = F.pmod(F.xxhash64("key"), F.col("at.blocks")).cast("int")
    rows = rows.select(
        "key", "n", "text", F.col("at.bucket").alias("bucket"),
        earlier.alias("earlier"), block.alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("at.blocks") - 1)).alias("other"),
    )
    return rows.select(
        "bucket", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        "block", "key", "n", "earlier", "text",
    )


# Verification --------------------------------------------------------------------------


class _Piece:
    """The texts of one pair of blocks."""

    def __init__(self, keys, blocks, weights, earlier, sets, threshold):
        self.keys, self.blocks, self.weights = keys, blocks, weights
        self.earlier, self.sets, self.threshold = earlier, sets, threshold

    def links(self):
        """Pairs (i, j), i < j, that are similar and were not compared in another bucket."""
        k = len(self.keys)
        size = np.array([len(s) for s in self.sets], np.float64)
        todo = np.triu(np.ones((k, k), bool), 1)
        if self.blocks.min() != self.blocks.max():
            todo &= self.blocks[:, None] != self.blocks[None, :]
        least = self.threshold * np.maximum(size[:, None], size[None, :])
        todo &= np.minimum(size[:, None], size[None, :]) >= least
        if todo.any():
            todo &= _common(self.earlier) == 0
        if not todo.any():
            return np.zeros((0, 2), np.int64)
        both = _common(self.sets)
        union = size[:, None] + size[None, :] - both
        return np.argwhere(todo & (both >= self.threshold * union - 1e-9))

    def rows(self):
        """(key, other, links): sums of links of a text, then edges of a spanning forest."""
        pairs = self.links()
        if not len(pairs):
            return
        count = np.zeros(len(self.keys), np.int64)
        np.add.at(count, pairs[:, 0], self.weights[pairs[:, 1]])
        np.add.at(count, pairs[:, 1], self.weights[pairs[:, 0]])
        for i in np.flatnonzero(count):
            yield self.keys[i], None, int(count[i])
        root = list(range(len(self.keys)))

        def find(i):
            while root[i] != i:
                root[i] = i = root[root[i]]
            return i

        for i, j in pairs:
            i, j = find(i), find(j)
            if i != j:
                lo, hi = (i, j) if self.keys[i] < self.keys[j] else (j, i)
                root[hi] = lo
                yield self.keys[hi], self.keys[lo], 0


def _common(sets):
    """Sizes of the intersections of all pairs of sets, by products of incidence blocks."""
    k = len(sets)
    value = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(k), [len(s) for s in sets])
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = value[1:] != value[:-1]
    column = np.cumsum(new) - 1
    shared = np.bincount(column) > 1 if len(column) else np.zeros(0, bool)
    keep = shared[column] if len(column) else np.zeros(0, bool)
    owner, column = owner[keep], (np.cumsum(shared) - 1)[column[keep]]
    out = np.zeros((k, k), np.float32)
    n, step = int(shared.sum()), 4096
    edges = np.searchsorted(column, np.arange(0, n + step, step))
    for i in range(len(edges) - 1):
        part = slice(edges[i], edges[i + 1])
        incidence = np.zeros((k, min(step, n - i * step)), np.float32)
        incidence[owner[part], column[part] - i * step] = 1
        out += incidence @ incidence.T
    return out


def _verified(batches, threshold):
    """Goes through sorted rows, piece by piece; a piece may go on in the next batch."""
    waiting = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([waiting, rows]) if waiting is not None else rows
        at = np.stack([rows[c].to_numpy() for c in ("bucket", "lo", "hi")], axis=1)
        if not len(at):
            continue
        starts = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]).any(axis=1)])
        waiting = rows.slice(starts[-1])
        if len(starts) > 1:
            yield from _checked(rows.slice(0, starts[-1]), starts, threshold)
    if waiting is not None:
        yield from _checked(waiting, np.array([0, len(waiting)]), threshold)


def _checked(rows, starts, threshold):
    sets = []
    for _, offsets, data in text_slices(rows["text"]):
        gram, first = shingles(Words(offsets, data))
        sets += [np.unique(gram[a:b]) for a, b in zip(first, first[1:])]
    keys = rows["key"].to_pylist()
    blocks, weights = rows["block"].to_numpy(), rows["n"].to_numpy()
    earlier = [np.array(x, np.int64).view(np.uint64) for x in rows["earlier"].to_pylist()]
    out = []
    for lo, hi in zip(starts, starts[1:]):
        piece = _Piece(
            keys[lo:hi], blocks[lo:hi], weights[lo:hi], earlier[lo:hi], sets[lo:hi], threshold
        )
        out += piece.rows()
    if out:
        key, other, links = zip(*out)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key, pa.binary()), pa.array(other, pa.binary()), pa.array(links, pa.int64())],
            ["key", "other", "links"],
        )


# Components ----------------------------------------------------------------------------


def components(edges):
    """(key, root) of every node of the edges (key, other); a root is the smallest node."""
    edges = written(edges.select(F.col("key").alias("u"), F.col("other").alias("v")), "edges")
    before = None
    while True:
        # large star: neighbours that are larger go to the smallest neighbour
        both = edges.union(edges.select("v", "u")).distinct()
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: smaller neighbours and the node itself go to the smallest
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
        edges = written(small.where("u <> v").distinct(), "edges")
        now = tuple(
            edges.agg(
                F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))
            ).first()
        )
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("key"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("key"), F.col("v").alias("root")).union(roots)


# The operator --------------------------------------------------------------------------


def _joined(sketched, threshold):
    """key, class_id, n_links, of classes with more than one row or with links."""
    classes = written(_classes(sketched), "classes")
    members = written(_memberships(classes), "members")
    piece = ["bucket", "lo", "hi"]
    pieces = _pieces(sketched, members).repartition(*piece).sortWithinPartitions(*piece)
    found = pieces.mapInArrow(
        lambda batches: _verified(batches, threshold), "key binary, other binary, links long"
    )
    found = written(found, "links")
    links = found.where("other is null").groupBy("key").agg(F.sum("links").alias("links"))
    parts = written(components(found.where("other is not null")), "components")
    roots = classes.select("key", "rep", "n").join(parts, "key", "left")
    roots = roots.where("n > 1 or root is not null").withColumn("root", F.coalesce("root", "key"))
    ids = roots.groupBy("root").agg(F.min("rep").alias("class_id"))
    return (
        roots.join(ids, "root")
        .join(links, "key", "left")
        .select("key", "root", "class_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )


def join(docs, threshold=THRESHOLD, recall=RECALL):
    """(doc_id, class_id, n_links) of every row: the smallest doc_id it is linked with,
    over any chain of links, and how many other rows it is similar to itself."""
    bands, rows = bands_for(threshold, recall)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sketched = docs.select("*", sketch(F.col("text"), bands, rows).alias("s"))
    sketched = written(sketched.select("doc_id", "text", "s.key", "s.bands"), "sketches")
    found = written(_joined(sketched, threshold), "classes")
    rows = sketched.select("doc_id", "key").join(_small(found.drop("root")), "key", "left")
    return rows.select(
        "doc_id",
        F.when(F.col("n_links").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def drop_near_copies(docs, threshold=THRESHOLD, recall=RECALL):
    """``docs`` with one row of each class: that of its smallest doc_id; of repeated rows
    of that doc_id, the first by a hash of the row."""
    bands, rows = bands_for(threshold, recall)
    whole_row = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    sketched = whole_row.select("row", "doc_id", sketch(F.col("text"), bands, rows).alias("s"))
    sketched = written(
        sketched.select("row", "doc_id", "s.key", "s.bands"), "sketches"
    ).withColumn("text", F.coalesce("row.text", F.lit("")))
    found = written(_joined(sketched, threshold), "classes")
    joined = sketched.select("row", "doc_id", "key").join(_small(found), "key", "left")
    kept = joined.where(F.col("root").isNull() | F.col("doc_id").eqNullSafe(F.col("class_id")))
    alone = kept.where(F.col("root").isNull()).select("row.*")
    # several rows of a class may have its smallest doc_id
    first = kept.where(F.col("root").isNotNull()).dropDuplicates(["root"]).select("row.*")
    return alone.union(first)
