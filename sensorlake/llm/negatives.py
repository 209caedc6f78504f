"""Hard negatives: for an anchor and each of its nearest rows of the same label, the best
rows of other labels whose score lies in a window below that of the positive.

A score is the inner product of integer vectors; higher scores come first, then smaller
vec_ids.

1. Rows are dealt by ranges of (label, first component, vec_id) into tiles, and each task
   packs its tile by sort-tile-recursive: sorted along one coordinate, cut into slabs, each
   slab along the next, down to leaves. The minimum bounding boxes of the leaves, and of
   groups of boxes above them, make the R-tree of the tile.
2. Anchors are dealt into blocks. A pair of a tile and a block is a piece of work; pairs
   that no label can match are left out.
3. In a piece, a box bounds the score of an anchor from both sides: each coordinate of a
   box gives an interval of products, and they add up. A best-first queue opens the box
   with the highest bound, drops boxes that lie outside all score windows, and ends when
   the best bound is strictly below the k-th score of every window.
4. A first search over a sixty-fourth of the rows, chosen by hash, gives each window a k-th
   score that the whole search starts from. It only cuts what cannot be in the result:
   without it each tile would return k rows, however poor.

Rows take part if they have a vec_id, a label and a vector without null or non-finite
components whose length is the most frequent one. Rows that share an anchor's vec_id are
not its partners; if several have it, the one with the smallest (label, vector) is the
anchor. Other repeated rows count each. Anchors without a positive, and positives without a
row in their window, give no rows; nor does an empty table. Other columns are left out,
whatever their names.
"""

from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake.llm.vectors import common_size, matrix, product, with_integers
from sensorlake.session import written

#: Components (rows x dimensions) of a tile, and of a block of anchors, about.
TILE_CELLS, BLOCK_CELLS = 1 << 21, 1 << 17
LEAF, FAN = 128, 8
#: One row of so many is in the first search.
FIRST_SEARCH = 64


# The tree ------------------------------------------------------------------------------


def packed_order(labels, x):
    """Order of the rows in which every ``LEAF`` of them are a leaf."""
    coordinates = np.argsort(-x.astype(np.float64).var(axis=0), kind="stable")

    def cut(index, depth, left):
        pages = -(-len(index) // LEAF)
        if pages <= 1 or not left:
            return [index]
        values = labels if depth == 0 else x[:, coordinates[depth - 1]]
        index = index[np.argsort(values[index], kind="stable")]
        slabs = int(np.ceil(pages ** (1 / left)))
        size = -(-pages // slabs) * LEAF
        parts = [index[i : i + size] for i in range(0, len(index), size)]
        return [leaf for part in parts for leaf in cut(part, depth + 1, left - 1)]

    pages = max(1, -(-len(x) // LEAF))
    used = min(1 + x.shape[1], 1 + pages.bit_length())
    return np.concatenate(cut(np.arange(len(x)), 0, used))


class Tree:
    """Boxes over packed rows: leaves first, then each level above, the root last."""

    def __init__(self, ids, labels, x):
        self.ids, self.labels, self.x = ids, labels, x
        starts = np.arange(0, len(x), LEAF)
        self.leaves = len(starts)
        low, high = np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts)
        first, last = np.minimum.reduceat(labels, starts), np.maximum.reduceat(labels, starts)
        levels = [(low, high, first, last)]
        self.children = [None] * self.leaves
        begin = 0
        while len(levels[-1][0]) > 1:
            below = levels[-1]
            n = len(below[0])
            starts = np.arange(0, n, FAN)
            levels.append(
                tuple(f.reduceat(b, starts) for f, b in zip((np.minimum, np.maximum) * 2, below))
            )
            self.children += [range(begin + s, begin + min(s + FAN, n)) for s in starts]
            begin += n
        self.low, self.high, self.first, self.last = (np.concatenate(p) for p in zip(*levels))
        self.root = len(self.children) - 1

    def bounds(self, anchors):
        """(least, most) score of each anchor with any vector of each box."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        least = product(up, self.low.T) + product(down, self.high.T)
        most = product(up, self.high.T) + product(down, self.low.T)
        return least, most

    def matching(self, label, same):
        """Whether a box can hold a row with, or without, this label."""
        inside = (self.first <= label) & (self.last >= label)
        return inside if same else ~(inside & (self.first == self.last))

    def best(self, anchor, vector, label, same, windows, k, least, most, opened=None):
        """For each window (lo, hi, floor) the first k (-score, vec_id) in it. ``opened``
        gets the numbers of the leaves that were looked into."""
        found = [[] for _ in windows]
        floors = [max(lo, floor) if lo <= hi else np.inf for lo, hi, floor in windows]
        ceiling = max((hi for lo, hi, _ in windows if lo <= hi), default=-np.inf)
        good = (least <= ceiling) & self.matching(label, same)
        queue = [(-most[self.root], self.root)] if good[self.root] else []
        floor = min(floors, default=np.inf)
        while queue:
            top, node = heappop(queue)
            if -top < floor:
                break
            if node >= self.leaves:
                for child in self.children[node]:
                    if good[child] and most[child] >= floor:
                        heappush(queue, (-most[child], child))
                continue
            if opened is not None:
                opened.append(node)
            rows = slice(node * LEAF, (node + 1) * LEAF)
            score = self.x[rows] @ vector
            ok = (score >= floor) & (score <= ceiling) & (self.ids[rows] != anchor)
            ok = np.flatnonzero(ok & ((self.labels[rows] == label) == same))
            if not len(ok):
                continue
            some = sorted(zip((-score[ok]).tolist(), self.ids[rows][ok].tolist()))
            for w, (_, hi, _) in enumerate(windows):
                mine = [p for p in some if floors[w] <= -p[0] <= hi][:k]
                if mine:
                    found[w] = sorted(found[w] + mine)[:k]
                    if len(found[w]) == k:
                        floors[w] = max(floors[w], -found[w][-1][0])
            floor = min(floors)
        return found


# Tiles and blocks ------------------------------------------------------------------------


def _bytes(table):
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as stream:
        stream.write_table(table)
    return out.getvalue().to_pybytes()


def _table(data):
    return pa.ipc.open_stream(data).read_all()


def _narrow(table, d):
    """The table with ``x`` in the narrowest integers that hold it."""
    x = matrix(table["x"], d)
    top = int(np.abs(x).max(initial=0))
    kind = next(t for t in (np.int16, np.int32, np.int64) if top <= np.iinfo(t).max)
    flat = pa.array(x.astype(kind).reshape(-1))
    narrow = pa.ListArray.from_arrays(np.arange(0, x.size + 1, d, dtype=np.int32), flat)
    return table.set_column(table.column_names.index("x"), "x", narrow)


_PACKED = "part long, first long, last long, packed binary"


def _packed(rows, order, parts, most, d, tree):
    """Rows dealt by ranges of ``order``: a row per task, or more if it got too many."""

    def one(tables):
        table = pa.concat_tables(tables)
        labels = table["label"].to_numpy()
        if tree:
            table = table.take(pa.array(packed_order(labels, matrix(table["x"], d))))
        return pa.RecordBatch.from_pydict(
            {
                "part": [TaskContext.get().partitionId()],
                "first": [int(labels.min())],
                "last": [int(labels.max())],
                "packed": [_bytes(_narrow(table, d))],
            }
        )

    def pack(batches):
        waiting, n = [], 0
        for batch in batches:
            waiting.append(pa.Table.from_batches([batch]))
            n += batch.num_rows
            if n >= 2 * most:
                yield one(waiting)
                waiting, n = [], 0
        if n:
            yield one(waiting)

    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return written(dealt.mapInArrow(pack, _PACKED), "packed")


def _parts(spark, n, cells, least, d):
    """(parts, rows of each): of about so many cells, fewer if tasks would have nothing."""
    most = max(1, cells // d)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-n // most), min(tasks, -(-n // least))), most


def _tiles(rows, d):
    parts, most = _parts(rows.sparkSession, rows.count(), TILE_CELLS, 1024, d)
    order = ["label", F.col("x")[0], "vec_id", "place"]
    return _packed(rows, order, parts, most, d, tree=True)


def _blocks(anchors, d):
    parts, most = _parts(anchors.sparkSession, anchors.count(), BLOCK_CELLS, 64, d)
    return _packed(anchors, ["label", "anchor"], parts, most, d, tree=False)


# Search ----------------------------------------------------------------------------------

_FOUND = "anchor long, slot int, score long, vec_id long"


def _window(target, low, high):
    """(lo, hi, floor) of a target: all scores if it has none of its own."""
    floor = -np.inf if target["floor"] is None else target["floor"]
    if target["score"] is None:
        return -np.inf, np.inf, floor
    return -(-low * target["score"] // 100), high * target["score"] // 100, floor


def _searched(tiles, blocks, same, k, low, high, d):
    """(anchor, slot, score, vec_id) of one piece."""
    out = []
    for packed in tiles["packed"].to_pylist():
        tile = _table(packed)
        x = matrix(tile["x"], d)
        tree = Tree(tile["vec_id"].to_numpy(), tile["label"].to_numpy(), x)
        for block in blocks["packed"].to_pylist():
            block = _table(block)
            vectors = matrix(block["x"], d)
            exact = d * int(np.abs(x).max()) * int(np.abs(vectors).max()) < 1 << 53
            kind = np.float64 if exact else object
            tree.x = x.astype(kind)
            least, most = tree.bounds(vectors)
            rows = zip(
                block["anchor"].to_pylist(), vectors.astype(kind), block["label"].to_pylist(),
                block["targets"].to_pylist(), least, most,
            )
            for anchor, vector, label, targets, lo, hi in rows:
                windows = [_window(t, low, high) for t in targets]
                best = tree.best(anchor, vector, label, same, windows, k, lo, hi)
                out += [
                    (anchor, slot, -int(s), i) for slot, part in enumerate(best) for s, i in part
                ]
    columns = zip(*out) if out else [()] * 4
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
    names = ("anchor", "slot", "score", "vec_id")
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def _search(tiles, blocks, same, k, low, high, d):
    """The first k rows of every anchor and target: anchor, slot, score, vec_id, rank."""
    n_blocks = blocks.agg(F.max("part")).first()[0] + 1
    tile = tiles.groupBy(F.col("part").alias("tile")).agg(
        F.min("first").alias("t0"), F.max("last").alias("t1")
    )
    block = blocks.groupBy(F.col("part").alias("block")).agg(
        F.min("first").alias("b0"), F.max("last").alias("b1")
    )
    # every tile meets every block of the stated anchors, unless their labels rule it out
    pairs = tile.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))
    pairs = pairs.join(block, "block")
    if same:
        pairs = pairs.where("t0 <= b1 and b0 <= t1")
    else:
        pairs = pairs.where("not (t0 = t1 and b0 = b1 and t0 = b0)")
    pairs = pairs.select("tile", "block")
    left = pairs.join(tiles.select(F.col("part").alias("tile"), "packed"), "tile")
    right = pairs.join(blocks.select(F.col("part").alias("block"), "packed"), "block")
    # names of their own for the columns that both sides have from the pairs
    right = right.select(F.col("tile").alias("t"), F.col("block").alias("b"), "packed")

    def piece(a, b):
        return _searched(a, b, same, k, low, high, d)

    pieces = left.groupBy("tile", "block").cogroup(right.groupBy("t", "b"))
    found = pieces.applyInArrow(piece, _FOUND)
    order = W.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _with_floors(queries, found, k):
    """Queries whose targets start from the k-th score of a search."""
    floors = found.where(F.col("rank") == k).groupBy("anchor").agg(
        F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("floors")
    )
    targets = F.transform(
        "targets",
        lambda t, i: F.struct(
            t["id"].alias("id"), t["score"].alias("score"),
            F.try_element_at("floors", i).alias("floor"),
        ),
    )
    joined = queries.join(floors, "anchor", "left")
    return joined.select("anchor", "label", "x", targets.alias("targets"))


def _top(tiles, first_tiles, queries, same, k, low, high, d):
    """As ``_search``, with the floors of a search in the first tiles."""
    search = (same, k, low, high, d)
    if not first_tiles.isEmpty():
        found = written(_search(first_tiles, _blocks(queries, d), *search), "floors")
        queries = _with_floors(queries, found, k)
    return written(_search(tiles, _blocks(queries, d), *search), "found")


# The operator ----------------------------------------------------------------------------

_TARGETS = "array<struct<id:bigint,score:bigint,floor:bigint>>"
_RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, "
    "positive_score long, negative_score long"
)


def mined(rows, anchors_where, positives=5, negatives=10, low=30, high=90):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows
    of vec_id, label and ``embedding``; ``anchors_where`` is a condition on vec_id, and a negative's score is ``low`` to ``high`` per cent
    of the positive's."""
    rows = with_integers(rows.select("vec_id", "label", "embedding"))
    rows = rows.where("vec_id is not null and label is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        "x",
        F.monotonically_increasing_id().alias("place"),
    )
    rows = written(rows, "vectors")
    spark, d = rows.sparkSession, common_size(rows)
    rows = rows.where(F.size("x") == d)
    one = rows.where(anchors_where).groupBy(F.col("vec_id").alias("anchor"))
    anchors = one.agg(F.min(F.struct("label", "x")).alias("a")).select("anchor", "a.*")
    anchors = written(anchors, "anchors")
    if anchors.isEmpty():
        return spark.createDataFrame([], _RESULT)
    tiles = _tiles(rows, d)
    first_tiles = _tiles(rows.where(F.pmod(F.xxhash64("place"), F.lit(FIRST_SEARCH)) == 0), d)
    both = (tiles, first_tiles)

    anything = F.array(F.struct(*[F.lit(None).cast("long").alias(c) for c in ("id", "score", "floor")]))
    queries = anchors.select("anchor", "label", "x", anything.cast(_TARGETS).alias("targets"))
    near = _top(*both, queries, True, positives, low, high, d)
    near = near.groupBy("anchor").agg(
        F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("near")
    )
    queries = anchors.join(near, "anchor").select(
        "anchor", "label", "x",
        F.transform(
            "near",
            lambda p: F.struct(
                p["vec_id"].alias("id"), p["score"].alias("score"),
                F.lit(None).cast("long").alias("floor"),
            ),
        ).alias("targets"),
    )
    queries = written(queries, "queries")
    if queries.isEmpty():
        return spark.createDataFrame([], _RESULT)
    found = _top(*both, queries, False, negatives, low, high, d)
    targets = queries.select("anchor", F.posexplode("targets").alias("slot", "target"))
    return found.join(targets, ["anchor", "slot"]).select(
        F.col("anchor").alias("anchor_id"),
        F.col("target.id").alias("positive_id"),
        "rank",
        F.col("vec_id").alias("negative_id"),
        F.col("target.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
