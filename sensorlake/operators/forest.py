"""Isolation forest as a Spark job (Liu, Ting and Zhou, ICDM 2008).

Every tree grows on a small random sample. Rows pick their trees by hash, so the
sample needs one pass over the data and moves only the rows that were picked. Trees
grow in parallel, one task group per tree; the finished forest is a small table of
nodes, which scoring ships to the tasks.
"""

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake.functions.scores import model_score, severity
from sensorlake.operators.features import feature_columns, scaled, scaling
from sensorlake.operators.slices import ROWS_PER_SLICE, exact_quantiles
from sensorlake.schemas import FEATURES
from sensorlake.session import written

N_TREES = 100
SAMPLE = 256
CONTAMINATION = 0.05
SEED = 42
OVERSAMPLE = 1.5
EULER = 0.5772156649015329
#: Rows whose sets of leaves stay in a processor's cache, and the squared leaves of a group
#: of trees: 100 trees of 256 leaves have 80 MB of sets at most.
ROWS_AT_ONCE, LEAF_PAIRS = 256, 100 << 16

NODES = (
    "tree int, node int, feature int, threshold double, left int, right int, "
    "size long, depth int"
)


@dataclass(frozen=True)
class Forest:
    """Nodes as rows (at most 2 * sample - 1 per tree), scaling and threshold."""

    nodes: tuple
    scale: dict
    offset: float
    sample: int
    columns: tuple = FEATURES


def mean_path(n):
    """Average depth at which a point is found among n points."""
    n = np.asarray(n, dtype=float)
    grown = 2.0 * (np.log(np.maximum(n - 1.0, 1.0)) + EULER) - 2.0 * (n - 1.0) / np.maximum(n, 1.0)
    return np.where(n > 2, grown, np.where(n == 2, 1.0, 0.0))


def tree_samples(rows, n_rows, key, n_trees=N_TREES, sample=SAMPLE, seed=SEED):
    """Assign rows to trees and keep ``sample`` of them per tree.

    Trees are dealt out in rounds. In a round a row's hash picks at most one tree, so
    that each tree expects OVERSAMPLE times its sample; the rows with the smallest
    hashes stay. With many rows one round serves all trees; with few rows there are
    up to one round per tree, each over few rows.
    """
    identity = [F.col(c) for c in key]
    expected = min(float(n_rows), OVERSAMPLE * sample)
    per_round = max(1, min(n_trees, int(n_rows / expected)))
    rounds = -(-n_trees // per_round)
    hashed = F.pmod(F.xxhash64(F.lit(seed), F.col("_round"), F.col("_identity")), F.lit(1 << 52))
    slot = F.floor(hashed / float(1 << 52) * (n_rows / expected)).cast("int")
    picked = (
        rows.withColumn("_identity", F.xxhash64(*identity))
        .withColumn("_round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
        .withColumn("_slot", slot)
        .withColumn("tree", F.col("_round") * per_round + F.col("_slot"))
        .filter((F.col("_slot") < per_round) & (F.col("tree") < n_trees))
        .withColumn("_draw", F.xxhash64(F.lit(seed + 1), F.col("tree"), F.col("_identity")))
    )
    order = W.partitionBy("tree").orderBy("_draw", *rows.columns)
    return (
        picked.withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= sample)
        .select("tree", F.col("_rank").alias("rank"), *rows.columns)
    )


def _grow(values, rng, limit):
    """Nodes of one tree over a small matrix, children before nothing: breadth first."""
    nodes, waiting = [], [(np.arange(len(values)), 0)]
    while len(nodes) < len(waiting):
        rows, depth = waiting[len(nodes)]
        part = values[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        open_features = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(open_features):
            nodes.append((-1, 0.0, -1, -1, len(rows), depth))
            continue
        feature = int(rng.choice(open_features))
        threshold = float(rng.uniform(low[feature], high[feature]))
        below = part[:, feature] <= threshold
        left = len(waiting)
        waiting += [(rows[below], depth + 1), (rows[~below], depth + 1)]
        nodes.append((feature, threshold, left, left + 1, len(rows), depth))
    return nodes


def _tree_builder(columns, seed, limit):
    def build(pdf):
        tree = int(pdf["tree"].iloc[0])
        values = pdf.sort_values("rank")[list(columns)].to_numpy(dtype=float)
        nodes = _grow(values, np.random.default_rng([seed, tree]), limit)
        out = pd.DataFrame(
            nodes, columns=["feature", "threshold", "left", "right", "size", "depth"]
        )
        out.insert(0, "node", range(len(nodes)))
        out.insert(0, "tree", tree)
        return out

    return build


def grow_forest(samples, columns=FEATURES, seed=SEED, sample=SAMPLE):
    """Node table of the forest, one group of at most ``sample`` rows per tree."""
    limit = int(np.ceil(np.log2(max(sample, 2))))
    return samples.groupBy("tree").applyInPandas(_tree_builder(columns, seed, limit), NODES)


def _packed(nodes):
    """Path lengths by leaf, a row per tree; per feature its sorted splits as arrays of
    threshold, tree, and the first and the end of the leaves on the left; and the depth.

    Leaves are numbered from left to right. A split between two leaves of one path length
    does not matter, so it counts as a leaf.
    """
    trees, paths, splits = {}, [], {}
    for n in nodes:
        trees.setdefault(n["tree"], []).append(n)
    for tree, rows in enumerate(trees.values()):
        rows.sort(key=lambda n: n["node"])
        path = np.array([n["depth"] for n in rows]) + mean_path([n["size"] for n in rows])
        n_leaves = np.ones(len(rows), int)
        for i, n in reversed(list(enumerate(rows))):
            if n["feature"] >= 0:
                both = [n["left"], n["left"] + 1]
                if n_leaves[both].sum() == 2 and path[both[0]] == path[both[1]]:
                    path[i] = path[both[0]]
                else:
                    n_leaves[i] = n_leaves[both].sum()
        found, waiting = [], [(0, 0)]
        while waiting:
            i, first = waiting.pop()
            if n_leaves[i] == 1:
                found.append(path[i])
                continue
            left, end = rows[i]["left"], first + n_leaves[rows[i]["left"]]
            waiting += [(left + 1, end), (left, first)]
            split = (rows[i]["threshold"], tree, first, end)
            splits.setdefault(rows[i]["feature"], []).append(split)
        paths.append(found)
    table = np.zeros((len(paths), max(map(len, paths))))
    for row, found in zip(table, paths):
        row[: len(found)] = found
    splits = {f: [np.array(x) for x in zip(*sorted(some))] for f, some in sorted(splits.items())}
    return (table, splits), max(n["depth"] for n in nodes)


def _leaf_sets(packed):
    """Groups of trees, each with its first tree, its end, and per feature the thresholds and
    for each place among them the leaves that a value there leaves over: as bits, the first
    64 leaves of all trees, then the next ones.

    A group's bits grow with the square of its leaves, so large trees come in small groups.
    """
    paths, splits = packed
    width, groups = paths.shape[1], []
    words, step = -(-width // 64), max(1, LEAF_PAIRS // width**2)
    low = np.array([(1 << k) - 1 for k in range(65)], np.uint64)
    for start in range(0, len(paths), step):
        n, sets = min(step, len(paths) - start), []
        for feature, arrays in splits.items():
            here = (arrays[1] >= start) & (arrays[1] < start + n)
            threshold, tree, first, end = (x[here] for x in arrays)
            if not len(tree):
                continue
            cuts, place = np.unique(threshold, return_inverse=True)
            left = np.full((len(cuts) + 1, words * n), low[64])
            for k in range(words):
                out = low[np.clip(end - 64 * k, 0, 64)] & ~low[np.clip(first - 64 * k, 0, 64)]
                np.bitwise_and.at(left, (place + 1, k * n + tree - start), ~out)
            sets.append((feature, cuts, np.bitwise_and.accumulate(left, axis=0)))
        groups.append((start, start + n, sets))
    return groups


def _leaves(n_trees, sets, columns):
    """The leaf of each tree, a row, that each row of the columns ends in."""
    n = len(columns[0])
    leaf, places = np.zeros((n_trees, n), np.uint16), []
    for feature, cuts, left in sets:
        # what is not a number is above no threshold
        values = np.where(np.isnan(columns[feature]), -np.inf, columns[feature])
        places.append((np.searchsorted(cuts, values), left))
    if not places:
        return leaf
    live, some = np.empty((2, ROWS_AT_ONCE, places[0][1].shape[1]), np.uint64)
    for at in range(0, n, ROWS_AT_ONCE):
        live, some = live[: n - at], some[: n - at]
        for i, (place, left) in enumerate(places):
            left.take(place[at : at + ROWS_AT_ONCE], axis=0, out=some if i else live, mode="clip")
            if i:
                np.bitwise_and(live, some, out=live)
        # zeros below the lowest bit; 64 in a word without one
        np.subtract(live, np.uint64(1), out=some)
        np.bitwise_and(np.invert(live, out=live), some, out=some)
        zeros = np.bitwise_count(some)
        found = zeros[:, :n_trees].astype(np.uint16)
        for k in range(1, zeros.shape[1] // n_trees):
            found += zeros[:, k * n_trees : (k + 1) * n_trees] * (found == 64 * k)
        leaf[:, at : at + ROWS_AT_ONCE] = found.T
    return leaf


def _path_lengths(packed, depth, columns, groups=None):
    """Mean path length per row, by sets of leaves (QuickScorer; Lucchese et al., 2015).

    A value above a split's threshold rules out the leaves on its left. Of the leaves that no
    feature rules out the leftmost is the one a walk from the root ends in. Lengths are added
    from the first tree to the last.
    """
    paths, total = packed[0], np.zeros(len(columns[0]))
    for start, end, sets in _leaf_sets(packed) if groups is None else groups:
        for path, at in zip(paths[start:end], _leaves(end - start, sets, columns)):
            total += path.take(at)
    return total / len(paths)


def isolation_score(forest_nodes, sample, columns):
    """Column in (0, 1]: near 1 for points that are isolated early."""
    packed, depth = _packed(forest_nodes)
    scale = float(mean_path(sample)) or 1.0

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        groups = _leaf_sets(packed)
        for features in batches:
            columns = [f.to_numpy(dtype=float) for f in features]
            yield pd.Series(2.0 ** (-_path_lengths(packed, depth, columns, groups) / scale))

    return score(*[F.col(c) for c in columns])


def fit_scored(
    features,
    key,
    columns=None,
    n_trees=N_TREES,
    sample=SAMPLE,
    contamination=CONTAMINATION,
    seed=SEED,
    rows_per_slice=ROWS_PER_SLICE,
):
    """Train on a feature frame; returns the forest and the training decisions.

    ``key`` names columns that identify a row, so that the forest does not depend on how
    the rows are partitioned or on a task that runs again. ``columns`` are the feature
    columns that are there, if not given. The node table that comes back to the driver has
    at most n_trees * (2 * sample - 1) rows. The threshold is the exact quantile of
    the training scores at the contamination; scores are written once to the shared
    folder, since ranking reads them more than once.
    """
    columns = tuple(columns or feature_columns(features))
    n_rows, scale = scaling(features, columns)
    if not n_rows:
        raise ValueError("no rows to train on")
    extra = [c for c in key if c not in columns]
    rows = scaled(features.select(*extra, *columns), scale)
    size = min(sample, n_rows)
    samples = tree_samples(rows, n_rows, key, n_trees, size, seed)
    nodes = tuple(
        sorted(grow_forest(samples, columns, seed, size).collect(), key=lambda n: (n[0], n[1]))
    )
    return with_threshold(Forest(nodes, scale, 0.0, size, columns), rows, contamination, rows_per_slice)


def with_threshold(forest, rows, contamination=CONTAMINATION, rows_per_slice=ROWS_PER_SLICE):
    """The forest with the threshold that flags this share of scaled rows, and their
    decisions."""
    score = -isolation_score(forest.nodes, forest.sample, forest.columns)
    scores = written(rows.select(score.alias("score")), "scores")
    quantile = exact_quantiles(scores, [], "score", [contamination], rows_per_slice).first()
    offset = quantile["quantiles"][0]
    return replace(forest, offset=offset), scores.select(
        (F.col("score") - offset).alias("decision")
    )


def fit(features, key, **options):
    """Train on a feature frame; see ``fit_scored``."""
    return fit_scored(features, key, **options)[0]


def decide(features, forest):
    """Add ``decision``: below 0 is anomalous. Rows with a missing feature get null."""
    unscaled = [F.col(c).alias(f"_raw_{c}") for c in forest.columns]
    others = [c for c in features.columns if c not in forest.columns]
    rows = scaled(features.select(*others, *unscaled, *forest.columns), forest.scale)
    complete = ~F.greatest(*[F.col(c).isNull().cast("int") for c in forest.columns]).cast("boolean")
    score = isolation_score(forest.nodes, forest.sample, forest.columns)
    decision = F.when(complete, -score - F.lit(forest.offset))
    return rows.withColumn("decision", decision).select(
        *[
            F.col(f"_raw_{c}").alias(c) if c in forest.columns else F.col(c)
            for c in features.columns
        ],
        "decision",
    )


def predict(features, forest):
    """Score (four decimals), flag and severity per row; severity sees the exact score."""
    score = model_score(F.col("decision"))
    return (
        decide(features, forest)
        .withColumn("_score", score)
        .withColumn("anomaly_score", F.round("_score", 4))
        .withColumn("is_anomaly", F.col("decision") < 0)
        .withColumn("severity", F.when(F.col("_score").isNotNull(), severity(F.col("_score"))))
        .drop("_score")
    )


def training_metrics(decided, forest, contamination=CONTAMINATION, n_trees=N_TREES):
    """One row of training figures from the decided training rows."""
    anomalies = F.count_if(F.col("decision") < 0)
    return decided.agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.lit(len(forest.columns)).alias("n_features"),
        F.array(*[F.lit(c) for c in forest.columns]).alias("feature_names"),
        anomalies.alias("n_anomalies_detected"),
        F.round(anomalies / F.count(F.lit(1)), 4).alias("anomaly_ratio"),
        F.lit(contamination).alias("contamination"),
        F.lit(n_trees).alias("n_estimators"),
        F.round(F.avg("decision"), 4).alias("score_mean"),
        F.round(F.stddev_pop("decision"), 4).alias("score_std"),
    )
