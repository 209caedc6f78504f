"""Ordered work on keys of any size.

A window per key puts all rows of that key into one task. Here a key with more
rows than ``rows_per_slice`` is first cut into slices along its order column, the
window runs per slice, and what one slice needs from the others travels in a small
table with one row per slice. Keys below the limit stay whole.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake.session import written

ROWS_PER_SLICE = 4_000_000
BROADCAST_ROWS = 1_000_000
PARTS = 1024
#: Levels of cuts: each multiplies the slice number by 2,048, which a long holds five times.
LEVELS = 5

SLICE = "_slice"


def cut(df, keys, at, rows_per_slice=ROWS_PER_SLICE, ties=()):
    """Add ``_slice``, which grows with the numeric column ``at`` within each key.

    Returns the frame and whether anything was cut. A level cuts the groups that are
    too large at approximate quantiles, so that a burst is cut as well as an even
    flow, into n / rows_per_slice parts, at most 1024; what is still too large is cut
    again on the next level. A group of one ``at`` is cut along ``ties``, numbers that
    order equal rows; rows that are equal in all of them stay together. The cut points of
    a level are broadcast: there are at most rows / rows_per_slice of them.
    """
    keys, columns = list(keys), [at, *ties]
    sliced = df.withColumn(SLICE, F.lit(0).cast("bigint"))
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    if (sizes.agg(F.max("_n")).first()[0] or 0) <= rows_per_slice:
        return sliced, False  # the usual case costs one aggregate
    level = 0
    while True:
        # one aggregate for all columns that are left; the first that still cuts a group is next
        large = written(_too_large(sliced, keys, columns, rows_per_slice), "large-groups")
        found = large.agg(*[F.count_if(F.col(f"_p{i}") > 0) for i in range(len(columns))]).first()
        at = next((i for i, n in enumerate(found) if n), None)
        if at is None:
            return sliced, level > 0
        if level == LEVELS:
            raise ValueError(f"groups of more than {rows_per_slice} rows are left after all cuts")
        level += 1
        large = large.filter(F.col(f"_p{at}") > 0).withColumn("_parts", F.col(f"_p{at}"))
        large = large.drop(*[f"_p{i}" for i in range(len(columns))])
        few, columns = found[at] <= BROADCAST_ROWS, columns[at:]
        large = F.broadcast(large) if few else large
        points = _cut_points(sliced.join(large, _same(keys)), keys, columns[0])
        points = written(points, "cut-points")
        most = points.agg(F.max(F.size("_cuts"))).first()[0]
        points = F.broadcast(points) if few else points
        parted = _with_part(sliced.join(points, _same(keys), "left"), columns[0], most)
        sliced = parted.select(
            *df.columns, (F.col(SLICE) * (2 * PARTS) + F.col("_part")).alias(SLICE)
        )


def _same(keys):
    """A group of the frame is a row of a table with the columns _k0, _k1, ..., _ks."""
    pairs = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return [*pairs, F.col(SLICE) == F.col("_ks")]


def _renamed(table, keys):
    names = {**{k: f"_k{i}" for i, k in enumerate(keys)}, SLICE: "_ks"}
    return table.withColumnsRenamed(names)


def _too_large(sliced, keys, columns, rows_per_slice):
    """Groups that are too large, with the parts ``_p0``, ``_p1``, ... into which each of the
    columns would cut them; 0 where it cannot."""
    groups = sliced.groupBy(*keys, SLICE).agg(
        *[f(c).alias(f"{name}{i}") for i, c in enumerate(columns)
          for name, f in (("_n", F.count), ("_lo", F.min), ("_hi", F.max))]
    )

    def parts(i):
        n = F.col(f"_n{i}")
        large = (n > rows_per_slice) & (F.col(f"_hi{i}") > F.col(f"_lo{i}"))
        within = F.least(F.ceil(n / rows_per_slice), F.lit(PARTS)).cast("int")
        return F.when(large, within).otherwise(0).alias(f"_p{i}")

    large = groups.select(*keys, SLICE, *[parts(i) for i in range(len(columns))])
    some = F.greatest(*[F.col(f"_p{i}") for i in range(len(columns))], F.lit(0)) > 0
    return _renamed(large.filter(some), keys)


def _cut_points(rows, keys, at):
    """Per group its parts - 1 cut points."""
    shares = F.expr("array(" + ", ".join(f"{i / PARTS}D" for i in range(1, PARTS)) + ")")
    groups = rows.groupBy(*keys, SLICE).agg(
        F.max("_parts").alias("_parts"), F.percentile_approx(at, shares, 10 * PARTS).alias("_all")
    )
    chosen = F.transform(
        F.sequence(F.lit(1), F.col("_parts") - 1),
        lambda i: F.element_at("_all", F.floor(i * PARTS / F.col("_parts")).cast("int")),
    )
    cuts = F.array_distinct(chosen).alias("_cuts")
    return _renamed(groups.select(*keys, SLICE, cuts), keys)


def _with_part(rows, at, most):
    """Add ``_part``: twice the cut points below the row's value, and one more if the value is
    itself a cut point, so that a value of many rows does not keep its neighbours in a large
    slice. Rows without cut points or without a value are in part 0.

    The cut points of a row, at most ``most``, are searched by halving steps. Each step is a
    projection of its own: unlike a function over the array they are compiled.
    """
    rows = rows.withColumn("_part", F.lit(0))
    for i in reversed(range((most or 0).bit_length())):
        further = F.col("_part") + (1 << i)
        below = F.get("_cuts", further - 1) < F.col(at)
        rows = rows.withColumn("_part", F.when(below, further).otherwise(F.col("_part")))
    hit = F.coalesce(F.get("_cuts", F.col("_part")) == F.col(at), F.lit(False))
    return rows.withColumn("_part", 2 * F.col("_part") + hit.cast("int"))


def _columns(order):
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _with_slice_table(sliced, table, keys):
    """Join the one-row-per-slice table; both sides are grouped by key and slice."""
    return sliced.join(_renamed(table, keys), _same(keys), "left")


def _result(frame, source, into, value):
    kept = [c for c in source.columns if c != into]
    if into in source.columns:
        return frame.withColumn(into, value).select(*source.columns)
    return frame.select(*kept, value.alias(into))


def forward_fill(
    df, keys, at, order, column, into=None, rows_per_slice=ROWS_PER_SLICE, ties=()
):
    """Last non-null value of ``column`` so far, per key in the given order."""
    keys, into, order = list(keys), into or column, _columns(order)
    sliced, was_cut = cut(df, keys, at, rows_per_slice, ties)
    here = F.last(column, ignorenulls=True).over(
        W.partitionBy(*keys, SLICE).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    )
    filled = sliced.withColumn("_here", here)
    if not was_cut:
        return _result(filled, df, into, F.col("_here"))
    last = F.max_by(F.col(column), F.when(F.col(column).isNotNull(), F.struct(*order)))
    before = W.partitionBy(*keys).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    carry = (
        sliced.groupBy(*keys, SLICE)
        .agg(last.alias("_end"))
        .select(*keys, SLICE, F.last("_end", ignorenulls=True).over(before).alias("_carry"))
    )
    joined = _with_slice_table(filled, carry, keys)
    return _result(joined, df, into, F.coalesce("_here", "_carry"))


def previous_time(df, keys, at, time, order, into, rows_per_slice=ROWS_PER_SLICE, ties=()):
    """The time of the row before, per key; ``order`` starts with ``time``."""
    keys, order = list(keys), _columns(order)
    sliced, was_cut = cut(df, keys, at, rows_per_slice, ties)
    here = F.lag(time).over(W.partitionBy(*keys, SLICE).orderBy(*order))
    lagged = sliced.withColumn("_here", here)
    if not was_cut:
        return _result(lagged, df, into, F.col("_here"))
    before = W.partitionBy(*keys).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    carry = (
        sliced.groupBy(*keys, SLICE)
        .agg(F.max(time).alias("_end"))
        .select(*keys, SLICE, F.max("_end").over(before).alias("_carry"))
    )
    joined = _with_slice_table(lagged, carry, keys)
    return _result(joined, df, into, F.coalesce("_here", "_carry"))


def positions(df, keys, at, order, into, rows_per_slice=ROWS_PER_SLICE, ties=()):
    """Zero-based position of each row within its key; without keys, within the table."""
    keys, order = list(keys), _columns(order)
    sliced, was_cut = cut(df, keys, at, rows_per_slice, ties)
    here = F.row_number().over(W.partitionBy(*keys, SLICE).orderBy(*order)).cast("bigint") - 1
    numbered = sliced.withColumn("_here", here)
    if not was_cut:
        return _result(numbered, df, into, F.col("_here"))
    before = W.partitionBy(*keys).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    carry = (
        sliced.groupBy(*keys, SLICE)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, SLICE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_carry"))
    )
    joined = _with_slice_table(numbered, carry, keys)
    return _result(joined, df, into, F.col("_here") + F.col("_carry"))


def exact_quantiles(df, groups, column, probabilities, rows_per_slice=ROWS_PER_SLICE):
    """Interpolated quantiles per group as the array column ``quantiles``.

    Equal values are counted before they move. Where a group is too large to rank
    in one task, its values are cut into slices; slice totals tell which slices
    hold the wanted ranks, and only those are ranked.
    """
    groups = list(groups)
    present = df.filter(F.col(column).isNotNull()).select(*groups, F.col(column).alias("_v"))
    sliced, was_cut = cut(present, groups, "_v", rows_per_slice)
    totals = sliced.groupBy(*groups, SLICE).agg(F.count(F.lit(1)).alias("_m"))
    every = W.partitionBy(*groups)
    until = every.orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    rank = [F.lit(p) * (F.col("_total") - 1) for p in probabilities]
    wanted = F.array_distinct(
        F.array(*[f(r).cast("bigint") for r in rank for f in (F.floor, F.ceil)])
    )
    holds = F.exists(
        wanted,
        lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_m")),
    )
    needed = (
        totals.select(
            *groups,
            SLICE,
            "_m",
            F.sum("_m").over(every).alias("_total"),
            F.coalesce(F.sum("_m").over(until), F.lit(0)).alias("_before"),
        )
        .filter(holds)
        .select(*groups, SLICE, "_total", "_before")
    )
    if was_cut:
        # only the values of these slices move
        ranges = _renamed(written(needed, "ranges"), groups)
        held = sliced.join(ranges, _same(groups))
        counted = held.groupBy(*groups, SLICE, "_v", "_before", "_total")
        ranked = counted.agg(F.count(F.lit(1)).alias("_n"))
    else:
        counted = sliced.groupBy(*groups, SLICE, "_v").agg(F.count(F.lit(1)).alias("_n"))
        ranked = counted.withColumn("_before", F.lit(0).cast("bigint")).withColumn(
            "_total", F.sum("_n").over(W.partitionBy(*groups, SLICE))
        )
    so_far = W.partitionBy(*groups, SLICE).orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    ranked = ranked.withColumn("_end", F.col("_before") + F.sum("_n").over(so_far)).withColumn(
        "_start", F.col("_end") - F.col("_n")
    )

    def value_at(position):
        inside = (position >= F.col("_start")) & (position < F.col("_end"))
        return F.max(F.when(inside, F.col("_v")))

    picks = [F.max("_total").alias("_total")]
    for i, r in enumerate(rank):
        picks += [value_at(F.floor(r)).alias(f"_f{i}"), value_at(F.ceil(r)).alias(f"_c{i}")]
    picked = ranked.groupBy(*groups).agg(*picks)
    quantiles = [
        F.col(f"_f{i}") + (F.col(f"_c{i}") - F.col(f"_f{i}")) * (r - F.floor(r))
        for i, r in enumerate(rank)
    ]
    return picked.select(*groups, F.array(*quantiles).alias("quantiles"))
