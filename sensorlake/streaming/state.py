"""Stateful streams per key: the first row of each mote and time, and order per mote.

State lives in RocksDB on the executors and, as changes per batch, in the checkpoint. A
batch reads and writes the state of its own keys only, so it costs the same however much
was seen before, and a restart finds what was seen. It is kept until it is cleared with the
checkpoint, so rows of any age are compared.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType, TimestampType

from sensorlake.streaming import messages

#: Microseconds of a mote's times that share a state value: its size is what one mote sends
#: in that time, and a mote with much of all rows is many keys.
SPAN = 6 * 3_600_000_000

_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def started(spark, start):
    """Starts a query with its state in RocksDB; other queries keep their store."""
    before = {k: spark.conf.get(k, None) for k in _STORE}
    try:
        for name, value in _STORE.items():
            spark.conf.set(name, value)
        return start()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _order(rows):
    """What orders rows as they came, as plain columns: the offset or place of a message.
    The stateful operators rename columns that begin with an underscore."""
    name = next((c for c in ("arrival", "place") if c in rows.columns), None)
    if name is None:
        return {}
    kind = rows.schema[name].dataType
    if not isinstance(kind, StructType):
        return {"order0": F.col(name)}
    columns = {}
    for i, field in enumerate(kind):
        value = F.col(f"{name}.{field.name}")
        moment = isinstance(field.dataType, TimestampType)
        columns[f"order{i}"] = F.unix_micros(value) if moment else value
    return columns


def _numbered(rows, order, once_per=()):
    """Rows with ``number``, their number in their task, which orders the rows of one place.
    Repeats of ``once_per`` inside a batch of Arrow rows are dropped before they travel."""
    by = [(c, "ascending") for c in (*order, "number")]

    def run(batches):
        n = 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table.append_column("number", pa.array(np.arange(n, n + len(table))))
            n += len(table)
            if once_per and len(table):
                sorted_rows = table.sort_by(by).append_column("at", pa.array(np.arange(len(table))))
                groups = sorted_rows.group_by([*once_per], use_threads=False)
                first = groups.aggregate([("at", "min")])["at_min"]
                table = sorted_rows.drop_columns(["at"]).take(first)
            yield from table.combine_chunks().to_batches()

    return rows.mapInArrow(run, StructType([*rows.schema]).add("number", "long"))


def _first_of_each(frame, order):
    frame = frame.sort_values(order, kind="stable")
    return frame.drop_duplicates("time")


class FirstSeen(StatefulProcessor):
    """Lets the first row of each time through; the state has the times seen, as packed
    64-bit numbers."""

    def __init__(self, order):
        self.order = order

    def init(self, handle):
        self.seen = handle.getValueState("seen", "times binary")

    def handleInputRows(self, key, rows, timers):
        # a repeat within a batch goes as soon as it is met
        first = None
        for frame in rows:
            first = frame if first is None else pd.concat([first, frame])
            first = _first_of_each(first, self.order)
        known = self.seen.get()
        known = np.frombuffer(known[0], "<i8") if known else np.zeros(0, np.int64)
        times = first["time"].to_numpy(np.int64)
        new = ~np.isin(times, known)
        if new.any():
            both = np.sort(np.concatenate([known, times[new]]))
            self.seen.update((both.astype("<i8").tobytes(),))
        yield first.loc[new, ["mote_id", "time", "row"]]

    def close(self):
        pass


def first_seen(parsed):
    """The accepted rows of a stream of parsed messages of which neither the stream so far
    nor the batch had the mote and event time earlier. Columns as of ``accepted``, without
    the order of arrival."""
    rows = parsed.filter(F.col("reject").isNull())
    kept = messages.accepted(parsed).drop("arrival").schema
    inner = StructType([f for f in kept if f.name not in ("mote_id", "event_time")])
    order = _order(rows)
    packed = rows.select(
        "mote_id",
        F.unix_micros(F.col("event_time").cast("timestamp")).alias("time"),
        F.to_json(F.struct(*inner.names)).alias("row"),
        *[c.alias(n) for n, c in order.items()],
    )
    packed = _numbered(packed, order, once_per=("mote_id", "time"))
    span = F.expr(f"time div {SPAN}").alias("span")
    first = packed.select("*", span).groupBy("mote_id", "span").transformWithStateInPandas(
        FirstSeen([*order, "number"]), "mote_id int, time long, row string", "Append", "None"
    )
    opened = F.from_json("row", inner).alias("r")
    event_time = F.timestamp_micros("time").cast("timestamp_ntz").alias("event_time")
    return first.select("mote_id", event_time, opened).select(
        *[F.col(c) if c in ("mote_id", "event_time") else F.col(f"r.{c}") for c in kept.names]
    )


class InOrder(StatefulProcessor):
    """Counts a mote's messages and those with a smaller epoch than the one before."""

    def __init__(self, order):
        self.order = order

    def init(self, handle):
        self.last = handle.getValueState("last", "epoch long")

    def handleInputRows(self, key, rows, timers):
        frame = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        last = self.last.get()
        epochs = frame["epoch"].to_numpy(np.int64)
        before = np.concatenate([[last[0] if last else epochs[0]], epochs[:-1]])
        self.last.update((int(epochs[-1]),))
        yield pd.DataFrame(
            {
                "key": [key[0]],
                "n_messages": [len(epochs)],
                "n_out_of_order": [int((epochs < before).sum())],
            }
        )

    def close(self):
        pass


def order_counts(parsed):
    """key (the mote), n_messages and n_out_of_order of each batch of a stream, compared with
    the batches before; malformed messages and those without an epoch do not count."""
    whole = F.col("reject").isNull() | (F.col("reject") != "malformed")
    rows = parsed.where(whole & F.col("epoch").isNotNull())
    order = _order(rows)
    # a null key would not be one group
    key = F.coalesce(F.col("mote_id").cast("string"), F.lit("")).alias("key")
    rows = rows.select(key, "epoch", *[c.alias(n) for n, c in order.items()])
    rows = _numbered(rows, order)
    counts = rows.groupBy("key").transformWithStateInPandas(
        InOrder([*order, "number"]), "key string, n_messages long, n_out_of_order long",
        "Append", "None",
    )
    return counts.withColumn("key", F.nullif("key", F.lit("")))
