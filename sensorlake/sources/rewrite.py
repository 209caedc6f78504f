"""Many small Parquet files rewritten as few, folder by folder, inside tasks.

A folder is cut into bins of bounded size; a task reads the files of a bin and writes one
file with the union of their columns. Names stay in tables; only counts reach the driver.
"""

import uuid

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import functions as F

from sensorlake.session import written
from sensorlake.sources.paths import arrow_uri

#: Bytes and files of a bin, about.
BIN_BYTES, BIN_FILES = 128 << 20, 10_000
_ROWS = 1 << 16

REWRITTEN = (
    "folder string, bin int, n_files long, n_read long, n_rows long, disagree boolean, "
    "path string, bytes long, originals array<string>"
)


def bins(files, plan):
    """(folder, bin, paths) of the folders of a plan with their number of files and bytes."""
    n = F.greatest(F.ceil(F.col("bytes") / BIN_BYTES), F.ceil(F.col("n_files") / BIN_FILES))
    plan = plan.select("folder", F.greatest(n, F.lit(1)).alias("n_bins"))
    dealt = files.select("folder", "path").join(plan, "folder")
    place = F.pmod(F.xxhash64("path"), F.col("n_bins")).cast("int")
    found = dealt.groupBy("folder", place.alias("bin")).agg(F.collect_list("path").alias("paths"))
    found = written(found, "bins")
    # a handful of names is little data but much work, so the number of tasks is named
    tasks = min(found.count(), 4 * found.sparkSession.sparkContext.defaultParallelism)
    return found.repartition(max(1, tasks))


def _opened(path):
    system, name = fs.FileSystem.from_uri(arrow_uri(path))
    return pq.ParquetFile(system.open_input_file(name))


def _plain(schema):
    """Names and types alone, with times in microseconds as Spark writes them."""

    def kind(t):
        return pa.timestamp("us", t.tz) if pa.types.is_timestamp(t) else t

    return pa.schema([pa.field(f.name, kind(f.type)) for f in schema])


def _readable(paths):
    found = []
    for path in paths:
        try:
            found.append(_opened(path))
        except (pa.ArrowException, OSError):
            pass
    return found


def _written(files, schema, out):
    """(files read to the end, rows) of files written as one."""
    n_read = n_rows = 0
    with pq.ParquetWriter(out, schema, compression="snappy", store_schema=False) as writer:
        for file in files:
            try:
                for batch in file.iter_batches(_ROWS):
                    columns = [
                        batch[f.name].cast(f.type) if f.name in batch.schema.names
                        else pa.nulls(len(batch), f.type)
                        for f in schema
                    ]
                    writer.write_table(pa.table(columns, schema=schema))
                    n_rows += len(batch)
                n_read += 1
            except (pa.ArrowException, OSError):
                pass
    return n_read, n_rows


def _merged(paths, folder, bin, target, absent):
    files = _readable(paths)
    report = dict(
        folder=folder, bin=bin, n_files=len(paths), n_read=0, n_rows=0, disagree=False,
        path=None, bytes=0, originals=paths,
    )
    if not files:
        return report
    try:
        schema = pa.unify_schemas([_plain(f.schema_arrow) for f in files])
    except (pa.ArrowInvalid, pa.ArrowTypeError):
        return report | {"disagree": True}
    for field in absent:
        if field.name not in schema.names:
            schema = schema.append(field)
    system, root = fs.FileSystem.from_uri(arrow_uri(f"{target}/{folder}"))
    system.create_dir(root, recursive=True)
    name = f"part-{bin:05d}-{uuid.uuid4().hex}.snappy.parquet"
    with system.open_output_stream(f"{root}/{name}") as out:
        n_read, n_rows = _written(files, schema, out)
        size = out.tell()
    return report | {
        "n_read": n_read, "n_rows": n_rows, "path": f"{target}/{folder}/{name}", "bytes": size
    }


def merge(found, target, absent=()):
    """Files of the bins ``found`` as new files below ``target``; a row per bin.

    Columns of the Arrow fields ``absent`` are added where all files of a bin lack them. A
    bin whose files disagree about a type is not written; one with a file that cannot be
    read says so by fewer files read. A repeated task leaves a file that no row names.
    """

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                one = _merged(row["paths"], row["folder"], row["bin"], target, absent)
                yield pa.RecordBatch.from_pylist([one], _REPORT)

    return found.mapInArrow(run, REWRITTEN)


_REPORT = pa.schema(
    [
        ("folder", pa.string()), ("bin", pa.int32()), ("n_files", pa.int64()),
        ("n_read", pa.int64()), ("n_rows", pa.int64()), ("disagree", pa.bool_()),
        ("path", pa.string()), ("bytes", pa.int64()), ("originals", pa.list_(pa.string())),
    ]
)


def counted(found):
    """Rows per folder of the bins ``found``, from the files' footers."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                rows = sum(f.metadata.num_rows for f in _readable(row["paths"]))
                yield pa.RecordBatch.from_pydict({"folder": [row["folder"]], "n_rows": [rows]})

    counts = found.mapInArrow(run, "folder string, n_rows long")
    return counts.groupBy("folder").agg(F.sum("n_rows").alias("n_rows"))


def report(plan, parts):
    """(folder, n_files, n_rows, status): ``ok`` if all files of the folder were read,
    ``partial`` if some were not, ``error`` if none was or if they disagree about a type."""
    read = parts.groupBy("folder").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_read").alias("n_read"),
        F.bool_or("disagree").alias("disagree"),
    )
    unread = F.col("n_read").isNull() | (F.col("n_read") == 0)
    return plan.join(read, "folder", "left").select(
        "folder",
        "n_files",
        F.when(F.col("disagree") | unread, 0).otherwise(F.col("n_rows")).alias("n_rows"),
        F.when(F.col("disagree") | unread, "error")
        .when(F.col("n_read") < F.col("n_files"), "partial")
        .otherwise("ok")
        .alias("status"),
    )


def swap(parts, root):
    """Puts the new files of some bins into their folders below ``root`` and deletes the
    originals of each bin right after. A repeated task finds its work done."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                system, old = fs.FileSystem.from_uri(arrow_uri(row["path"]))
                new = fs.FileSystem.from_uri(arrow_uri(f"{root}/{row['folder']}"))[1]
                new = f"{new}/{old.rsplit('/', 1)[1]}"
                if system.get_file_info(old).type == fs.FileType.File:
                    system.move(old, new)
                for path in row["originals"]:
                    try:
                        system.delete_file(fs.FileSystem.from_uri(arrow_uri(path))[1])
                    except FileNotFoundError:
                        pass
            yield batch.select(["path"])

    tasks = 4 * parts.sparkSession.sparkContext.defaultParallelism
    moved = parts.repartition(tasks).mapInArrow(run, "path string")
    moved.write.format("noop").mode("overwrite").save()
