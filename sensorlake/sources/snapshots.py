"""A Parquet table whose readers see one snapshot: a list of live files.

Every load writes its files into a folder of its own, ``load=<id>/`` above the partition
folders, where no reader looks yet. A commit then adds their names to the list, and one
rename makes it the newest version; compaction adds the new files and takes out the old ones
in the same commit. So a reader sees the rows of a version once, at any moment and after a
crash at any step: what was not committed is not there, and old versions stay readable
until ``expire``.

``_snapshots/`` holds a small JSON file per version, and lists of changes as Parquet
tables. A version names its lists: a base with the live files of an earlier version and at
most ``FOLD`` lists of later changes. Two writers that commit at once: the second one finds
the version taken, and commits after it; if files that it takes out are gone by then, its
commit fails and changes nothing.

Names reach the driver only of the files that a question reads, as Spark's own file index
has them. Rows without a value for a partition column are in the folder of null, as Spark
writes it.
"""

import json
import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

from sensorlake.functions import times
from sensorlake.operators.dedup import first_per_key
from sensorlake.operators.joins import unseen
from sensorlake.schemas import MOTE_ARCHIVE
from sensorlake.session import written
from sensorlake.sources import rewrite
from sensorlake.sources.archive import (
    MOTE_PARTITIONS, _arrow_fields, _balanced, compaction_plan, delete_files, file_key,
)

#: Lists of changes that a version may name before they are folded into one base.
FOLD = 16
CHANGES = "op string, path string, bytes long, folder string"


class Conflict(RuntimeError):
    """Files to be taken out are no longer in the table."""


class _Log:
    """The versions: files of a folder that appear whole and are never replaced."""

    def __init__(self, spark, folder):
        self.jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.folder = self._path(folder)
        self.system = self.folder.getFileSystem(conf)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self.system.getUri(), conf
        )
        self.system.mkdirs(self.folder)

    def _path(self, *parts):
        return self.jvm.org.apache.hadoop.fs.Path(*parts)

    def versions(self):
        found = self.system.listStatus(self.folder)
        names = [f.getPath().getName() for f in found]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, version):
        stream = self.system.open(self._path(self.folder, f"{version:012d}.json"))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def add(self, version, value):
        """Whether the version was free; then it has this value, all of it."""
        target = self._path(self.folder, f"{version:012d}.json")
        aside = self._path(self.folder, f".{uuid.uuid4().hex}")
        out = self.system.create(aside)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()
        rename = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            self.context.rename(aside, target, self._none(rename))
        except Exception:  # the target exists, as it turns out, or the error is another one
            self.system.delete(aside, False)
            if not self.system.exists(target):
                raise
            return False
        return True

    def _none(self, rename):
        none = rename.valueOf("NONE")
        array = self.jvm.java.lang.reflect.Array.newInstance(none.getClass(), 1)
        self.jvm.java.lang.reflect.Array.set(array, 0, none)
        return array

    def forget(self, version):
        self.system.delete(self._path(self.folder, f"{version:012d}.json"), False)


class SnapshotTable:
    """Rows of ``schema`` in folders of ``partitions``, by default the archive by day and mote."""

    def __init__(self, spark, path, schema=MOTE_ARCHIVE, partitions=MOTE_PARTITIONS):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema, self.partitions = schema, partitions
        self.log = _Log(spark, f"{self.path}/_snapshots")

    # Versions

    def versions(self):
        return self.log.versions()

    def snapshot(self, version=None):
        """What a version names; the newest one, or an empty one before the first commit."""
        if version is None:
            known = self.versions()
            if not known:
                return {"version": 0, "base": None, "lists": [], "sources": {}}
            version = known[-1]
        return self.log.read(version)

    def _list(self, name):
        return f"{self.path}/_snapshots/lists/{name}"

    def files(self, version=None):
        """path (below the table), bytes and folder of the live files of a version."""
        at = version if isinstance(version, dict) else self.snapshot(version)
        names = [n for n in (at["base"], *at["lists"]) if n]
        if not names:
            return self.spark.createDataFrame([], "path string, bytes long, folder string")
        changes = self.spark.read.schema(CHANGES).parquet(*map(self._list, names))
        live = changes.groupBy("path").agg(
            F.max("bytes").alias("bytes"), F.max("folder").alias("folder"),
            F.bool_or(F.col("op") == "remove").alias("gone"),
        )
        return live.where("not gone").drop("gone")

    def commit(self, changes, source=None, batch=None):
        """Adds and removes files; returns the new version."""
        name = uuid.uuid4().hex
        changes.select(*[c.split()[0] for c in CHANGES.split(", ")]).write.parquet(self._list(name))
        gone = self.spark.read.schema(CHANGES).parquet(self._list(name)).where("op = 'remove'")
        removes, checked = not gone.isEmpty(), None
        while True:
            now = self.snapshot()
            if removes and checked != now["version"]:
                if not gone.join(self.files(now), "path", "left_anti").isEmpty():
                    raise Conflict("another commit took out some of these files")
                checked = now["version"]
            lists, base = [*now["lists"], name], now["base"]
            sources = dict(now["sources"])
            if source is not None:
                sources[source] = max(batch, sources.get(source, -1))
            new = {"version": now["version"] + 1, "base": base, "lists": lists, "sources": sources}
            if len(lists) > FOLD:
                folded = uuid.uuid4().hex
                live = self.files(new).select(F.lit("add").alias("op"), "path", "bytes", "folder")
                live.repartition(1 + len(lists) // 8).write.parquet(self._list(folded))
                new |= {"base": folded, "lists": []}
            if self.log.add(new["version"], new):
                return new["version"]

    # Rows

    def _found(self, load):
        """The files of a load, as changes."""
        files = (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .load(f"{self.path}/load={load}")
        )
        path = F.regexp_extract("path", r"(load=[^/]+/.*)$", 1)
        return files.select(
            F.lit("add").alias("op"), path.alias("path"), F.col("length").alias("bytes"),
            F.regexp_extract(path, r"^load=[^/]+/(.*)/[^/]+$", 1).alias("folder"),
        )

    def append(self, rows, source=None, batch=None):
        """Adds rows, which have the partition columns. A batch of a source counts once,
        however often it is repeated."""
        now = self.snapshot()
        if source is not None and now["sources"].get(source, -1) >= batch:
            return now["version"]
        return self.commit(self._load(rows), source, batch)

    def _load(self, rows):
        """Writes rows into a folder of their own, where no reader looks yet."""
        load = uuid.uuid4().hex
        _balanced(rows, self.partitions).write.option("compression", "snappy").partitionBy(
            *self.partitions
        ).parquet(f"{self.path}/load={load}")
        return self._found(load)

    def replace(self, files, rows):
        """``rows`` in place of what some live files hold, in one commit. ``files`` is a
        written table of theirs. Conflict if another commit took one of them out."""
        none = F.lit(None).cast("long").alias("bytes")
        gone = files.select(F.lit("remove").alias("op"), "path", none, "folder")
        return self.commit(self._load(rows).union(gone))

    def read(self, version=None, files=None):
        """The rows of a version, or of some of its files."""
        files = self.files(version) if files is None else files
        names = [f"{self.path}/{r['path']}" for r in files.select("path").collect()]
        if not names:
            return self.spark.createDataFrame([], self.schema)
        schema = StructType([*self.schema, StructField("load", StringType())])
        reader = self.spark.read.schema(schema).option("basePath", self.path)
        return reader.parquet(*names).drop("load")

    def of_days(self, days, version=None):
        """The live files of the days in a column ``day`` (yyyy-MM-dd) of a table."""
        part = [F.regexp_extract("folder", rf"{p}=(\d+)", 1) for p in ("year", "month", "day")]
        files = self.files(version).withColumn("day", F.concat_ws("-", *part))
        return files.join(days.select("day").distinct(), "day", "left_semi")

    def append_new(self, rows, source=None, batch=None):
        """Adds archive rows whose mote and time the table lacks; of equal keys the first by
        ``arrival``. Reads the keys of the days of these rows only."""
        keys = ["mote_id", "updated_timestamp"]
        first = first_per_key(rows, keys, ["arrival"]).drop("arrival")
        first = first.where("mote_id is not null and updated_timestamp is not null")
        first = first.withColumns(times.partition_values(F.col("updated_timestamp")))
        day = F.date_format("updated_timestamp", "yyyy-MM-dd").alias("day")
        known = self.read(files=self.of_days(first.select(day))).select(*keys)
        return self.append(unseen(first, known), source, batch)

    # Care

    def rewrite(self, min_files=2, where=None):
        """New files for folders of many small ones, beside the table's: what ``commit``
        takes to make them live, and a report per folder."""
        files = self.files()
        files = written(files if where is None else files.where(where), "files")
        plan = written(compaction_plan(files, min_files), "compaction-plan")
        whole = files.select("folder", F.concat(F.lit(f"{self.path}/"), "path").alias("path"))
        load = f"{self.path}/load={uuid.uuid4().hex}"
        absent = _arrow_fields() if self.schema is MOTE_ARCHIVE else ()
        parts = written(rewrite.merge(rewrite.bins(whole, plan), load, absent), "compaction")
        report = written(rewrite.report(plan, parts), "compaction-report")
        done = parts.join(report.filter("status = 'ok'").select("folder"), "folder", "left_semi")
        path = F.regexp_extract("path", r"(load=[^/]+/.*)$", 1)
        none = F.lit(None).cast("long")
        old = done.select("folder", F.explode("originals").alias("path"))
        changes = done.select(F.lit("add").alias("op"), path.alias("path"), "bytes", "folder").union(
            old.select(F.lit("remove").alias("op"), path.alias("path"), none.alias("bytes"), "folder")
        )
        return changes, report

    def compact(self, min_files=2, where=None):
        """Rewrites folders of many small files; readers see the old files until the new
        ones take their place in one commit. Returns the report."""
        changes, report = self.rewrite(min_files, where)
        if not changes.isEmpty():
            self.commit(changes)
        return report

    def expire(self, keep=10, before=None):
        """Forgets all but the newest versions, and deletes files that no kept one names.

        ``before`` (a time) spares files written after it, which a load or a compaction
        may be about to commit."""
        known = self.versions()
        for version in known[:-keep]:
            self.log.forget(version)
        live = None
        for version in known[-keep:]:
            some = self.files(version).select("path")
            live = some if live is None else live.union(some)
        if live is None:
            return
        found = (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "part-*.parquet")
            .load(f"{self.path}/load=*")
        )
        if before is not None:
            found = found.where(F.col("modificationTime") < F.lit(before))
        relative = F.regexp_extract(file_key(F.col("path")), r"(load=[^/]+/.*)$", 1)
        found = found.select("path", relative.alias("name"))
        dead = found.join(live.withColumnRenamed("path", "name").distinct(), "name", "left_anti")
        delete_files(written(dead.select("path"), "dead-files"))
