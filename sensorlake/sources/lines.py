"""Text files as a stream that goes on inside a file.

The place of a stream is (file, byte), always at the end of a line, so a batch has a
number of lines or bytes however long a file is, and a restart from the checkpoint goes on
with the next line. A batch is read in ranges of bytes by many tasks; a line belongs to
the range in which it begins.

Files count from the moment they are first listed, with the size they have then, in order
of modification time and path. The list stands in numbered files in the folder ``state``,
which belongs to one checkpoint. It grows by what is new, so a file that turns up later,
whatever its time or name, comes after those known before.

A line ends with a line feed, or with the end of its file; a carriage return before it is
left out. Bytes that are no UTF-8 become the replacement character. An empty file has no
lines; a folder without files is an empty stream. Files are not compressed.
"""

import json
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from sensorlake.sources.paths import arrow_uri

FORMAT = "text_lines"
SCHEMA = "line string, file long, byte long"
LINES_PER_BATCH = 5_000
#: A range that one task reads, and what is read at once.
RANGE_BYTES, CHUNK_BYTES = 32 << 20, 4 << 20


def _opened(uri):
    return fs.FileSystem.from_uri(arrow_uri(str(uri)))


class Range(InputPartition):
    """Lines that begin in the bytes ``begin`` to ``end`` of a file."""

    def __init__(self, file, path, begin, end, size):
        self.file, self.path, self.begin, self.end, self.size = file, path, begin, end, size


class FileList:
    """Files in the order they were found, as (path, size); kept in the folder ``state``."""

    def __init__(self, path, state):
        self.path, self.files = path, []
        self.system, self.folder = _opened(state)
        for kind in ("files", "offers"):
            self.system.create_dir(f"{self.folder}/{kind}", recursive=True)
        for name in self._names("files"):
            self.files += [tuple(f) for f in json.loads(self._text(f"files/{name}"))]

    def _names(self, kind):
        found = self.system.get_file_info(fs.FileSelector(f"{self.folder}/{kind}"))
        return sorted(f.base_name for f in found if f.base_name.endswith(".json"))

    def _text(self, name):
        with self.system.open_input_stream(f"{self.folder}/{name}") as stream:
            return stream.read().decode()

    def _write(self, name, value):
        """A whole file or none: it is written aside and then moved."""
        aside = f"{self.folder}/{name}.{uuid.uuid4().hex}"
        with self.system.open_output_stream(aside) as out:
            out.write(json.dumps(value).encode())
        self.system.move(aside, f"{self.folder}/{name}")

    def look(self):
        """Adds files that are new; those with hidden names are left out."""
        system, top = _opened(self.path)
        info = system.get_file_info(top)
        if info.type == fs.FileType.File:
            found = [info]
        elif info.type == fs.FileType.NotFound:
            found = []
        else:
            found = system.get_file_info(fs.FileSelector(top, recursive=True))
        known = {path for path, _ in self.files}
        new = [
            f for f in found
            if f.type == fs.FileType.File and f.path not in known
            and not any(p[:1] in "_." for p in f.path[len(top) :].split("/") if p)
        ]
        if new:
            new = [(f.path, f.size) for f in sorted(new, key=lambda f: (f.mtime_ns, f.path))]
            self._write(f"files/{len(self.files):012d}.json", new)
            self.files += new

    def offered(self):
        """The furthest place that was ever offered, or the start."""
        names = self._names("offers")
        return json.loads(self._text(f"offers/{names[-1]}")) if names else {"file": 0, "byte": 0}

    def offer(self, place):
        before = self._names("offers")
        self._write(f"offers/{place['file']:012d}-{place['byte']:020d}.json", place)
        for name in before:
            self.system.delete_file(f"{self.folder}/offers/{name}")

    def stream_of(self, path):
        return _opened(self.path)[0].open_input_file(path)


def _line_end(stream, at, size):
    """The place after the first line end at or after a byte."""
    stream.seek(at)
    while at < size:
        some = stream.read(min(1 << 16, size - at))
        if not some:
            break
        found = some.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(some)
    return size


def _lines_end(stream, at, size, lines):
    """(place, lines) after so many lines, or at the end of the file."""
    seen, cut_off = 0, False
    stream.seek(at)
    while at < size:
        some = stream.read(min(CHUNK_BYTES, size - at))
        if not some:
            break
        ends = np.flatnonzero(np.frombuffer(some, np.uint8) == 10)
        if seen + len(ends) >= lines:
            return at + int(ends[lines - seen - 1]) + 1, lines
        seen += len(ends)
        at += len(some)
        cut_off = not some.endswith(b"\n")
    return size, seen + cut_off


def lines_of(stream, begin, end, size):
    """(byte of the first letter, text) lists of the lines that begin in a range, in parts."""
    at = begin if not begin else _line_end(stream, begin - 1, size)
    stream.seek(at)
    rest = b""  # the part of a line that is not over yet; it begins at ``at``
    while at < end:
        some = stream.read(min(CHUNK_BYTES, size - at - len(rest)))
        data = rest + some
        if not data:
            return
        over = not some or at + len(data) >= size
        ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
        starts = np.concatenate([[0], ends + 1])
        if over and starts[-1] < len(data):
            ends = np.append(ends, len(data))
        starts = starts[: len(ends)]
        keep = at + starts < end
        starts, ends = starts[keep], ends[keep]
        if len(starts):
            text = [
                data[a:b].removesuffix(b"\r").decode(errors="replace")
                for a, b in zip(starts.tolist(), ends.tolist())
            ]
            yield at + starts, text
        if over or not keep.all():
            return
        used = int(ends[-1]) + 1 if len(ends) else 0
        rest, at = data[used:], at + used


class LineReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path, self.state = options["path"], options["state"]
        self.lines = int(options.get("linesPerBatch", LINES_PER_BATCH))
        self.bytes = int(options.get("bytesPerBatch", 0))
        self.range = int(options.get("rangeBytes", RANGE_BYTES))
        self._list = None

    def _files(self):
        if self._list is None:
            self._list = FileList(self.path, self.state)
        return self._list

    def initialOffset(self):
        return {"file": 0, "byte": 0}

    def latestOffset(self):
        """The end of the next batch. It is noted before Spark notes it, so after a crash
        between the two the next batch is a longer one and no line is left out."""
        files = self._files()
        files.look()
        place = files.offered()
        ahead = self._ahead(files, **place)
        if ahead != place:
            files.offer(ahead)
        return ahead

    def _ahead(self, files, file, byte):
        left = self.bytes or self.lines
        while left > 0 and file < len(files.files):
            path, size = files.files[file]
            if byte < size:
                with files.stream_of(path) as stream:
                    if self.bytes:
                        to = size if size - byte <= left else _line_end(stream, byte + left - 1, size)
                        left -= to - byte
                    else:
                        to, seen = _lines_end(stream, byte, size, left)
                        left -= seen
                byte = to
            if byte >= size:
                file, byte = file + 1, 0
        return {"file": file, "byte": byte}

    def partitions(self, start, end):
        files = self._files().files
        parts = []
        for file in range(start["file"], min(end["file"] + 1, len(files))):
            path, size = files[file]
            at = start["byte"] if file == start["file"] else 0
            to = end["byte"] if file == end["file"] else size
            for begin in range(at, to, self.range):
                parts.append(Range(file, path, begin, min(begin + self.range, to), size))
        return parts

    def read(self, partition):
        p = partition
        with _opened(self.path)[0].open_input_file(p.path) as stream:
            for places, text in lines_of(stream, p.begin, p.end, p.size):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(text, pa.string()),
                        pa.array(np.full(len(text), p.file, np.int64)),
                        pa.array(places.astype(np.int64)),
                    ],
                    ["line", "file", "byte"],
                )


class LineSource(DataSource):
    """Options: ``path`` (a file or folder), ``state`` (a folder of this stream alone), and
    ``linesPerBatch`` or ``bytesPerBatch``."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMA

    def streamReader(self, schema):
        return LineReader(self.options)


def read_line_stream(spark, path, state, lines_per_batch=LINES_PER_BATCH, bytes_per_batch=None):
    """Lines with ``arrival``, the file's number and the byte at which the line begins.

    ``lines_per_batch`` makes the driver look for that line end in the bytes of each batch;
    ``bytes_per_batch`` only makes it look for the next line end, which is for large loads.
    """
    spark.dataSource.register(LineSource)
    limit = (
        {"bytesPerBatch": str(bytes_per_batch)}
        if bytes_per_batch
        else {"linesPerBatch": str(lines_per_batch)}
    )
    stream = spark.readStream.format(FORMAT).options(path=path, state=state, **limit).load()
    return stream.selectExpr("line", "struct(file, byte) as arrival")
