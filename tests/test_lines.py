"""The line stream: places inside files, against plain reading."""

import io
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sensorlake.sources import lines
from sensorlake.streaming import jobs


def texts(seed):
    rng = random.Random(seed)
    parts = [
        "".join(rng.choice("abé 漢\r") for _ in range(rng.choice((0, 1, 5, 40))))
        for _ in range(rng.randint(0, 30))
    ]
    return "\n".join(parts).encode() + rng.choice((b"", b"\n", b"\xff\n"))


def plain(data):
    """(byte, line) of all lines."""
    out, at = [], 0
    for part in data.split(b"\n"):
        out.append((at, part.removesuffix(b"\r").decode(errors="replace")))
        at += len(part) + 1
    return out if out[-1][0] < len(data) else out[:-1]


@pytest.mark.parametrize("seed", range(25))
def test_ranges_cover_each_line_once(seed, monkeypatch):
    data, rng = texts(seed), random.Random(seed)
    monkeypatch.setattr(lines, "CHUNK_BYTES", rng.choice((1, 3, 16, 1000)))
    cuts = sorted({0, len(data), *(rng.randint(0, len(data)) for _ in range(5))})
    found = []
    for begin, end in zip(cuts, cuts[1:]):
        for places, text in lines.lines_of(io.BytesIO(data), begin, end, len(data)):
            found += zip(places.tolist(), text)
    assert found == plain(data)


@pytest.mark.parametrize("seed", range(25))
def test_batches_end_at_line_ends(seed, monkeypatch):
    data = texts(seed)
    monkeypatch.setattr(lines, "CHUNK_BYTES", 7)
    starts = [at for at, _ in plain(data)] + [len(data)]
    at = seen = 0
    while at < len(data):
        at, n = lines._lines_end(io.BytesIO(data), at, len(data), 3)
        seen += n
        assert at == starts[min(seen, len(starts) - 1)]
        assert n == 3 or at == len(data)
    assert seen == len(plain(data))
    for byte in range(len(data)):
        assert lines._line_end(io.BytesIO(data), byte, len(data)) in starts


def load(spark, path, out, checkpoint, stop_at=None, **limit):
    state = f"{checkpoint}/lines"

    def write(rows, batch, source):
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch}")
        if batch == stop_at:
            raise InterruptedError("stop here")

    stream = lines.read_line_stream(spark, str(path), state, **limit)
    query = jobs.each_batch(stream, write, str(checkpoint), {"processingTime": "0 seconds"})
    jobs.run_until_caught_up(query)


def test_resumes_at_the_line(spark, tmp_path):
    """One file of 100,000 lines in batches of 5,000; a stop in the middle."""
    path, out, checkpoint = tmp_path / "in", tmp_path / "out", tmp_path / "checkpoint"
    path.mkdir()
    (path / "a.txt").write_text("".join(f"line {i}\n" for i in range(100_000)))
    with pytest.raises(StreamingQueryException, match="stop here"):
        load(spark, path, out, checkpoint, stop_at=9)
    load(spark, path, out, checkpoint)
    rows = spark.read.parquet(str(out))
    sizes = {r["batch"]: r["count"] for r in rows.groupBy("batch").count().collect()}
    assert sizes == dict.fromkeys(range(20), 5000)
    number = F.split("line", " ")[1].cast("int")
    assert rows.select(number.alias("i")).distinct().count() == 100_000
    late = rows.withColumn("i", number).filter(F.floor(F.col("i") / 5000) != F.col("batch"))
    assert late.isEmpty()
    ordered = rows.orderBy("arrival").select(number.alias("i")).collect()
    assert [r["i"] for r in ordered] == list(range(100_000))


def test_files_that_come_later(spark, tmp_path):
    path, out, checkpoint = tmp_path / "in", tmp_path / "out", tmp_path / "checkpoint"
    (path / "deep").mkdir(parents=True)
    load(spark, path, out, checkpoint)  # nothing yet
    (path / "m.txt").write_text("1\n2\n3")
    (path / "_hidden.txt").write_text("no\n")
    (path / "empty.txt").write_text("")
    load(spark, path, out, checkpoint, bytes_per_batch=3)
    (path / "deep" / "a.txt").write_text("4\r\n5\n")  # a name before the first
    load(spark, path, out, checkpoint, bytes_per_batch=100)
    load(spark, path, out, checkpoint)  # nothing new
    rows = spark.read.parquet(str(out)).orderBy("arrival").collect()
    assert [r["line"] for r in rows] == ["1", "2", "3", "4", "5"]
    first = rows[0]["batch"]  # a stream may begin with a batch of nothing
    assert [r["batch"] - first for r in rows] == [0, 0, 1, 2, 2]


def test_a_note_without_a_batch_loses_nothing(spark, tmp_path):
    """The end of a batch was noted, and the driver died before Spark noted it."""
    path, out, checkpoint = tmp_path / "a.txt", tmp_path / "out", tmp_path / "checkpoint"
    path.write_text("".join(f"{i}\n" for i in range(10)))
    files = lines.FileList(str(path), f"{checkpoint}/lines")
    files.look()
    files.offer({"file": 0, "byte": 8})
    load(spark, path, out, checkpoint, lines_per_batch=3)
    rows = spark.read.parquet(str(out)).orderBy("arrival").collect()
    assert [r["line"] for r in rows] == [str(i) for i in range(10)]
    assert max(r["batch"] for r in rows) == 1
