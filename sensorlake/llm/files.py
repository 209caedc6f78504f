"""Binary files below the shared folder, written and read inside tasks.

A folder is a URI of any file system that Arrow knows (a mounted folder, HDFS, S3 and
others). A file gets a name of its own for each attempt of a task and counts only if the
task reports it, so a lost or repeated task leaves no wrong data.
"""

import uuid
from contextlib import contextmanager

from pyarrow import fs
from pyspark import TaskContext

from sensorlake.session import scratch_path, written
from sensorlake.sources.archive import arrow_uri


def new_folder(spark, name):
    return scratch_path(spark, name)


@contextmanager
def new_file(folder, suffix):
    """(URI, open stream) of a new file of this task."""
    system, path = fs.FileSystem.from_uri(arrow_uri(folder))
    system.create_dir(path, recursive=True)
    name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}{suffix}"
    with system.open_output_stream(f"{path}/{name}", compression=None) as out:
        yield f"{folder}/{name}", out


@contextmanager
def opened(uri, random=False):
    system, path = fs.FileSystem.from_uri(arrow_uri(uri))
    opener = system.open_input_file if random else system.open_input_stream
    with opener(path, **({} if random else {"compression": None})) as stream:
        yield stream


def listed(frame, name):
    """Runs the tasks that write files; what they report, as a table with a task per row."""
    files = written(frame, name)
    return files.repartition(max(1, files.count()))
