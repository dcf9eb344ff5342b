"""Binary files that tasks write and read in a shared folder, on any file system that Arrow
can open (local or shared POSIX, HDFS, object stores).

A task writes under a name of its own and returns it as a row, so only the files of tasks
that Spark counts as done are ever listed; what a lost or repeated attempt left is ignored.
"""

from __future__ import annotations

import contextlib
import uuid

from pyarrow import fs


@contextlib.contextmanager
def create(folder: str, prefix: str, suffix: str):
    """(path, output stream) of a new file."""
    files, base = fs.FileSystem.from_uri(folder)
    files.create_dir(base, recursive=True)
    name = f"{prefix}-{uuid.uuid4().hex}{suffix}"
    with files.open_output_stream(f"{base}/{name}", compression=None) as out:
        yield f"{folder.rstrip('/')}/{name}", out


def open_input(path: str):
    """A seekable input file."""
    files, base = fs.FileSystem.from_uri(path)
    return files.open_input_file(base)
