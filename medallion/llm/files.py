"""Binary files that tasks write to the shared folder and read from it.

Spark has no writer for free binary formats, so tasks use Arrow's file systems, which take the
URI of any store they know (a local path, file, hdfs, s3, gs). A file is written under a name of its
attempt and renamed when whole. The rows that tasks return are the list of valid files: what a lost
or repeated attempt leaves behind is in no list.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


def resolved(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class NewFile:
    """A file in ``folder`` that gets its name on ``close``; ``tell`` is its length so far."""

    def __init__(self, folder: str, name: str):
        self.store, base = resolved(folder)
        self.path, self.uri = f"{base}/{name}", f"{folder}/{name}"
        self.store.create_dir(base, recursive=True)
        self.draft = f"{base}/.{name}.{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(self.draft, compression=None)
        self.written = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.written += len(data)

    def close(self) -> str:
        self.out.close()
        self.store.move(self.draft, self.path)
        return self.uri


@contextmanager
def opened(uri: str):
    """A seekable file for reading."""
    store, path = resolved(uri)
    with store.open_input_file(path) as file:
        yield file
