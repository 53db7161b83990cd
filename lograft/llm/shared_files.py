"""Files that tasks write and read themselves, in a folder that all share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    """Filesystem and path of a folder under `spark.checkpoint.dir`."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


@contextmanager
def committed(folder: str, name: str) -> Iterator[tuple]:
    """An output stream for `name`. It becomes visible under a name of this
    attempt only when the block ends well, so retried and speculative tasks
    never read or overwrite each other; the reported name is what counts."""
    system, root = resolve(folder)
    stem, dot, ext = name.partition(".")
    final = f"{root}/{stem}-{uuid.uuid4().hex[:12]}{dot}{ext}"
    system.create_dir(root, recursive=True)
    with system.open_output_stream(final + ".partial", compression=None) as out:
        yield out, final.rpartition("/")[2]
    system.move(final + ".partial", final)


def read_bytes(folder: str, name: str) -> bytes:
    system, root = resolve(folder)
    with system.open_input_stream(f"{root}/{name}", compression=None) as f:
        return f.read()
