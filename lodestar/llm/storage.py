"""Files of our own formats on shared storage, written and read by Spark tasks.

A write task names its file with a fresh suffix and returns a manifest row; the
manifest is a table written by Spark, so only files of tasks that succeeded are
ever read: a lost executor or a second attempt leaves an unlisted file, nothing
else.  Paths are URIs that pyarrow opens (file, hdfs, s3, gs)."""

from __future__ import annotations

import re
import uuid

import pyarrow as pa
from pyarrow import fs


def _resolve(uri: str) -> tuple[fs.FileSystem, str]:
    uri = re.sub(r"^file:/+", "file:///", uri)
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def create(folder: str, part: int, suffix: str) -> tuple[str, pa.NativeFile]:
    """A new file in ``folder`` for one attempt of one task: its URI and an output stream."""
    uri = f"{folder}/{part:05d}-{uuid.uuid4().hex[:12]}{suffix}"
    system, path = _resolve(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return uri, system.open_output_stream(path, compression=None)


def open_file(uri: str) -> pa.NativeFile:
    """Random-access input."""
    system, path = _resolve(uri)
    return system.open_input_file(path)
