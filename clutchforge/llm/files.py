"""Whole files in shared folders, from tasks: any file system pyarrow knows by URI."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyarrow import fs as pafs


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path in it; ``file:`` and bare paths are the shared mount."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def write_whole(uri: str, fill: Callable[[object], None]) -> None:
    """``fill`` writes to a name of its own; the file appears under ``uri`` when
    complete, so a retried or doubled task replaces it by the same bytes."""
    fs, path = open_fs(uri)
    folder, _, name = path.rpartition("/")
    fs.create_dir(folder, recursive=True)
    own = f"{folder}/_{name}.{uuid.uuid4().hex[:8]}"
    with fs.open_output_stream(own, compression=None) as out:
        fill(out)
    fs.move(own, path)
