"""Opening files by path or URI, on the driver and in tasks."""

from __future__ import annotations

from pyarrow import fs


def open_location(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a local path or a Hadoop-style URI."""
    if path.startswith("file:/"):
        path = path.removeprefix("file:")
        path = "/" + path.lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def exists(path: str) -> bool:
    system, inner = open_location(path)
    return system.get_file_info(inner).type != fs.FileType.NotFound
