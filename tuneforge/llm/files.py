"""Reading and writing whole files from Spark tasks, on whatever store a path names."""

from __future__ import annotations

import re


def store_of(path: str):
    """(file system, path inside it) of a plain path, a file: URI or any URI pyarrow knows."""
    from pyarrow import fs

    if re.match(r"file:/", path):
        path = re.sub(r"^file:/+", "/", path)
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def make_folder(path: str) -> None:
    system, inner = store_of(path)
    system.create_dir(inner, recursive=True)


def open_output(path: str):
    system, inner = store_of(path)
    return system.open_output_stream(inner)


def open_input(path: str):
    """A file open for seeking and reading ranges."""
    system, inner = store_of(path)
    return system.open_input_file(inner)


def read_range(f, start: int, size: int) -> bytes:
    f.seek(start)
    data = f.read(size)
    if len(data) != size:
        raise OSError(f"file ends {size - len(data)} bytes early")
    return data
