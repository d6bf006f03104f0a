"""Files that tasks write below the shared folder and read back, on any file system."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.fs


def locate(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a URI or an absolute path, and the path in it."""
    if "://" not in uri and not uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(uri)


def make_folder(uri: str) -> None:
    fs, path = locate(uri)
    fs.create_dir(path, recursive=True)


def mapped(uri: str) -> pa.NativeFile:
    """The file for reading: memory-mapped on a local or mounted file system."""
    fs, path = locate(uri)
    return pa.memory_map(path) if isinstance(fs, pyarrow.fs.LocalFileSystem) else fs.open_input_file(path)


def span(source: pa.NativeFile, dtype, first: int, end: int) -> np.ndarray:
    """Items ``first`` to ``end`` of a flat file; a view of the map where there is one."""
    size = np.dtype(dtype).itemsize
    return np.frombuffer(source.read_at((end - first) * size, first * size), dtype)
