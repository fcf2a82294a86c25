"""Byte ranges of files in the folder that driver and executors share, through Arrow's file systems."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs


def _split(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def make_folder(uri: str) -> None:
    where, path = _split(uri)
    where.create_dir(path, recursive=True)


def remove_folder(uri: str) -> None:
    where, path = _split(uri)
    where.delete_dir(path)


@contextmanager
def written_whole(uri: str) -> Iterator:
    """A stream to a file that appears under its name only when complete: a task that is run again replaces it."""
    where, path = _split(uri)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with where.open_output_stream(part) as out:
        yield out
    where.move(part, path)


@contextmanager
def opened(uri: str) -> Iterator:
    where, path = _split(uri)
    with where.open_input_file(path) as f:
        yield f


def size_of(uri: str) -> int:
    where, path = _split(uri)
    return where.get_file_info(path).size
