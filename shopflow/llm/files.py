"""Whole files on the shared store, written and read inside tasks."""

from __future__ import annotations

import uuid


def _at(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_file(uri: str, data: bytes) -> None:
    """Write under another name, then move: a lost or repeated task leaves no partial file."""
    from pyarrow import fs

    store, path = _at(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(temporary) as out:
        out.write(data)
    try:
        store.move(temporary, path)
    except OSError:
        if store.get_file_info(path).type != fs.FileType.File:
            raise
        store.delete_file(temporary)  # another attempt of the same task was first


def read_file(uri: str) -> bytes:
    store, path = _at(uri)
    with store.open_input_stream(path) as src:
        return src.read()


def read_range(uri: str, start: int, length: int) -> bytes:
    """``length`` bytes from ``start``; a negative start counts from the end."""
    store, path = _at(uri)
    with store.open_input_file(path) as src:
        src.seek(start if start >= 0 else max(0, src.size() + start))
        return src.read(length)
