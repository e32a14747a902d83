"""Files by path: local ones with or without ``file:``, others by the URI of their store.

Contents are opened by pyarrow: ``file``, ``hdfs``, ``s3`` (also as ``s3a``, ``s3n``), ``gs``/``gcs`` and ``abfs``/``abfss``, with the
credentials that pyarrow finds for these. A store that only Spark reads is refused with its name.
"""

from __future__ import annotations

import sys
from urllib.parse import quote

import pyarrow.fs as pafs
from pyspark import cloudpickle

# Used inside tasks; see the note in the record splitter.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


SCHEMES = ("file", "hdfs", "s3", "gs", "gcs", "abfs", "abfss")


def locate(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path within it."""
    scheme, mark, rest = path.partition("://")
    if not mark or scheme == "file":
        return pafs.LocalFileSystem(), rest if mark else path.removeprefix("file:")
    scheme = "s3" if scheme in ("s3a", "s3n") else scheme
    if scheme not in SCHEMES:
        raise ValueError(f"files of {scheme}:// cannot be opened here; use one of {', '.join(SCHEMES)}")
    return pafs.FileSystem.from_uri(f"{scheme}://{quote(rest, safe='/:@')}")


def remove_tree(path: str) -> None:
    """Remove a folder, if it is there."""
    filesystem, inner = locate(path)
    if filesystem.get_file_info(inner).type != pafs.FileType.NotFound:
        filesystem.delete_dir(inner)


def read_text(path: str) -> str | None:
    """A small file's text; None if there is no such file."""
    filesystem, inner = locate(path)
    if filesystem.get_file_info(inner).type == pafs.FileType.NotFound:
        return None
    with filesystem.open_input_file(inner) as stream:
        return stream.read().decode("utf-8")


def replace_text(path: str, text: str) -> None:
    """Write a small file under another name and move it into place."""
    filesystem, inner = locate(path)
    with filesystem.open_output_stream(f"{inner}.new", compression=None) as stream:
        stream.write(text.encode("utf-8"))
    filesystem.move(f"{inner}.new", inner)
