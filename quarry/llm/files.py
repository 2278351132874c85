"""Files in the cluster's shared folder, written and range-read by tasks."""

from __future__ import annotations

import re

from pyarrow import fs


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI as Spark names it, and the path in it."""
    path = re.sub(r"^file:/+", "file:///", re.sub(r"^s3[an]:", "s3:", path))
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)
