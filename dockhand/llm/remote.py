"""Files of the shared folder, opened inside tasks."""

from __future__ import annotations

import re

from pyarrow import fs


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Hadoop prints it, and the path there."""
    uri = re.sub(r"^file:/+", "file:///", path)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))
