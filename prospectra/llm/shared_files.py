"""Files in the shared folder that tasks read or write themselves."""

from __future__ import annotations

import pyarrow.fs as pafs


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and its path there; a path without scheme is a shared local one."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)
