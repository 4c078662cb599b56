"""Files of folders and stores as Spark names them, opened by tasks."""

from __future__ import annotations

from pyarrow import fs

# Schemes under which Spark knows stores that pyarrow calls otherwise.
_STORES = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it; names may hold any character."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    scheme, rest = path.split("://", 1)
    place, _, name = rest.partition("/")
    store, root = fs.FileSystem.from_uri(f"{_STORES.get(scheme.lower(), scheme.lower())}://{place}/")
    return store, f"{root.rstrip('/')}/{name}"
