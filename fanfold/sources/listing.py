"""A source of file listings, which sees empty files: a partition for each folder.

Spark's own file sources leave empty files out of their scans.  This one asks the store: the
driver goes down from the root only until there are enough folders to deal out, and tasks
list the folders and all below them.
"""

from __future__ import annotations

import re
from datetime import timezone
from fnmatch import fnmatchcase

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Folders to deal out before the driver stops going down.
FOLDERS = 64
SCHEMA = "path string, name string, size long, modified timestamp"


def store_of(root: str):
    """``(file system, path in it, prefix of its paths as Spark writes them)`` of a folder that
    pyarrow can open, else None."""
    import pyarrow as pa
    from pyarrow import fs

    try:
        if "://" in root or root.startswith("file:"):
            store, path = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", root))
        else:
            store, path = fs.LocalFileSystem(), root
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return None
    if isinstance(store, fs.LocalFileSystem):
        return store, path.rstrip("/") or "/", "file:"
    scheme, rest = root.split("://", 1)
    return store, path.rstrip("/"), root[: len(scheme) + 3] + (rest.split("/", 1)[0] if path.startswith("/") else "")


def patterns(glob: str) -> list[str]:
    """A glob with ``{a,b}`` as globs without."""
    brace = re.search(r"\{([^{}]*)\}", glob)
    if not brace:
        return [glob.replace("[^", "[!")]
    return [p for part in brace[1].split(",") for p in patterns(glob[: brace.start()] + part + glob[brace.end() :])]


def _hidden(name: str) -> bool:
    return name.startswith(("_", "."))


class FolderPartition(InputPartition):
    def __init__(self, folder: str, deep: bool):
        self.folder, self.deep = folder, deep


class ListingReader(DataSourceReader):
    def __init__(self, options):
        self.root, self.globs = options["path"], patterns(options.get("pattern", "*"))

    def partitions(self):
        from pyarrow import fs

        store, root, _ = store_of(self.root)
        if store.get_file_info(root).type != fs.FileType.Directory:
            raise FileNotFoundError(f"no folder {self.root}")
        shallow, level = [], [root]
        while level and len(level) < FOLDERS:
            shallow += level
            level = [x.path for folder in level for x in store.get_file_info(fs.FileSelector(folder)) if x.type == fs.FileType.Directory and not _hidden(x.base_name)]
        return [FolderPartition(f, False) for f in shallow] + [FolderPartition(f, True) for f in level]

    def read(self, partition):
        from pyarrow import fs

        store, _, prefix = store_of(self.root)
        folders = [partition.folder]
        while folders:
            for x in store.get_file_info(fs.FileSelector(folders.pop())):
                if _hidden(x.base_name):
                    continue
                if x.type == fs.FileType.Directory and partition.deep:
                    folders.append(x.path)
                elif x.type == fs.FileType.File and any(fnmatchcase(x.base_name, g) for g in self.globs):
                    yield prefix + x.path, x.base_name, x.size, x.mtime.astimezone(timezone.utc) if x.mtime else None


class Listing(DataSource):
    """``spark.read.format("folder_listing").option("pattern", "*.txt").load(folder)``."""

    @classmethod
    def name(cls):
        return "folder_listing"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return ListingReader(self.options)
