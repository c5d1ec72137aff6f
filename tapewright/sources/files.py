"""Binary files written by tasks to any store that pyarrow knows by its address, each moved into place when it is whole."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame

from ..scratch import settle


def store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of an address (a plain path is local or mounted) and the place in it."""
    if "://" not in path:
        path = path.removeprefix("file:")
        return pafs.LocalFileSystem(), path.rstrip("/")
    found, root = pafs.FileSystem.from_uri(path)
    return found, root.rstrip("/")


def listed(fs: pafs.FileSystem, root: str) -> list[str]:
    """All files at or below a place, in order."""
    if fs.get_file_info(root).type == pafs.FileType.File:
        return [root]
    return sorted(i.path for i in fs.get_file_info(pafs.FileSelector(root, recursive=True)) if i.type == pafs.FileType.File)


def put(folder: str, name: str, content: bytes) -> None:
    """Write folder/name; a task that runs again replaces the file by an equal one."""
    fs, root = store(folder)
    target = f"{root}/{name.lstrip('/')}"
    fs.create_dir(target.rsplit("/", 1)[0], recursive=True)
    part = f"{target.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(part) as f:
        f.write(content)
    fs.move(part, target)


def put_files(rows: DataFrame, folder: str) -> DataFrame:
    """Write rows (name, content) as files below folder, one by one in the tasks; returns their names and bytes, computed once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, contents = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for name, content in zip(names, contents, strict=True):
                put(folder, name, content or b"")
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([len(c or b"") for c in contents], pa.int64())], names=["name", "bytes"])

    return settle(rows.select("name", "content").mapInArrow(run, "name string, bytes long"), "files-written")
