"""Named files in a folder: a sink with commit and abort, and reading by key.

``write_files`` writes one file a row, from bytes of the row or copied from
another file. It is a Spark data source writer, so Spark says which task
attempts count: each attempt writes below ``_pending/<job>/<attempt>`` and
moves a finished file to its name, after noting the names of its batch. A commit drops what
is pending, including the halves of killed attempts, and writes ``_SUCCESS``
with the totals; an abort also takes back the files that any attempt of the job
has noted, after renaming the job's folder, so that tasks that still run can move
no file any more (a store that renames no folders has no such barrier). Two attempts of one task write the same bytes to the same names, so
a speculative one does no harm. The driver gets two numbers an attempt, never
names.

Copied files go through a task in pieces of CHUNK bytes, and a file is opened
only when its row comes: with ``photo_selection`` before it, no byte of an
unselected file is read, and no bytes pass the JVM or an Arrow batch.

Paths are URIs that ``pyarrow.fs`` opens on the executors (``hdfs://``, an object
store), or local paths where all tasks run on this machine or below the
checkpoint folder, which the cluster's machines share. Rows without a
name are passed over; a name's folders are dropped. The target may hold other
files already, but not one of these names.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from shelfaudit.session import checkpoint_dir

#: Bytes of a copied file that a task holds.
CHUNK = 4 << 20
PENDING, SUCCESS = "_pending", "_SUCCESS"
#: Added to the name of an aborted job's folder.
ENDED = ".ended"


def open_folder(uri: str):
    """(filesystem, path) of a URI or a local path."""
    from pyarrow import fs

    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), os.path.abspath(uri.removeprefix("file:"))


def _local_path(uri: str) -> str | None:
    """The plain path of a local path or ``file:`` URI, else None."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return None if "://" in uri else os.path.abspath(uri)


def shared(df: DataFrame, uri: str) -> str:
    """``uri``, if all executors reach it: a local path only counts where all tasks run on this machine, or
    below ``spark.checkpoint.dir``, the folder that the driver and all executors share."""
    path, spark = _local_path(uri), df.sparkSession
    if path is not None and not spark.conf.get("spark.master", "").startswith("local["):
        common = _local_path(checkpoint_dir(spark))
        if common is None or os.path.commonpath([common, path]) != common:
            raise ValueError("files need a place that all executors reach, e.g. hdfs://")
    return uri


@dataclass
class Written(WriterCommitMessage):
    files: int
    n_bytes: int


class FileWriter(DataSourceArrowWriter):
    def __init__(self, target: str):
        self.target, self.job = target, uuid.uuid4().hex
        fs, root = open_folder(target)
        fs.create_dir(f"{root}/{PENDING}/{self.job}", recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = open_folder(self.target)
        folder = f"{root}/{PENDING}/{self.job}/{uuid.uuid4().hex}"
        fs.create_dir(folder, recursive=False)  # an ended job's folder is gone: no attempt begins after it
        done = Written(0, 0)
        for batch in iterator:
            names = [None if n is None else os.path.basename(n) for n in batch.column(0).to_pylist()]
            with fs.open_output_stream(f"{folder}/{done.files}.names") as note:
                note.write(json.dumps([n for n in names if n]).encode())
            for k, name in enumerate(names):
                if name is None:
                    continue
                part = f"{folder}/{done.files}.part"
                done.n_bytes += self._fill(fs, part, batch.column(1)[k])
                self._move(fs, part, f"{root}/{name}")
                done.files += 1
        return done

    @staticmethod
    def _fill(fs, path: str, given: pa.Scalar) -> int:
        """Write the bytes given, or those of the file named."""
        n = 0
        with fs.open_output_stream(path) as out:
            if pa.types.is_string(given.type):
                there, source = open_folder(given.as_py())
                with there.open_input_stream(source) as data:
                    while piece := data.read(CHUNK):
                        out.write(piece)
                        n += len(piece)
            elif given.is_valid:
                data = given.as_buffer()
                out.write(data)
                n = data.size
        return n

    @staticmethod
    def _move(fs, part: str, final: str) -> None:
        try:
            fs.move(part, final)
        except OSError:  # a filesystem that replaces nothing: another attempt was first
            if not fs.get_file_info(final).is_file:
                raise
            fs.delete_file(part)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = open_folder(self.target)
        self._drop_pending(fs, root)
        done = [m for m in messages if m is not None]
        with fs.open_output_stream(f"{root}/{SUCCESS}") as out:
            out.write(f"{sum(m.files for m in done)} {sum(m.n_bytes for m in done)}\n".encode())

    def abort(self, messages: list[Written | None]) -> None:
        from pyarrow.fs import FileSelector

        fs, root = open_folder(self.target)
        ended = f"{root}/{PENDING}/{self.job}{ENDED}"
        try:
            fs.move(f"{root}/{PENDING}/{self.job}", ended)  # what still runs finds no part to move: the notes are complete
        except OSError:  # a store that renames no folders
            ended = f"{root}/{PENDING}/{self.job}"
        attempts = fs.get_file_info(FileSelector(ended, allow_not_found=True))
        for attempt in attempts:  # one note after the other: the names are never all here
            for note in fs.get_file_info(FileSelector(attempt.path, allow_not_found=True)):
                if note.path.endswith(".names"):
                    for name in self._noted(fs, note.path):
                        if fs.get_file_info(f"{root}/{name}").is_file:
                            fs.delete_file(f"{root}/{name}")
        self._drop_pending(fs, root)

    @staticmethod
    def _noted(fs, path: str) -> list[str]:
        with fs.open_input_stream(path) as f:
            data = f.read()
        try:
            return json.loads(data)
        except ValueError:  # written in part: none of its files was moved
            return []

    def _drop_pending(self, fs, root: str) -> None:
        from pyarrow.fs import FileSelector

        for folder in (f"{root}/{PENDING}/{self.job}", f"{root}/{PENDING}/{self.job}{ENDED}"):
            if fs.get_file_info(folder).type.name == "Directory":
                fs.delete_dir(folder)
        if not fs.get_file_info(FileSelector(f"{root}/{PENDING}", allow_not_found=True)):
            if fs.get_file_info(f"{root}/{PENDING}").type.name == "Directory":
                fs.delete_dir(f"{root}/{PENDING}")


class NamedFiles(DataSource):
    """``df.write.format("named_files")`` of (name string, bytes binary) or (name string, path of a file string)."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def writer(self, schema, overwrite: bool) -> FileWriter:
        kinds = [f.dataType.simpleString() for f in schema.fields]
        if len(kinds) != 2 or kinds[0] != "string" or kinds[1] not in ("string", "binary"):
            raise ValueError(f"named files have a name and bytes or a path, not {kinds}")
        return FileWriter(self.options["path"])


def write_files(df: DataFrame, name_col: str, data_col: str, target: str) -> None:
    """One file ``target/<name>`` a row, committed as a whole.

    ``data_col`` is binary (the bytes; NULL is an empty file) or a string (the file to copy).
    """
    shared(df, target)
    df.sparkSession.dataSource.register(NamedFiles)
    rows = df.where(F.col(name_col).isNotNull()).select(F.col(name_col).cast("string").alias("name"), F.col(data_col).alias("data"))
    rows.write.format("named_files").mode("append").option("path", target).save()


def stored_at(folder: str, name):
    """The path of a file of a folder, as a column: what ``write_files`` copies from."""
    return F.concat(F.lit(folder.rstrip("/") + "/"), name)
