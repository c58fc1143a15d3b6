"""File sink of the photo export: one file per selected attachment.

Each task writes the files of its own rows to the shared target folder
(write to a temporary name, then move), and reports what it wrote, so a
retried task after a lost executor simply rewrites the same names. The
target is a local path or a filesystem URI understood by ``pyarrow.fs``
(e.g. ``hdfs://`` or an object store), opened on the executors.
Rows without a name (a NULL part) are skipped, like a failed shell call.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT_SCHEMA = "file_name string, n_bytes long"


def _check_target(df: DataFrame, target: str) -> None:
    """A path without a scheme is the executor's own disk: only a local session may use it."""
    if "://" not in target and not df.sparkSession.conf.get("spark.master", "").startswith("local["):
        raise ValueError("the export's target needs a scheme that all executors reach, e.g. hdfs://")


def _filesystem(target: str):
    from pyarrow import fs as pafs

    if "://" in target:
        return pafs.FileSystem.from_uri(target)
    return pafs.LocalFileSystem(), os.path.abspath(target)


def export_files(df: DataFrame, name_col: str, data_col: str, target_dir: str) -> DataFrame:
    """Lazily write ``data_col`` bytes to ``target_dir/<name_col>``; returns names and sizes.

    Nothing is written until the returned DataFrame is evaluated (e.g. ``count()``).
    The guard of the original (export only if documents exist) holds by
    construction: no rows, no files.
    """
    _check_target(df, target_dir)
    rows = df.where(F.col(name_col).isNotNull()).select(
        F.col(name_col).alias("_name"), F.col(data_col).cast("binary").alias("_data")
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = _filesystem(target_dir)
        fs.create_dir(root, recursive=True)
        for pdf in batches:
            out_names, out_sizes = [], []
            for name, data in zip(pdf["_name"], pdf["_data"]):
                payload = b"" if data is None else bytes(data)
                final = f"{root}/{os.path.basename(name)}"
                tmp = f"{final}.{uuid.uuid4().hex}.part"
                with fs.open_output_stream(tmp) as out:
                    out.write(payload)
                fs.move(tmp, final)
                out_names.append(name)
                out_sizes.append(len(payload))
            yield pd.DataFrame({"file_name": out_names, "n_bytes": pd.Series(out_sizes, dtype="int64")})

    return rows.mapInPandas(write, RESULT_SCHEMA)
