"""Files of the operators' own formats in the shared folder: written by tasks, read by Spark."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


@contextmanager
def whole_file(uri: str):
    """Write under a hidden name and rename at the end, so that readers only see whole files.

    A task that runs again writes the same rows under the same name: the file is replaced by its equal.
    """
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    folder, name = path.rsplit("/", 1)
    store.create_dir(folder, recursive=True)
    hidden = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(hidden) as out:
        yield out
    if store.get_file_info(path).type != fs.FileType.NotFound:
        store.delete_file(path)
    store.move(hidden, path)


def contents(spark: SparkSession, folder: str) -> DataFrame:
    """(path, content) of each file of a folder; hidden files are left out."""
    return spark.read.format("binaryFile").load(folder).select("path", "content")
