"""Files that tasks write and read themselves, in the folder all machines share."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs
from pyspark.sql import SparkSession

from tallyframe.plans.lineage import scratch_dir


def open_path(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI or an absolute path."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def make_folder(uri: str) -> str:
    system, path = open_path(uri)
    system.create_dir(path, recursive=True)
    return uri


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared scratch folder."""
    return make_folder(f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}")
