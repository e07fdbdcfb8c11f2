"""Files that tasks write and read in the shared folder, whatever store it is in."""

from __future__ import annotations

import re
import uuid
from pathlib import Path

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import SparkSession

from rentscope.session import scratch_path


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI (or plain path) and the path in it."""
    if "://" not in uri:
        uri = Path(re.sub(r"^file:", "", uri)).absolute().as_uri()
    return fs.FileSystem.from_uri(uri)


def new_folder(spark: SparkSession, label: str) -> str:
    """A new folder in the shared area; tasks on all machines may write to it."""
    uri = scratch_path(spark, label)
    system, path = locate(uri)
    system.create_dir(path, recursive=True)
    return uri


def attempt_name(folder: str, suffix: str) -> str:
    """A name no other attempt of a task uses. Only files that the finished tasks list
    are read, so what a lost executor left behind does no harm."""
    return f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}{suffix}"


def open_new(uri: str):
    """A file to write; bytes go there as they are, whatever the name ends with."""
    system, path = locate(uri)
    return system.open_output_stream(path, compression=None)


def open_there(uri: str):
    """A file to read from any position."""
    system, path = locate(uri)
    return system.open_input_file(path)
