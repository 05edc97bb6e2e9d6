"""Outputs that readers see whole: each run has a folder of its own, and a pointer names the last one.

The pointer is a file that is replaced by renaming. Whoever reads it before goes on with the
version it named, which stays until ``keep`` later ones are out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import SparkSession

from txflow.sinks import files

_POINTER, _FOLDER, _KEEP = "CURRENT", "versions", 3
Result = TypeVar("Result")


def current(spark: SparkSession, output_path: str) -> str | None:
    """The folder of the last whole version; nothing if there is none yet."""
    if _POINTER not in files.names(spark, output_path):
        return None
    return f"{output_path}/{_FOLDER}/{files.read_text(spark, f'{output_path}/{_POINTER}').split()[-1]}"


def publish(spark: SparkSession, output_path: str, write: Callable[[str], Result], keep: int = _KEEP) -> Result:
    """Let ``write`` fill a new folder, then make that the current version.

    If it fails, readers keep the version they have, and the unfinished folder goes. Of older
    versions the last ``keep`` stay. One run publishes at a time.
    """
    name = uuid.uuid4().hex
    folder = f"{output_path}/{_FOLDER}/{name}"
    try:
        result = write(folder)
    except BaseException:
        files.delete(spark, folder)
        raise
    known = files.read_text(spark, f"{output_path}/{_POINTER}").split() if current(spark, output_path) else []
    stay = [*known[-keep:], name] if keep else [name]
    files.publish_text(spark, f"{output_path}/{_POINTER}", "\n".join(stay) + "\n")
    for old in set(known) - set(stay):
        files.delete(spark, f"{output_path}/{_FOLDER}/{old}")
    return result
