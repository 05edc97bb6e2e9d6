"""Lines of files that grow: a streaming source for Spark.

Spark's own file stream takes a file once, when it appears. Here the offset of the stream holds
how many bytes of each file have been read, up to the end of the last whole line; Spark keeps it
in the checkpoint. A micro-batch reads the bytes that were added, in ranges side by side.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# Tasks get the source by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RANGE_BYTES = 32 << 20
_BLOCK = 1 << 20


@dataclass
class Range(InputPartition):
    """The lines of a file that begin at ``start`` or later and before ``end``, none from ``stop`` on."""

    path: str
    first: int
    start: int
    end: int
    stop: int


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def _last_line_end(system: fs.FileSystem, path: str, size: int) -> int:
    """The place after the last line feed, looked for from the end."""
    with system.open_input_file(path) as file:
        high = size
        while high > 0:
            low = max(0, high - _BLOCK)
            at = file.read_at(high - low, low).rfind(b"\n")
            if at >= 0:
                return low + at + 1
            high = low
    return 0


def lines_of(part: Range) -> Iterator[list[bytes]]:
    """The lines of a range, a block at a time. The line that reaches over its end is read whole."""
    system, path = _opened(part.path)
    with system.open_input_file(path) as file:
        at, rest = part.start, b""
        if part.start > part.first:
            # The line that holds the byte before belongs to the range before.
            at = part.start - 1
            while at < part.end:
                block = file.read_at(min(_BLOCK, part.end - at), at)
                feed = block.find(b"\n")
                if feed >= 0:
                    at += feed + 1
                    break
                at += len(block)
        begin = at  # of the line in ``rest``
        while begin < part.end:
            block = file.read_at(min(_BLOCK, part.stop - at), at)
            if not block:
                raise ValueError(f"{part.path} is shorter than it was")
            at += len(block)
            pieces = (rest + block).split(b"\n")
            rest = pieces.pop()
            whole = []
            for line in pieces:
                if begin < part.end:
                    whole.append(line)
                begin += len(line) + 1
            yield whole


class GrowingLines(DataSource):
    """``spark.readStream.format("growing_lines").load(path)``: the column ``value``.

    ``path`` is a file or a folder of files, on a file system that the driver and all executors see
    (names that begin with ``_`` or ``.`` are left out). Files may be appended to, and new ones may
    appear; every line comes once. The end of a file waits until its line feed is written. A
    carriage return before the line feed is dropped, bytes that are no UTF-8 are replaced. A file
    that gets shorter ends the stream; one that goes away and comes back is a new one. The option
    ``rangeBytes`` sets how much one task reads.
    """

    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return GrowingLinesReader(self.options["path"], int(self.options.get("rangeBytes", RANGE_BYTES)))


class GrowingLinesReader(DataSourceStreamReader):
    def __init__(self, path: str, range_bytes: int):
        self.path, self.range_bytes = path, range_bytes

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        system, path = _opened(self.path)
        found = system.get_file_info(path)
        if found.type == fs.FileType.Directory:
            files = system.get_file_info(fs.FileSelector(path))
        else:
            files = [] if found.type == fs.FileType.NotFound else [found]
        files = sorted((f for f in files if f.is_file and not f.base_name.startswith(("_", "."))), key=lambda f: f.base_name)
        ends = ((f.base_name, _last_line_end(system, f.path, f.size)) for f in files)
        return {name: end for name, end in ends if end}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        system, path = _opened(self.path)
        alone = system.get_file_info(path).is_file
        ranges = []
        for name, stop in end.items():
            first = start.get(name, 0)
            if stop < first:
                raise ValueError(f"{name} in {self.path} is shorter than it was")
            own = self.path if alone else f"{self.path.rstrip('/')}/{name}"
            ranges += [Range(own, first, at, min(at + self.range_bytes, stop), stop) for at in range(first, stop, self.range_bytes)]
        return ranges

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        for lines in lines_of(partition):
            texts = [line.removesuffix(b"\r").decode("utf-8", "replace") for line in lines]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["value"])

    def commit(self, end: dict) -> None:
        """Nothing is kept but the checkpoint."""
