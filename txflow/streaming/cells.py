"""The cells of a stream as a log-structured table.

Each micro-batch adds a folder of cells; folders of one level are merged into one of the next
when there are ``FANOUT`` of them, so there are few at any age of the stream, and a cell is
rewritten as often as there are levels. A manifest per batch names the folders that make up the
table after it, with the windows each holds, so that a batch opens only those it needs. A manifest
is published last and by renaming: a batch that fails before leaves the table as it was, and
runs again from its predecessor's.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from txflow.functions.money import PARTS
from txflow.operators.windows import merge_label_cells, merge_latency_cells
from txflow.sinks import files

FANOUT = 8
#: So many manifests stay, and what they name, for readers that began with an older one.
KEPT = 10

_MONEY = ", ".join(f"total_{part} {'double' if part == 'odd' else 'bigint'}" for part in PARTS)
TABLES = {
    "labels": f"window_id bigint, region string, product_category string, events bigint, {_MONEY}, fraud bigint, "
    "late bigint, first_seen decimal(38,0), last_us bigint",
    "latencies": "window_id bigint, latency_us bigint, events bigint",
}
_MERGE = {"labels": merge_label_cells, "latencies": merge_latency_cells}


@dataclass(frozen=True)
class Part:
    """Cells of the windows ``low`` to ``high``, in a folder of each table."""

    folder: str
    level: int
    low: int
    high: int


@dataclass
class Manifest:
    """The table after a batch, and the last arrival up to it."""

    batch_id: int = -1
    seen: int | None = None
    parts: list[Part] = field(default_factory=list)
    #: How many parts the batch read.
    opened: int = 0


def batch_folder(batch_id: int) -> str:
    return f"batch_id={batch_id}"


def path_of(output_path: str, name: str, folder: str) -> str:
    return f"{output_path}/cells/{name}/{folder}" if folder.startswith("batch_id=") else f"{output_path}/merged/{name}/{folder}"


def _ids(spark: SparkSession, output_path: str) -> list[int]:
    found = (n.removesuffix(".json") for n in files.names(spark, f"{output_path}/manifests"))
    return sorted(int(n) for n in found if n.isdigit())


def _load(spark: SparkSession, output_path: str, batch_id: int) -> Manifest:
    told = json.loads(files.read_text(spark, f"{output_path}/manifests/{batch_id}.json"))
    return Manifest(**told | {"parts": [Part(**p) for p in told["parts"]]})


def latest(spark: SparkSession, output_path: str, before: int | None = None) -> Manifest:
    """The last manifest, or the last one of a batch before ``before``; an empty one if there is none."""
    ids = [i for i in _ids(spark, output_path) if before is None or i < before]
    return _load(spark, output_path, ids[-1]) if ids else Manifest()


def publish(spark: SparkSession, output_path: str, manifest: Manifest) -> None:
    """Make ``manifest`` the latest, and drop what none of the ``KEPT`` last ones names."""
    files.publish_text(spark, f"{output_path}/manifests/{manifest.batch_id}.json", json.dumps(asdict(manifest)))
    ids = _ids(spark, output_path)
    for old, following in zip(ids[:-KEPT], ids[1:], strict=False):
        # A folder that was left out once never comes back.
        gone = set(_load(spark, output_path, old).parts) - set(_load(spark, output_path, following).parts)
        for part in gone:
            for name in TABLES:
                files.delete(spark, path_of(output_path, name, part.folder))
        files.delete(spark, f"{output_path}/manifests/{old}.json")


def read(spark: SparkSession, output_path: str, parts: list[Part], name: str) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], TABLES[name])
    return spark.read.schema(TABLES[name]).parquet(*[path_of(output_path, name, p.folder) for p in parts])


def holding(parts: list[Part], first_open: int | None, pages: list[int], page: int) -> list[Part]:
    """The parts with windows from ``first_open`` on, or in one of the ``pages`` of ``page`` windows each."""
    return [
        p
        for p in parts
        if (first_open is not None and p.high >= first_open) or any(x * page <= p.high and p.low < (x + 1) * page for x in pages)
    ]


def full_level(parts: list[Part], fanout: int | None = None) -> list[Part]:
    """The parts of the lowest level that has ``FANOUT`` of them."""
    for level in sorted({p.level for p in parts}):
        own = [p for p in parts if p.level == level]
        if len(own) >= (fanout or FANOUT):
            return own
    return []


def merged_part(parts: list[Part], batch_id: int) -> Part:
    level = parts[0].level + 1
    return Part(f"level={level}-{batch_id}", level, min(p.low for p in parts), max(p.high for p in parts))


def compacted(spark: SparkSession, output_path: str, parts: list[Part], batch_id: int) -> list[Part]:
    """``parts`` with full levels merged, the merged cells written."""
    while own := full_level(parts):
        into = merged_part(own, batch_id)
        for name, merge in _MERGE.items():
            cells = merge(read(spark, output_path, own, name))
            cells.write.mode("overwrite").parquet(path_of(output_path, name, into.folder))
        parts = [p for p in parts if p not in own] + [into]
    return parts
