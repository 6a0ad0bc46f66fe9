"""A streaming data source for a landed change feed: one folder of Parquet files per commit version, read by offset ranges.

    spark.dataSource.register(ChangeFeed)
    spark.readStream.format("change_feed").schema(schema).option("path", …).option("position", …).load()

An offset is the last version read. Versions are ``path/_commit_version=N`` with a ``_SUCCESS`` file, as Spark writes them. Without a
position the stream begins after the newest version there is, so that what landed before the first start is never read; ``startingVersion`` begins
with a version instead. The beginning is stored once under ``position``, next to the last version done, so that a start that failed before its first
batch begins at the same place. A batch takes at most ``maxVersionsPerTrigger`` versions.

Each file is one task, which reads the columns of the schema only. Paths are anything ``pyarrow.fs`` opens; executors need to reach them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

VERSION = "_commit_version"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or a plain path."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def replace_text(path: str, text: str) -> None:
    """Write a small file under another name first, so that readers see the old or the new one."""
    system, place = opened(path)
    system.create_dir(place.rpartition("/")[0], recursive=True)
    with system.open_output_stream(f"{place}.new") as f:
        f.write(text.encode())
    system.move(f"{place}.new", place)


def read_text(path: str) -> str | None:
    system, place = opened(path)
    if system.get_file_info(place).type == fs.FileType.NotFound:
        return None
    with system.open_input_stream(place) as f:
        return f.read().decode()


@dataclass(frozen=True)
class FeedFile(InputPartition):
    path: str
    version: int


class ChangeFeed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "change_feed"

    def streamReader(self, schema: StructType) -> "FeedReader":
        return FeedReader(self.options, schema)


class FeedReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema: StructType):
        for needed in ("path", "position"):
            if not options.get(needed):
                raise ValueError(f"change_feed needs the option {needed}")
        self.path, self.position, self.schema = options["path"].rstrip("/"), options["position"], schema
        self.most = int(options["maxVersionsPerTrigger"]) if options.get("maxVersionsPerTrigger") else None
        self.first = int(options["startingVersion"]) - 1 if options.get("startingVersion") else None
        self.at: int | None = None

    def _stored(self) -> dict:
        """The beginning and the last version done; the beginning is decided once."""
        stored = json.loads(read_text(self.position) or "{}")
        if "begin" not in stored:
            begin = self.first if self.first is not None else max(self._versions(), default=-1)
            stored = {"begin": begin, "done": begin}
            replace_text(self.position, json.dumps(stored))
        return stored

    def _versions(self) -> list[int]:
        """Completely landed versions."""
        system, place = opened(self.path)
        found = system.get_file_info(fs.FileSelector(place, allow_not_found=True))
        named = {int(f.base_name.partition("=")[2]): f.path for f in found if f.base_name.startswith(f"{VERSION}=")}
        marks = system.get_file_info([f"{p}/_SUCCESS" for p in named.values()])
        return sorted(v for v, mark in zip(named, marks) if mark.type != fs.FileType.NotFound)

    def initialOffset(self) -> dict:
        return {"version": self._stored()["begin"]}

    def latestOffset(self) -> dict:
        if self.at is None:
            self.at = self._stored()["done"]
        waiting = [v for v in self._versions() if v > self.at]
        if waiting:
            self.at = waiting[min(self.most or len(waiting), len(waiting)) - 1]
        return {"version": self.at}

    def partitions(self, start: dict, end: dict) -> Sequence[FeedFile]:
        system, place = opened(self.path)
        out = []
        for version in (v for v in self._versions() if start["version"] < v <= end["version"]):
            files = system.get_file_info(fs.FileSelector(f"{place}/{VERSION}={version}"))
            out += [FeedFile(f.path, version) for f in files if f.base_name.endswith(".parquet") and f.size]
        return sorted(out, key=lambda f: (f.version, f.path))

    def read(self, partition: FeedFile) -> Iterator[pa.RecordBatch]:
        wanted = to_arrow_schema(self.schema)
        system, _ = opened(self.path)
        with system.open_input_file(partition.path) as f:
            file = pq.ParquetFile(f)
            held = [n for n in wanted.names if n in file.schema_arrow.names]
            for batch in file.iter_batches(columns=held):
                columns = [self._column(batch, field, partition.version) for field in wanted]
                yield pa.RecordBatch.from_arrays(columns, schema=wanted)

    @staticmethod
    def _column(batch: pa.RecordBatch, field: pa.Field, version: int) -> pa.Array:
        if field.name == VERSION:
            return pa.array([version] * batch.num_rows, field.type)
        if field.name not in batch.schema.names:
            return pa.nulls(batch.num_rows, field.type)  # a column that came later
        return batch.column(field.name).cast(field.type)

    def commit(self, end: dict) -> None:
        replace_text(self.position, json.dumps(self._stored() | {"done": end["version"]}))
