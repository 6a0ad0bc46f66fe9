"""A streaming sink with a two-phase commit: tasks stage files, the driver publishes a micro-batch as a whole or drops it.

    spark.dataSource.register(CommittedFiles)
    stream.writeStream.format("committed_files").option("path", …).option("checkpointLocation", …).start()

A task writes its rows to one staged Parquet file and reports its name. When all tasks of a batch have ended, one list of these names is put in
place; only listed files are ever read. A batch that fails leaves staged files that no list names, and removes those that were reported.
A batch that runs again replaces its own list, so that every row is stored once however often the batch ran.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from changeflow.sources.feed_stream import opened, read_text, replace_text


@dataclass(frozen=True)
class Staged(WriterCommitMessage):
    file: str | None
    rows: int


class CommittedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "committed_files"

    def streamWriter(self, schema: StructType, overwrite: bool) -> "FilesWriter":
        if not self.options.get("path"):
            raise ValueError("committed_files needs the option path")
        return FilesWriter(self.options["path"].rstrip("/"))


class FilesWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        system, place = opened(self.path)
        name, writer, rows = f"part-{uuid.uuid4().hex}.parquet", None, 0
        try:
            for batch in iterator:
                if writer is None:
                    system.create_dir(f"{place}/data", recursive=True)
                    writer = pq.ParquetWriter(f"{place}/data/{name}", batch.schema, filesystem=system, compression="snappy")
                writer.write_batch(batch)
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        return Staged(name if writer is not None else None, rows)

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        place = f"{self.path}/commits/{batchId:020d}.json"
        before = read_text(place)
        files = sorted(m.file for m in messages if m is not None and m.file)
        replace_text(place, json.dumps({"files": files, "rows": sum(m.rows for m in messages if m is not None)}))
        if before is not None:
            self._drop(set(json.loads(before)["files"]) - set(files))

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        self._drop({m.file for m in messages if m is not None and m.file})

    def _drop(self, files: set[str]) -> None:
        system, place = opened(self.path)
        for name in files:
            if system.get_file_info(f"{place}/data/{name}").type != fs.FileType.NotFound:
                system.delete_file(f"{place}/data/{name}")


def commits(path: str) -> dict[int, dict]:
    """Batch number to its files and number of rows."""
    system, place = opened(path)
    found = system.get_file_info(fs.FileSelector(f"{place}/commits", allow_not_found=True))
    names = sorted(f.base_name for f in found if f.base_name.endswith(".json"))
    return {int(name[:-5]): json.loads(read_text(f"{path}/commits/{name}")) for name in names}


def read_committed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of all published batches."""
    files = [f"{path}/data/{name}" for c in commits(path).values() for name in c["files"]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def staged_only(path: str) -> list[str]:
    """Files that no batch lists: leftovers of tasks that were lost or ran twice. Safe to delete while no query writes."""
    system, place = opened(path)
    listed = {name for c in commits(path).values() for name in c["files"]}
    found = system.get_file_info(fs.FileSelector(f"{place}/data", allow_not_found=True))
    return sorted(f.base_name for f in found if f.base_name not in listed)
