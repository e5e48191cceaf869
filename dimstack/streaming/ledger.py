"""A file sink that takes each batch once (S08, S09): a Python data source whose
tasks write files and report them, and whose commit enters them in a ledger.

A batch that is delivered again finds its entry and leaves its files out; an
aborted batch removes its files; a task that dies leaves a file that nothing
names.  Readers read the files of the ledger only.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..session import ship_package

FORMAT = "dimstack_ledger"


@dataclass
class Written(WriterCommitMessage):
    file: str | None


class LedgerSink(DataSource):
    """``df.writeStream.format("dimstack_ledger").option("path", folder)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema: StructType, overwrite: bool) -> LedgerWriter:
        return LedgerWriter(self.options["path"])


class LedgerWriter(DataSourceStreamArrowWriter):
    """``path`` is any URI that pyarrow's file systems know, shared by all tasks."""

    def __init__(self, path: str) -> None:
        self.path = path.rstrip("/")

    def _fs(self) -> tuple[pafs.FileSystem, str]:
        uri = self.path if "://" in self.path or not self.path.startswith("file:") else "file://" + self.path[5:]
        return pafs.FileSystem.from_uri(uri)

    def write(self, iterator) -> Written:
        """One file of a task's rows, under a name of its own."""
        fs, root = self._fs()
        writer, name = None, f"data/{uuid.uuid4().hex}.parquet"
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if writer is None:
                    fs.create_dir(f"{root}/data", recursive=True)
                    writer = pq.ParquetWriter(f"{root}/{name}", batch.schema, filesystem=fs)
                writer.write_batch(batch)
        finally:
            if writer is not None:
                writer.close()
        return Written(name if writer is not None else None)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        """Enter the batch's files, unless the batch is in the ledger already."""
        fs, root = self._fs()
        fs.create_dir(f"{root}/ledger", recursive=True)
        entry = f"{root}/ledger/{batchId:012d}.json"
        if fs.get_file_info(entry).type != pafs.FileType.NotFound:
            self.abort(messages, batchId)
            return
        files = [m.file for m in messages if m is not None and m.file]
        draft = f"{root}/ledger/_draft-{uuid.uuid4().hex}"
        with fs.open_output_stream(draft) as out:
            out.write(json.dumps(files).encode())
        fs.move(draft, entry)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        fs, root = self._fs()
        for m in messages:
            if m is not None and m.file:
                fs.delete_file(f"{root}/{m.file}")


def read_ledger(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all batches in the ledger."""
    entries = spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(f"{path}/ledger").collect()
    files = [f"{path}/{name}" for r in entries for name in json.loads(r.value)]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def write_ledger(df: DataFrame, path: str, checkpoint: str):
    """Run a stream over all available input into the ledger at ``path``."""
    ship_package(df.sparkSession)
    df.sparkSession.dataSource.register(LedgerSink)
    q = (df.writeStream.format(FORMAT).option("path", path).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
