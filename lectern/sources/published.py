"""A sink that publishes a whole write or nothing: a Python data source writer over Parquet files and a list of those that count.

Each task writes one file under a new name; only when all tasks are done the driver adds a version, a small file that names the data files
and the batches that the table is made of. Readers take the last version's files, and read them by Spark's own scan. What a failed write
has left is in no version. A batch that is written again under its number adds nothing.

Modes: overwrite makes the table anew, append adds to it. One writer at a time; versions are kept.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "lectern_published"


@dataclass
class Written(WriterCommitMessage):
    """The files of a task."""

    files: list[str]


class Versions:
    """The versions of a table's folder, which driver and executors share."""

    def __init__(self, path: str):
        self.store, self.root = fs.FileSystem.from_uri(path)
        self.uri = path.rstrip("/")

    def last(self) -> tuple[int, dict]:
        found = self.store.get_file_info(fs.FileSelector(f"{self.root}/versions", allow_not_found=True))
        names = sorted(f.base_name for f in found if f.base_name.endswith(".json") and f.base_name[:8].isdigit())
        if not names:
            return 0, {"files": [], "batches": []}
        with self.store.open_input_stream(f"{self.root}/versions/{names[-1]}") as f:
            return int(names[-1][:8]), json.loads(f.read())

    def publish(self, number: int, version: dict) -> None:
        self.store.create_dir(f"{self.root}/versions", recursive=True)
        draft = f"{self.root}/versions/draft-{uuid.uuid4().hex}"
        with self.store.open_output_stream(draft) as f:
            f.write(json.dumps(version).encode())
        self.store.move(draft, f"{self.root}/versions/{number:08d}.json")

    def drop(self, files: list[str]) -> None:
        for name in files:
            self.store.delete_file(f"{self.root}/data/{name}")


class Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.batch, self.overwrite = options["path"], options.get("batch"), overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        table, name, out = Versions(self.path), f"{uuid.uuid4().hex}.parquet", None
        try:
            for batch in iterator:
                if out is None:
                    table.store.create_dir(f"{table.root}/data", recursive=True)
                    out = pq.ParquetWriter(f"{table.root}/data/{name}", batch.schema, filesystem=table.store, compression="zstd")
                out.write_batch(batch)
        finally:
            if out is not None:
                out.close()
        return Written([name] if out is not None else [])

    def commit(self, messages: list[Written | None]) -> None:
        table, new = Versions(self.path), [f for m in messages if m for f in m.files]
        number, version = table.last()
        if self.batch is not None and self.batch in version["batches"] and not self.overwrite:
            table.drop(new)
            return
        files, batches = ([], []) if self.overwrite else (version["files"], version["batches"])
        table.publish(number + 1, {"files": files + new, "batches": batches + ([self.batch] if self.batch is not None else [])})

    def abort(self, messages: list[Written | None]) -> None:
        Versions(self.path).drop([f for m in messages if m for f in m.files])


class Published(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options, overwrite)


def publish(df: DataFrame, path: str, mode: str = "overwrite", batch: str | int | None = None) -> None:
    """Write df to the table at path (a URI of the shared folder) as one version. batch: with append, a number under which a second write
    adds nothing."""
    df.sparkSession.dataSource.register(Published)
    writer = df.write.format(FORMAT).option("path", path).mode(mode)
    (writer if batch is None else writer.option("batch", str(batch))).save()


def read_published(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table's last version, by Spark's scan of its files."""
    table = Versions(path)
    files = [f"{table.uri}/data/{f}" for f in table.last()[1]["files"]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def delete_published(spark: SparkSession, path: str, schema: str, condition: Column) -> None:
    """A version without the rows that meet the condition; the batches that it was made of stay known."""
    batches = Versions(path).last()[1]["batches"]
    publish(read_published(spark, path, schema).filter(~F.coalesce(condition, F.lit(False))), path)
    number, version = Versions(path).last()
    Versions(path).publish(number + 1, version | {"batches": batches})
