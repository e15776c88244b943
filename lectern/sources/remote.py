"""Remote record services as a Python data source, for batches and for streams.

Requests lie in a folder as files of JSON lines, {"request": ...}, in the order of their names. The files are dealt over a bounded
number of partitions, which is how many requests are under way at once; a partition's requests go one after another, with a pause
between them, and a failed one is tried again after pauses that grow. A stream's offset is the name of the last file, so a restart
asks for nothing twice. No network is used here: the fetcher is a function of a request, and the one given reads saved answers.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from lectern.sources.fixture_source import with_retries

SCHEMA = "request string, answer string, error string, file string"
Fetch = Callable[[str], str]


class Slice(InputPartition):
    """Files that one task asks for, one after another."""

    def __init__(self, files: Sequence[str]):
        self.files = list(files)


def _listed(folder: str) -> list[str]:
    """Names of the request files of a folder, in order."""
    store, path = fs.FileSystem.from_uri(folder)
    return sorted(f.base_name for f in store.get_file_info(fs.FileSelector(path)) if f.is_file and f.base_name.endswith(".json"))


def _dealt(files: Sequence[str], parts: int) -> list[Slice]:
    return [Slice(files[k::parts]) for k in range(max(1, min(parts, len(files))))]


class _Asking:
    """What batch and stream readers have in common: asking for the requests of some files."""

    def __init__(self, fetch: Fetch, options: dict):
        self.folder = options["path"]
        self.parts = int(options.get("parts", 4))
        tries, pause, factor = int(options.get("tries", 4)), float(options.get("pause", 1.0)), float(options.get("factor", 2.0))
        self.between, self.ask = float(options.get("between", 0.0)), with_retries(fetch, tries, pause, factor)
        if self.parts < 1 or tries < 1:
            raise ValueError("parts and tries must be at least 1")

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(self.folder)
        for name in partition.files:
            with store.open_input_stream(f"{path}/{name}") as f:
                lines = f.read().decode().splitlines()
            rows = []
            for n, line in enumerate(x for x in lines if x.strip()):
                if n and self.between:
                    time.sleep(self.between)
                request = json.loads(line)["request"]
                rows.append((request, *self.ask(request), name))
            yield pa.RecordBatch.from_pydict({c: pa.array([r[k] for r in rows], pa.string()) for k, c in enumerate(("request", "answer", "error", "file"))})


def source_of(name: str, fetch: Fetch) -> type[DataSource]:
    """A data source of the given name that answers requests by fetch: register it with spark.dataSource.register.

    Options: path (the folder of requests), parts (requests under way at once), tries, pause and factor (of retries, in seconds),
    between (seconds from one request of a partition to the next).
    """

    class Batch(_Asking, DataSourceReader):
        def partitions(self) -> list[Slice]:
            return _dealt(_listed(self.folder), self.parts)

    class Stream(_Asking, DataSourceStreamReader):
        def initialOffset(self) -> dict:  # noqa: N802
            return {"until": ""}

        def latestOffset(self) -> dict:  # noqa: N802
            return {"until": max(_listed(self.folder), default="")}

        def partitions(self, start: dict, end: dict) -> list[Slice]:
            return _dealt([f for f in _listed(self.folder) if start["until"] < f <= end["until"]], self.parts)

        def commit(self, end: dict) -> None:
            """Nothing is held for a batch that is done."""

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return Batch(fetch, self.options)

        def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
            return Stream(fetch, self.options)

    return Source


def saved(folder: str) -> Fetch:
    """A fetcher over a folder that has the answer to each request in a file of that name."""

    def fetch(request: str) -> str:
        store, path = fs.FileSystem.from_uri(folder)
        with store.open_input_stream(f"{path}/{request}") as f:
            return f.read().decode()

    return fetch
