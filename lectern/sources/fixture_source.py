"""A data source for remote record services: each request is a partition's work, retried with growing pauses.

No network is used here: the fetcher is a function of a request, and the one given reads a folder of saved answers.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def with_retries(fetch: Callable[[str], str], tries: int = 4, pause: float = 1.0, factor: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> Callable[[str], tuple[str | None, str | None]]:
    """(answer, error) of a request, tried again after pauses that grow by factor."""

    def run(request: str) -> tuple[str | None, str | None]:
        error = None
        for attempt in range(tries):
            try:
                return fetch(request), None
            except Exception as e:  # noqa: BLE001  whatever a service does, its row tells
                error = f"{type(e).__name__}: {e}"[:200]
                if attempt < tries - 1:
                    sleep(pause * factor**attempt)
        return None, error

    return run


def fetched(requests: DataFrame, fetch: Callable[[Sequence[str]], Sequence[tuple[str | None, str | None]]], column: str = "request", batch: int = 40) -> DataFrame:
    """requests with answer and error: rows go to fetch in batches, on the executors."""
    schema = StructType([*requests.schema.fields, StructField("answer", StringType()), StructField("error", StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                found = fetch(list(part[column]))
                yield part.assign(answer=[a for a, _ in found], error=[e for _, e in found])

    return requests.mapInPandas(run, schema)


def saved_answers(requests: DataFrame, saved: DataFrame, column: str = "request") -> DataFrame:
    """The same from a table of saved answers: (request, answer)."""
    return requests.join(saved, column, "left").withColumn("error", F.when(F.col("answer").isNull(), "no saved answer"))
