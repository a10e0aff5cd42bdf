"""A Python data source over landed listing pages: one partition a file, with retry, back-off and a rate limit."""

from __future__ import annotations

import glob
import json
import random
import time
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def with_retry(call: Callable, retries: int = 3, delay_s: float = 0.5, sleep: Callable[[float], None] = time.sleep):
    """The call's result after at most `retries` repeats; pauses double and vary by a quarter."""
    for k in range(retries + 1):
        try:
            return call()
        except Exception:
            if k == retries:
                raise
            sleep(delay_s * 2**k * random.uniform(0.75, 1.25))
    return None


class _Page(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class ListingPages(DataSource):
    """format("disclosure_listing"): options path (a glob), retries, pause_s. A page that stays unreadable is an error row."""

    @classmethod
    def name(cls) -> str:
        return "disclosure_listing"

    def schema(self) -> str:
        return "path string, cells array<string>, error string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Reader(dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [_Page(p) for p in sorted(glob.glob(self.options["path"]))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition is None:
            return
        time.sleep(float(self.options.get("pause_s", "0")))

        def load() -> dict:
            with open(partition.path, encoding="utf-8") as f:
                return json.load(f)

        try:
            page = with_retry(load, int(self.options.get("retries", "0")))
        except Exception as e:
            yield partition.path, None, str(e)
            return
        for cells in page.get("data") or []:
            yield partition.path, [None if c is None else str(c) for c in cells], None
