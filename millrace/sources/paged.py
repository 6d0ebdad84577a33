"""Paged APIs as a Spark data source: executors fetch the pages, Spark parses them.

The source yields ``page`` and ``payload`` (the page's JSON text); turn payloads into
rows with :func:`millrace.sources.nested.explode_records`.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from urllib.request import Request, urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Fetch = Callable[[str], str]


def http_fetch(headers: Mapping[str, str] | None = None, timeout: float = 60) -> Fetch:
    """A fetcher for URLs; a failed request fails the task, which Spark runs again."""
    sent = dict(headers or {})

    def fetch(url: str) -> str:
        with urlopen(Request(url, headers=sent), timeout=timeout) as response:
            return response.read().decode("utf-8")

    return fetch


class _Pages(InputPartition):
    def __init__(self, addresses: Sequence[str]):
        super().__init__(None)
        self.addresses = list(addresses)


class _PageReader(DataSourceReader):
    def __init__(self, groups: list[list[str]], fetch: Fetch, next_key: str | None):
        self.groups, self.fetch, self.next_key = groups, fetch, next_key

    def __getstate__(self) -> dict:
        return {**self.__dict__, "groups": []}  # tasks get their own addresses, not the whole list

    def partitions(self) -> Sequence[InputPartition]:
        return [_Pages(group) for group in self.groups]

    def read(self, partition: InputPartition) -> Iterator[tuple[str, str]]:
        for address in partition.addresses:
            while address:
                payload = self.fetch(address)
                yield address, payload
                address = self._following(payload)

    def _following(self, payload: str) -> str | None:
        page = json.loads(payload) if self.next_key else None
        return page.get(self.next_key) if isinstance(page, dict) else None


def read_pages(
    spark: SparkSession,
    addresses: Sequence[str],
    fetch: Fetch,
    *,
    next_key: str | None = None,
    pages_per_task: int = 1,
    name: str = "millrace_pages",
) -> DataFrame:
    """Read pages in parallel, ``pages_per_task`` addresses to a task.

    With ``next_key`` each address starts a chain that is followed through that field of
    the page until it is absent or empty. A chain can only be walked page by page, by one
    task; it holds one page at a time. Where the API can address pages directly, pass the
    addresses instead.
    """
    groups = [list(addresses[i : i + pages_per_task]) for i in range(0, len(addresses), pages_per_task)]

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "page string, payload string"

        def reader(self, schema) -> DataSourceReader:
            return _PageReader(groups, fetch, next_key)

    spark.dataSource.register(Paged)
    return spark.read.format(name).load()
