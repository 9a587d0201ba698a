"""A paged interface as a Python data source: one partition per leaf (say, a document type), each read page by page.

What fetches a page is an importable function `module:name` of (leaf, offset, limit) that returns rows, so that the source runs against a service, a folder or a
fixture alike. Registered as format "paged".
"""

from __future__ import annotations

import importlib
import json

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Leaf(InputPartition):
    def __init__(self, value: str):
        self.value = value


class PagedReader(DataSourceReader):
    def __init__(self, options: dict, fields: list[str]):
        self.leaves = json.loads(options["leaves"])
        self.fetch, self.limit, self.fields = options["fetch"], int(options.get("limit", "1000")), fields

    def partitions(self):
        return [Leaf(x) for x in self.leaves]

    def read(self, partition):
        module, name = self.fetch.split(":")
        fetch = getattr(importlib.import_module(module), name)
        offset = 0
        while True:
            rows = fetch(partition.value, offset, self.limit)
            for row in rows:
                yield tuple(row.get(f) for f in self.fields)
            if len(rows) < self.limit:
                return
            offset += len(rows)


class PagedSource(DataSource):
    """Options: leaves (JSON list), fetch (module:function), limit (rows a page). The schema must be given."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self):
        raise ValueError("give the schema of the rows")

    def reader(self, schema):
        return PagedReader(self.options, [f.name for f in schema.fields])
