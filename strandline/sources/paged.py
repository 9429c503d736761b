"""A paged REST listing as a Python data source (``format("paged_listing")``).

One partition, since each page names the next.  The fetching function is an
option by import path, so that tests and offline runs read saved pages.
"""

from __future__ import annotations

import importlib
import json
import os
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "video_id string, title string, published_at string"


def saved_page(folder: str, token: str | None) -> dict:
    """A page saved as <token>.json, the first one as first.json."""
    with open(os.path.join(folder, f"{token or 'first'}.json")) as f:
        return json.load(f)


class PagedListing(DataSource):
    """Options: ``folder`` (or what ``fetch`` needs), ``fetch`` (module:function), ``max_videos`` (checked after each page)."""

    @classmethod
    def name(cls) -> str:
        return "paged_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition) -> Iterator[tuple]:
        module, _, name = self.options.get("fetch", "strandline.sources.paged:saved_page").partition(":")
        fetch = getattr(importlib.import_module(module), name)
        most, seen, token = int(self.options.get("max_videos", 2**62)), 0, None
        while True:
            page = fetch(self.options.get("folder", ""), token)
            for x in page.get("items", []):
                seen += 1
                yield x.get("videoId"), x.get("title"), x.get("publishedAt")
            token = page.get("nextPageToken")
            if not token or seen >= most:
                return
