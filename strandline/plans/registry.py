"""Named queries: a callable over (spark, folder of tables), and SQL that gives the same rows where SQL can."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strandline.session import release, ship

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def keep(f: Query) -> Query:
            @functools.wraps(f)
            def run(spark: SparkSession, folder: str) -> DataFrame:
                ship(spark)
                release()  # what the query before kept
                return f(spark, folder)

            self.queries[name] = run
            if sql is not None:
                self.sql[name] = sql
            return f

        return keep
