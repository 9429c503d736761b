"""Ordered scans over entities of any size.

A window over one entity puts all its rows into one task.  A :class:`Scan` cuts
each entity's order into buckets of its own axis, scans each bucket for itself,
and carries only one summary row per bucket across the cuts, so that an entity
that holds a third of all rows is spread like any other.

The rows are shuffled once, by (entity, bucket), for all steps of a scan.  What a
step computed is kept (in memory or on disk; lost parts are recomputed) until
``session.release``, since its summary and its result both need it; so nothing
below it runs twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.session import keep

#: Width of a bucket on the axis (seconds, for recordings).
BUCKET = 1800.0

_G, _B, _K = "__group", "__bucket", "__entity"


class Scan:
    """Rows in order of ``axis`` (nulls last), then ``order``, within each entity (``keys``; null keys are an entity too).

    ``order`` must make the order total; ties beyond it are resolved arbitrarily.
    """

    def __init__(self, df: DataFrame, keys: list[str], axis: str, order: list[str], width: float = BUCKET):
        self.keys = keys
        self.place = [F.col(axis).isNull(), F.col(axis), *[F.col(c) for c in order]]
        # rows without a place on the axis come last, in a bucket of their own
        bucket = F.coalesce(F.floor(F.col(axis) / F.lit(width)), F.lit(2**62)).cast("long")
        # one struct is the key of windows, summaries and joins alike, so that they share one partitioning; its parts may be null
        self.df = df.withColumn(_G, F.struct(*keys, bucket.alias(_B)))

    def _carry(self, scanned: DataFrame, summary: Column, across: Column, name: str, join) -> Scan:
        """Join to each row what the buckets before its own sum up to."""
        ends = scanned.groupBy(_G).agg(summary.alias("__end"))
        ends = ends.withColumn(_K, F.struct(*[F.col(f"{_G}.{k}").alias(k) for k in self.keys])).withColumn(_B, F.col(f"{_G}.{_B}"))
        ends = ends.select(_G, across.alias("__before"))
        joined = scanned.join(ends, _G, "left")
        self.df = joined.withColumn(name, join(F.col(name), F.col("__before"))).drop("__before")
        return self

    def previous(self, cols: list[str], name: str = "prev") -> Scan:
        """Add struct ``name`` of ``cols`` of the row just before; null for an entity's first row."""
        here = F.struct(*cols)
        own = W.partitionBy(_G).orderBy(*self.place)
        scanned = keep(self.df.withColumn(name, F.lag(here).over(own)))
        across = F.lag("__end").over(W.partitionBy(_K).orderBy(_B))
        return self._carry(scanned, F.max_by(here, F.struct(*self.place)), across, name, F.coalesce)

    def prefix(self, value: Column, how: str, inclusive: bool, name: str) -> Scan:
        """Add the running ``sum`` or ``max`` of ``value`` over the rows up to this one (``inclusive``) or before it.

        Null values don't count; where no value came yet, a sum is 0 and a maximum null.
        """
        zero = lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
        fold, join = {"sum": (F.sum, zero), "max": (F.max, F.greatest)}[how]
        own = W.partitionBy(_G).orderBy(*self.place).rowsBetween(W.unboundedPreceding, 0 if inclusive else -1)
        v = "__value"
        scanned = keep(self.df.withColumn(v, value).withColumn(name, fold(v).over(own)))
        across = fold("__end").over(W.partitionBy(_K).orderBy(_B).rowsBetween(W.unboundedPreceding, -1))
        self._carry(scanned, fold(v), across, name, join)
        self.df = self.df.drop(v)
        return self

    def runs(self, starts: Column, name: str = "run_no") -> Scan:
        """Add the number, from 1, of the run a row is in; a run begins where ``starts`` holds."""
        return self.prefix(F.coalesce(starts, F.lit(False)).cast("long"), "sum", True, name)

    def result(self) -> DataFrame:
        return self.df.drop(_G)


def with_previous(
    df: DataFrame, keys: list[str], axis: str, order: list[str], cols: list[str], width: float = BUCKET, name: str = "prev"
) -> DataFrame:
    """One step: the row just before.  See :meth:`Scan.previous`."""
    return Scan(df, keys, axis, order, width).previous(cols, name).result()
