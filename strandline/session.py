"""Session settings and the shared folder that checkpoints are written to."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "strandline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume; existing settings win on a cluster."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for k, v in {**defaults, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where it is unset (tests, local mode) a temporary folder is set.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if at:
        return at
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    at = "file://" + os.path.join(tempfile.gettempdir(), f"strandline-{os.getpid()}")
    spark.conf.set("spark.checkpoint.dir", at)
    return at


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    at = shared_dir(df.sparkSession)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(at)
    return df.checkpoint()


def width(df: DataFrame) -> int:
    """Tasks for work that is heavy for its bytes: the session's number of shuffle partitions.

    AQE joins small partitions by their bytes, which leaves the cores idle where
    each row costs much; it doesn't do so where the number is given.
    """
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def small_enough(df: DataFrame, most: int) -> bool:
    """True if ``df`` has at most ``most`` rows; counts no more than ``most`` + 1 of them."""
    return df.select(df.columns[0]).limit(most + 1).count() <= most


def keep(df: DataFrame) -> DataFrame:
    """Keep what a plan uses several times, in memory or on disk, until :func:`release`; lost parts are computed again."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    _KEPT.append(df)
    return df


def release() -> None:
    """Let go of everything kept.  Plans that are still to run compute it again."""
    while _KEPT:
        _KEPT.pop().unpersist()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application, for clusters whose workers don't have it on their path."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    root = os.path.dirname(os.path.abspath(__file__))
    at = os.path.join(tempfile.mkdtemp(), "strandline.zip")  # the driver's own copy; executors fetch it from the driver
    with zipfile.ZipFile(at, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("strandline", os.path.relpath(full, root)))
    sc.addPyFile(at)


_SHIPPED: set[str] = set()
_KEPT: list[DataFrame] = []
