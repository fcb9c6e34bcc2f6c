"""Session settings and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

_SCRATCH: dict[str, str] = {}
_SHIPPED: set[str] = set()


def build_session(app: str = "folioframe", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators rely on; `conf` overrides any of them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.io.compression.codec": "zstd",  # shuffle files of large feeds are what fills the disk
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    _ship_package(session)
    return session


def _ship_package(spark: SparkSession) -> None:
    """Gives executors this package, which Python stages, state and feeds need; local ones have it already."""
    app = spark.sparkContext.applicationId
    if spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local" or app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='folioframe-')}/{root.name}", "zip", root.parent, root.name)
    spark.sparkContext.addPyFile(archive)  # the driver serves it
    _SHIPPED.add(app)


#: Whether Spark deletes a query's shuffle files when the query ends, and not when the driver happens to collect garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside go as each of them ends."""
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by `spark.checkpoint.dir`; a temporary one only where that is unset and all runs on one machine."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        _SCRATCH[app] = tempfile.mkdtemp(prefix="folioframe-")
        spark.sparkContext.setCheckpointDir(_SCRATCH[app])
    return _SCRATCH[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, under the shared folder."""
    return f"{scratch_root(spark)}/folioframe/{label}-{uuid.uuid4().hex}"
