"""Session factory and small helpers that every module shares."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def session(cpus: int | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A local session with UTC, ANSI mode and adaptive execution.

    On a cluster the session comes from the submitter; nothing in the library
    depends on having made it.
    """
    cpus = cpus or int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver did.

    Elsewhere the package is installed or sent with --py-files, as usual.
    """
    root = str(Path(__file__).resolve().parents[1])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables as a lazy scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors and the driver reach: spark.checkpoint.dir.

    Only on one machine (a local master, as in tests) a missing setting gets a
    temporary folder, kept for the session; a cluster without one is an error,
    as each executor would write to a disk of its own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors and the driver reach")
        found = "file://" + tempfile.mkdtemp(prefix="gaugework-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Work folders of the scratch block that is open, if one is.
_SCRATCH: list[list[str]] = []


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/gaugework/{name}-{uuid.uuid4().hex}"


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one call, below the shared one; it stays unless a scratch block holds the call."""
    path = _folder(spark, name)
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes, at the end, every work folder made inside: what is to last must be written elsewhere before."""
    from gaugework.sources.store import Store

    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            Store(spark, path).remove(path)


_KEPT: dict[tuple[str, str], str] = {}


def kept(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A frame that is written to the shared folder the first time a session asks for it, and read from there."""
    key = (spark.sparkContext.applicationId, name)
    if key not in _KEPT:
        path = _folder(spark, "kept")
        make().write.parquet(path)
        _KEPT[key] = path
    return spark.read.parquet(_KEPT[key])
