"""Session settings and the shared folder used for frozen intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "tallyproof", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC time and adaptive execution; the caller's ``conf`` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Every window bound and time bucket of this package is a UTC instant."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names for checkpoints.

    Only a local master, whose executors are this process, gets a fresh one where none is set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that the driver and all executors share"
            )
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run writes to."""
    path = f"{shared_folder(spark)}/tallyproof-{label}-{uuid.uuid4().hex}"
    for made in _open_blocks:
        made.append(path)
    return path


_open_blocks: list[list[str]] = []


@contextmanager
def stored_copies(spark: SparkSession) -> Iterator[list[str]]:
    """Release, at the end of the block, every copy stored inside it.

    Results must have been written or collected by then, as a DataFrame over a copy reads it. The
    block yields the paths, so a caller may also keep some by removing them from the list.
    """
    made: list[str] = []
    _open_blocks.append(made)
    try:
        yield made
    finally:
        _open_blocks.remove(made)
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in made:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)


def require_utc(spark: SparkSession) -> None:
    """Days and hours of this package are UTC; another session zone would shift them silently."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone is {zone}; set it to UTC")


@contextmanager
def session_conf(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Set options while expressions are resolved, then put the caller's values back."""
    names = {key.replace("__", "."): value for key, value in conf.items()}
    before = {key: spark.conf.get(key, None) for key in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
