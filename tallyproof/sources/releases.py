"""Date partitions that change together: staged folders and the list that publishes them.

A write stores its partitions below ``data/release=<id>``, where no reader looks for them. Then one
small file below ``lists`` names, for every partition value, the release that holds it, and a reader
takes the newest list. That file is written under a hidden name and renamed to the next number,
which fails if another run took the number; so either all partitions of a run are seen or none, a
run that dies before the rename changes nothing, and of two runs at once one has to start over.

A list holds one short entry per partition value (a date), and the schema, so neither the newest
date nor the schema of a table needs a data file.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyproof.session import session_conf


@dataclass(frozen=True)
class Release:
    """State of a table: ``held`` maps a partition value, as in folder names, to its release."""

    number: int
    partition: str
    schema: T.StructType
    held: dict[str, str]
    # partitions that each release wrote, to tell a release that is live as a whole
    written: dict[str, int] = field(default_factory=dict)


def _files(spark: SparkSession, path: str) -> tuple:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, hidden ones left out; none if there is no such folder."""
    files, target = _files(spark, path)
    if not files.exists(target):
        return []
    names = [status.getPath().getName() for status in files.listStatus(target)]
    return sorted(n for n in names if not n.startswith((".", "_")))


def partition_values(spark: SparkSession, path: str, partition: str) -> list[str]:
    prefix = f"{partition}="
    return [n.removeprefix(prefix) for n in children(spark, path) if n.startswith(prefix)]


def _numbers(spark: SparkSession, path: str) -> list[int]:
    names = children(spark, f"{path}/lists")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def _list_path(path: str, number: int) -> str:
    return f"{path}/lists/{number:010d}.json"


def release(spark: SparkSession, path: str, number: int | None = None) -> Release | None:
    """The newest state, or that of a number; None where nothing was published."""
    if number is None:
        number = max(_numbers(spark, path), default=None)
    if number is None:
        return None
    files, target = _files(spark, _list_path(path, number))
    stream = files.open(target)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    parts = json.loads(text)
    schema = T.StructType.fromJson(parts["schema"])
    return Release(number, parts["partition"], schema, parts["held"], parts["written"])


def stage(df: DataFrame, path: str, partition: str) -> tuple[str, list[str]]:
    """Store ``df`` as a release that nobody sees yet; its id and its partition values."""
    name = uuid.uuid4().hex
    folder = f"{path}/data/release={name}"
    # Rebalancing gathers a date's rows and lets AQE cut an outsized date into several files.
    # Dates stay in their own files either way, so merging small tasks would only cost time.
    with session_conf(
        df.sparkSession, spark__sql__adaptive__coalescePartitions__enabled="false"
    ):
        df.hint("rebalance", partition).write.partitionBy(partition).parquet(folder)
    return name, partition_values(df.sparkSession, folder, partition)


def publish(spark: SparkSession, path: str, state: Release) -> Release:
    """Make ``state`` the newest one; raises if its number is taken."""
    text = json.dumps(
        {"partition": state.partition, "schema": state.schema.jsonValue(),
         "held": state.held, "written": state.written}, sort_keys=True,
    )
    files, final = _files(spark, _list_path(path, state.number))
    _, hidden = _files(spark, f"{path}/lists/.{uuid.uuid4().hex}")
    stream = files.create(hidden)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.getUri(), spark._jsc.hadoopConfiguration()
    )
    # without an option this rename never replaces a file
    plain = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(hidden, final, plain)
    except Exception as error:
        files.delete(hidden, False)
        raise RuntimeError(f"another run published release {state.number} of {path}") from error
    return state


def replace(
    df: DataFrame,
    path: str,
    partition: str,
    base: Release | None,
    drop: Iterable[str] = (),
) -> tuple[Release, list[str]]:
    """Publish the partitions of ``df`` over those of ``base``, without the values in ``drop`` that
    ``df`` does not bring; the new state and the values brought."""
    name, values = stage(df, path, partition)
    held = {v: r for v, r in (base.held if base else {}).items() if v not in set(drop)}
    held |= dict.fromkeys(values, name)
    written = {r: n for r, n in (base.written if base else {}).items() if r in held.values()}
    if values:
        written[name] = len(values)
    columns = [f for f in df.schema.fields if f.name != partition]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in [*columns, df.schema[partition]]])
    taken = max(_numbers(df.sparkSession, path), default=0)
    # a full refresh follows whatever is there; a change of ``base`` must be the next one after it
    number = (base.number if base else taken) + 1
    return publish(df.sparkSession, path, Release(number, partition, schema, held, written)), values


def without(spark: SparkSession, path: str, base: Release, values: Iterable[str]) -> int:
    """Publish ``base`` without the given values; how many of them it held."""
    gone = set(values) & set(base.held)
    if gone:
        held = {v: r for v, r in base.held.items() if v not in gone}
        written = {r: n for r, n in base.written.items() if r in held.values()}
        publish(spark, path, Release(base.number + 1, base.partition, base.schema, held, written))
    return len(gone)


def read(spark: SparkSession, path: str, state: Release) -> DataFrame:
    """The rows of a state. Releases that are live as a whole are read as one folder."""
    live = Counter(state.held.values())
    whole = {r for r, n in live.items() if state.written.get(r) == n}
    folders = [f"{path}/data/release={r}" for r in sorted(whole)]
    folders += [
        f"{path}/data/release={r}/{state.partition}={v}"
        for v, r in sorted(state.held.items()) if r not in whole
    ]
    if not folders:
        return spark.createDataFrame([], state.schema)
    reader = spark.read.schema(state.schema).option("basePath", f"{path}/data")
    return reader.parquet(*folders).select(*[f"`{c}`" for c in state.schema.names])


def expire(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove the lists before the last ``keep`` and the releases that no kept list names.

    Runs that are still staging must have ended: what they stored is not listed yet.
    """
    numbers = _numbers(spark, path)
    kept = {r for n in numbers[-keep:] for r in release(spark, path, n).held.values()}
    for number in numbers[:-keep]:
        files, target = _files(spark, _list_path(path, number))
        files.delete(target, False)
    gone = [n for n in children(spark, f"{path}/data") if n.removeprefix("release=") not in kept]
    for name in gone:
        files, target = _files(spark, f"{path}/data/{name}")
        files.delete(target, True)
    return len(gone)
