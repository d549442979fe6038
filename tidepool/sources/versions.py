"""Tables published by version (S4): data folders plus a manifest that is swapped last.

A writer puts its files into new folders and then publishes a small JSON manifest that names
them, by renaming it to the next version number. Readers take the newest manifest, so they
see a version whole or not at all, also while a rebuild runs or after it failed. Folders
that no kept manifest names are removed by :func:`retire`.

One writer at a time is expected; of two that race for a version number the second fails
and leaves nothing visible. The rename must be atomic, as on a distributed file system.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MANIFESTS = "_manifests"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Published versions, oldest first."""
    p, fs = _fs(spark, f"{path}/{MANIFESTS}")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n.removesuffix(".json")) for n in names if n[0].isdigit())


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """The newest manifest (or a given one); None before the first."""
    known = versions(spark, path)
    if not known:
        return None
    name = f"{path}/{MANIFESTS}/{version or known[-1]:012d}.json"
    return json.loads(spark.read.text(name, wholetext=True).first()[0])


def publish(spark: SparkSession, path: str, content: dict) -> int:
    """Make ``content`` the newest manifest; returns its version."""
    version = (versions(spark, path) or [0])[-1] + 1
    target, fs = _fs(spark, f"{path}/{MANIFESTS}/{version:012d}.json")
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFESTS}/_{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    if fs.exists(target) or not fs.rename(draft, target):
        raise RuntimeError(f"version {version} of {path} was published by another writer")
    return version


def write_data(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Write ``df`` into a new data folder of the table (not visible yet); its name."""
    name = f"data/{uuid.uuid4().hex}"
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(f"{path}/{name}")
    return name


def read_data(spark: SparkSession, path: str, names: list[str], schema: StructType) -> DataFrame:
    reader = spark.read.schema(schema)
    return reader.parquet(*[f"{path}/{n}" for n in names]) if names else spark.createDataFrame(
        [], schema)


def replace_table(df: DataFrame, path: str, partition_by: str | None = None) -> int:
    """Full rebuild of a table as its next version (S4 with an atomic switch)."""
    name = write_data(df, path, partition_by)
    return publish(df.sparkSession, path, {"folders": [name], "schema": df.schema.jsonValue()})


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version of a table written by :func:`replace_table`, or a kept one."""
    m = manifest(spark, path, version)
    if m is None:
        raise FileNotFoundError(f"no version of {path} is published")
    return read_data(spark, path, m["folders"], StructType.fromJson(m["schema"]))


def _named(content) -> set[str]:
    if isinstance(content, str):
        return {content} if content.startswith("data/") else set()
    items = content.values() if isinstance(content, dict) else content if isinstance(
        content, list) else ()
    return set().union(*[_named(x) for x in items])


def retire(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove all but the last ``keep`` manifests, then the folders that none of those
    names; returns the number of folders removed. Readers of the kept versions go on; run
    it when no writer is between its data and its manifest."""
    known = versions(spark, path)
    for v in known[:-keep]:
        p, fs = _fs(spark, f"{path}/{MANIFESTS}/{v:012d}.json")
        fs.delete(p, False)
    used = set().union(*[_named(manifest(spark, path, v)) for v in known[-keep:]])
    data, fs = _fs(spark, f"{path}/data")
    removed = 0
    for s in fs.listStatus(data) if fs.exists(data) else ():
        if f"data/{s.getPath().getName()}" not in used:
            fs.delete(s.getPath(), True)
            removed += 1
    return removed
