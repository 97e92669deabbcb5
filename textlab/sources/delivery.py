"""One commit for everything a run hands over (K2-K5).

A run writes into a folder of its own; a manifest that names its tables is
written last, under the next number, by a rename that fails where the number
is taken.  Readers follow the newest manifest, so they see the former run whole
until the new one is complete, and a run that dies half-way is never seen.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

MANIFESTS, RUNS = "_manifests", "_runs"


class Delivery:
    """The folder of one run, to be committed when all of it is written."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self.run = uuid.uuid4().hex
        self.tables: dict[str, dict] = {}

    def path(self, name: str, **about) -> str:
        """Where the run writes ``name``; what is known about it goes into the manifest."""
        self.tables.setdefault(name, {"path": f"{RUNS}/{self.run}/{name}"}).update(about)
        return f"{self.folder}/{RUNS}/{self.run}/{name}"

    def commit(self, **about) -> int:
        """Write the manifest; returns its number.  Raises where another run took the number meanwhile."""
        fs, at = _files(self.spark, self.folder)
        number = max(_numbers(fs, at, self.folder), default=0) + 1
        body = json.dumps({"run": self.run, "tables": self.tables, **about}, sort_keys=True)
        draft, final = at(f"{self.folder}/{RUNS}/{self.run}/_manifest"), at(f"{self.folder}/{MANIFESTS}/{number:012d}.json")
        fs.mkdirs(final.getParent())
        out = fs.create(draft, True)
        out.write(bytearray(body.encode()))
        out.close()
        if fs.exists(final) or not fs.rename(draft, final):
            raise RuntimeError(f"{self.folder}: another run delivered at the same time")
        return number


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark._jsc.hadoopConfiguration()), path


def _numbers(fs, at, folder: str) -> list[int]:
    listed = at(f"{folder}/{MANIFESTS}")
    if not fs.exists(listed):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(listed))
    return [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]


def manifest(spark: SparkSession, folder: str) -> dict:
    """The newest complete run: its id, tables and whatever was told at its commit."""
    folder = folder.rstrip("/")
    fs, at = _files(spark, folder)
    numbers = _numbers(fs, at, folder)
    if not numbers:
        raise FileNotFoundError(f"{folder}: nothing was delivered")
    text = spark.read.text(f"{folder}/{MANIFESTS}/{max(numbers):012d}.json", wholetext=True).first()["value"]
    return {**json.loads(text), "number": max(numbers)}


def delivered(spark: SparkSession, folder: str, name: str) -> str:
    """Where the newest complete run has ``name``."""
    tables = manifest(spark, folder)["tables"]
    if name not in tables:
        raise FileNotFoundError(f"{folder}: the newest run has no {name}, but {', '.join(sorted(tables))}")
    return f"{folder.rstrip('/')}/{tables[name]['path']}"


def drop_former(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Delete the runs and manifests before the newest ``keep``, and runs that were never committed; returns the runs deleted.

    To be called when no run is being written and no reader is on an old one.
    """
    folder = folder.rstrip("/")
    fs, at = _files(spark, folder)
    numbers = sorted(_numbers(fs, at, folder))
    kept = set()
    for n in numbers[-keep:]:
        text = spark.read.text(f"{folder}/{MANIFESTS}/{n:012d}.json", wholetext=True).first()["value"]
        kept.add(json.loads(text)["run"])
    for n in numbers[:-keep]:
        fs.delete(at(f"{folder}/{MANIFESTS}/{n:012d}.json"), False)
    runs = at(f"{folder}/{RUNS}")
    gone = [s.getPath().getName() for s in fs.listStatus(runs)] if fs.exists(runs) else []
    gone = [run for run in gone if run not in kept]
    for run in gone:
        fs.delete(at(f"{folder}/{RUNS}/{run}"), True)
    return gone
