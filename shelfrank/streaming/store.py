"""Tables that are replaced part by part while others read them.

A store is a folder of immutable Parquet folders and a log of numbered small files, each of which lists the folders that
make up one version. A version appears all at once: its file is written beside the log and renamed into it, which fails if
another writer was first. A reader looks at the log once and then reads folders that nobody changes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Layers of a snapshot above which reading merges too much; the next one is then written whole.
MOST_LAYERS = 8
#: Runs of one level that are merged into one of the next.
FANOUT = 4
#: Times that a writer tries again after another one was first.
TRIES = 5


class Conflict(RuntimeError):
    """Another writer has added the version first."""


class VersionLog:
    """Numbered files ``log/<number>.json``; the highest is the current version."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._files = self._path("log").getFileSystem(self._conf)

    def _path(self, name: str) -> Any:
        return self._jvm.Path(f"{self.root}/{name}")

    def numbers(self) -> list[int]:
        if not self._files.exists(self._path("log")):
            return []
        names = [f.getPath().getName() for f in self._files.listStatus(self._path("log"))]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, number: int | None = None) -> tuple[int, dict]:
        """Number and content of a version, the current one unless said; (0, {}) before the first."""
        if number is None:
            number = max(self.numbers(), default=0)
        if not number:
            return 0, {}
        stream = self._files.open(self._path(f"log/{number:012d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return number, json.loads(text)

    def commit(self, number: int, content: dict) -> None:
        """Add a version; ``Conflict`` if its number is taken."""
        there = self._path(f"log/{number:012d}.json")
        beside = self._path(f"log/_{uuid.uuid4().hex}")
        out = self._files.create(beside, True)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        gateway = self.spark.sparkContext._gateway
        plain = gateway.new_array(getattr(self._jvm, "Options$Rename"), 0)
        try:
            self._jvm.FileContext.getFileContext(there.toUri(), self._conf).rename(beside, there, plain)
        except Exception as error:
            self._files.delete(beside, False)
            if self._files.exists(there):
                raise Conflict(f"version {number} of {self.root} is taken") from error
            raise

    def fresh(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex}"

    def drop(self, folder: str) -> None:
        self._files.delete(self._jvm.Path(folder), True)

    def forget(self, keep: int, folders: Callable[[dict], set[str]]) -> None:
        """Remove all but the last ``keep`` versions and the folders that only they list."""
        numbers = self.numbers()
        old, kept = numbers[:-keep], numbers[-keep:]
        needed = set().union(*(folders(self.read(n)[1]) for n in kept)) if kept else set()
        for n in old:
            for folder in folders(self.read(n)[1]) - needed:
                self.drop(folder)
            self._files.delete(self._path(f"log/{n:012d}.json"), False)


# ---- recommendation lists --------------------------------------------------------------------


class SnapshotStore:
    """Stored lists of which some users' rows are replaced at a time.

    The first layer holds all users; each further one holds the new rows of some users and, apart, the list of those users,
    so that a user may also lose all rows. A user's rows are those of the last layer that lists the user.
    """

    def __init__(self, spark: SparkSession, root: str, most_layers: int = MOST_LAYERS):
        self.spark, self.log, self.most_layers = spark, VersionLog(spark, root), most_layers

    def _layers(self, number: int | None = None) -> tuple[int, list[dict], str]:
        number, content = self.log.read(number)
        return number, content.get("layers", []), content.get("schema", "")

    def publish(self, rows: DataFrame) -> int:
        """Replace everything; returns the version."""
        return self._add(rows, None)

    def replace(self, rows: DataFrame, users: DataFrame) -> int:
        """Replace the rows of ``users`` (user_id) by ``rows``, which holds rows of these users only; returns the version."""
        return self._add(rows, users)

    def _add(self, rows: DataFrame, users: DataFrame | None) -> int:
        layer = {"rows": self.log.fresh("rows"), "users": None}
        rows.write.parquet(layer["rows"])
        if users is not None:
            layer["users"] = self.log.fresh("users")
            users.select("user_id").distinct().write.parquet(layer["users"])
        schema = rows.schema.json()
        for _ in range(TRIES):
            number, layers, _ = self._layers()
            if users is not None and not layers:
                raise ValueError("nothing is published yet")
            layers = [*layers, layer] if users is not None else [layer]
            try:
                self.log.commit(number + 1, {"layers": layers, "schema": schema})
            except Conflict:
                continue
            if len(layers) > self.most_layers:
                return self.compact()
            return number + 1
        raise Conflict(f"other writers of {self.log.root} were first {TRIES} times")

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a version, the current one unless said. What it reads is not changed by later versions."""
        from pyspark.sql.types import StructType

        number, layers, schema = self._layers(number)
        if not layers:
            raise ValueError("nothing is published yet")
        read = self.spark.read.schema(StructType.fromJson(json.loads(schema)))
        parts = [read.parquet(x["rows"]).withColumn("_layer", F.lit(n)) for n, x in enumerate(layers)]
        rows = reduce(DataFrame.unionByName, parts)
        if len(layers) == 1:
            return rows.drop("_layer")
        kind = f"user_id {rows.schema['user_id'].dataType.simpleString()}"
        lists = [
            self.spark.read.schema(kind).parquet(x["users"]).withColumn("_last", F.lit(n))
            for n, x in enumerate(layers)
            if x["users"]
        ]
        last = reduce(DataFrame.unionByName, lists).groupBy("user_id").agg(F.max("_last").alias("_last"))
        # the replaced users are few beside the rows: adaptive execution broadcasts them where they are
        joined = rows.join(last, "user_id", "left")
        return joined.where(F.col("_layer") == F.coalesce("_last", F.lit(0))).drop("_layer", "_last")

    def compact(self) -> int:
        """Write the current rows as one layer; a version added meanwhile makes it start again."""
        for _ in range(TRIES):
            number, layers, schema = self._layers()
            if len(layers) < 2:
                return number
            layer = {"rows": self.log.fresh("rows"), "users": None}
            self.read(number).write.parquet(layer["rows"])
            try:
                self.log.commit(number + 1, {"layers": [layer], "schema": schema})
                return number + 1
            except Conflict:
                self.log.drop(layer["rows"])
        raise Conflict(f"other writers of {self.log.root} were first {TRIES} times")

    def vacuum(self, keep: int = 2) -> None:
        """Remove folders that none of the last ``keep`` versions lists; who still reads an older one loses it."""
        self.log.forget(keep, lambda c: {f for x in c.get("layers", []) for f in (x["rows"], x["users"]) if f})


# ---- partial sums ----------------------------------------------------------------------------


class SumStore:
    """Partial sums per key, added batch by batch and merged level by level.

    A batch is a run of level 0; ``FANOUT`` runs of a level are merged into one of the next, so after n batches a reader
    adds at most (FANOUT - 1) * (1 + log n) runs, and a sum is rewritten as often as there are levels. A batch that is
    repeated after a failure is known by its number and adds nothing.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], value: str, fanout: int = FANOUT):
        self.spark, self.log, self.keys, self.value, self.fanout = spark, VersionLog(spark, root), keys, value, fanout

    def runs(self) -> list[dict]:
        return self.log.read()[1].get("runs", [])

    def add(self, sums: DataFrame, batch_id: int) -> None:
        """Add a batch's sums, one row per key, unless it is already there."""
        number, content = self.log.read()
        if content.get("last", -1) >= batch_id:
            return
        run = {"rows": self.log.fresh("run"), "level": 0}
        sums.write.parquet(run["rows"])
        content = {"runs": [*content.get("runs", []), run], "last": batch_id, "schema": sums.schema.json()}
        self.log.commit(number + 1, content)
        while self._merge():
            pass
        self.log.forget(2, lambda c: {r["rows"] for r in c.get("runs", [])})

    def _merge(self) -> bool:
        """Merge the runs of the lowest level that is full."""
        number, content = self.log.read()
        runs = content["runs"]
        full = [n for n in {r["level"] for r in runs} if sum(r["level"] == n for r in runs) >= self.fanout]
        if not full:
            return False
        level = min(full)
        merged = {"rows": self.log.fresh("run"), "level": level + 1}
        self._sum([r for r in runs if r["level"] == level]).write.parquet(merged["rows"])
        rest = [r for r in runs if r["level"] != level]
        self.log.commit(number + 1, content | {"runs": [merged, *rest]})
        return True

    def _sum(self, runs: list[dict]) -> DataFrame:
        from pyspark.sql.types import StructType

        schema = StructType.fromJson(json.loads(self.log.read()[1]["schema"]))
        rows = self.spark.read.schema(schema).parquet(*[r["rows"] for r in runs])
        return rows.groupBy(*self.keys).agg(F.sum(self.value).alias(self.value)).select(*schema.names)

    def read(self) -> DataFrame | None:
        """One row per key over all batches; None before the first."""
        runs = self.runs()
        return self._sum(runs) if runs else None
