"""Versioned tables: all tables of a run are written first, then one entry of the log makes them current together.

Of two writers who want the same version one makes it (commits.Files.create); the other looks at what happened meanwhile. What doesn't touch its tables or parts is none of its business, and it takes
the next version; a part that was written meanwhile is merged again; a table that was replaced, or rows that were judged by what they were before, are a Conflict of their run.

A table is whole, or dealt over parts by the hash of its keys. Parts are as many as its rows need (linear hashing: with n parts an address is the hash modulo the next power of two, or modulo the
one before if there is no such part), so an upsert reads and writes the parts that its rows touch and as many more as the table grows by. What is only ever added to (histories, events) is appended, at the cost of the new rows.
"""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .commits import Log

Merge = Callable[[DataFrame | None, DataFrame], DataFrame]


class Conflict(Exception):
    """Another writer changed what this run was computed from; run it again."""


def address(keys: list[str], parts: int) -> Column:
    """The part of a row, of so many."""
    h = F.pmod(F.xxhash64(*keys), F.lit(1 << 40))
    high = 1 << (parts - 1).bit_length()
    at = F.pmod(h, F.lit(high))
    return F.when(at < parts, at).otherwise(F.pmod(h, F.lit(max(1, high // 2)))).cast("int")


def split_of(part: int, parts: int) -> int:
    """The one of `parts` parts whose rows a later part takes over."""
    while part >= parts:
        part -= 1 << (part.bit_length() - 1)
    return part


class Catalog:
    def __init__(self, spark: SparkSession, root: str, part_rows: int = 1_000_000, snapshot_every: int = 20):
        self.spark, self.root, self.part_rows = spark, root.rstrip("/"), part_rows
        self.log = Log(spark, self.root, snapshot_every)

    def version(self) -> int:
        return self.log.version()

    def state(self, table: str, version: int | None = None) -> dict:
        return self.log.state(table, self.version() if version is None else version)

    def _read(self, paths: list[str]) -> DataFrame | None:
        return self.spark.read.parquet(*paths) if paths else None

    def read(self, table: str, version: int | None = None) -> DataFrame | None:
        """The table as of a version (the current one); None if it was never written."""
        state = self.state(table, version)
        return self._read(state["added"] + [p for p, _ in state["files"].values()])

    def added_since(self, table: str, after: int, upto: int | None = None) -> DataFrame | None:
        """What versions later than `after` appended to a table; None if nothing."""
        actions = self.log.actions(after, self.version() if upto is None else upto)
        return self._read([a["path"] for a in actions if a["table"] == table and a["kind"] == "added"])

    def folder(self, name: str) -> str:
        """A new folder for rows of a table; they are nothing to readers until commit adds it."""
        return f"{self.root}/data/{name}/{uuid.uuid4().hex}"

    def _written(self, name: str, df: DataFrame) -> str:
        path = self.folder(name)
        df.write.parquet(path)
        return path

    def commit(self, tables: dict[str, DataFrame], added: dict[str, DataFrame | list[str]] | None = None, upserts: dict[str, tuple[DataFrame, list[str], Merge]] | None = None, base: int | None = None, judged: tuple[str, ...] = (), attempts: int = 50) -> int:
        """Write the next version. tables are replaced, the rows of `added`, or of the folders it names, are appended. An upsert (rows, keys, merge) merges rows into the parts that they touch: merge(stored, rows)
        gets None for what isn't stored and returns the whole of those parts. If a write fails, nothing of the version is seen.

        base is the version that the caller read (the current one). Upserts are merged again into parts that were written since. Of the tables in `judged` the rows depend on
        what was stored: if another writer changed a row with one of their keys, that is a Conflict, as is a table to be replaced that was written since."""
        base = self.version() if base is None else base
        upserts = upserts or {}
        actions = [{"table": n, "kind": kind, "path": p} for kind, group in (("whole", tables), ("added", added or {})) for n, rows in group.items() for p in (rows if isinstance(rows, list) else [self._written(n, rows)])]
        at, made = base, {}
        for _ in range(attempts):
            now = self.version()
            since = self.log.actions(base, now) if now > base else []
            for n in tables:
                if any(a["table"] == n for a in since):
                    raise Conflict(f"{n} was written after version {base}")
            for n, (rows, keys, merge) in upserts.items():
                if n in judged and n in {a["table"] for a in since} and self._moved(n, rows, keys, base, now):
                    raise Conflict(f"rows of {n} changed after version {base}")
                if n not in made or self._overtaken(made[n], n, at, now):
                    made[n] = self._upsert(n, self.state(n, now), rows, keys, merge)
            at = now
            if self.log.publish(now + 1, actions + [a for a in made.values() if a]):
                return now + 1
            time.sleep(random.uniform(0, 0.05))
        raise Conflict(f"no version could be made in {attempts} attempts")

    def _overtaken(self, action: dict | None, table: str, at: int, now: int) -> bool:
        """Whether a prepared upsert rests on parts that versions after `at` have written."""
        if action is None:
            return False
        for a in self.log.actions(at, now):
            if a["table"] == table and (a["kind"] != "parts" or a["parts"] != action["parts"] or a["files"].keys() & action["files"].keys()):
                return True
        return False

    def _parts(self, state: dict, rows: DataFrame, keys: list[str]) -> list[str]:
        """Paths of the parts that may hold rows with these keys."""
        if not state["parts"]:
            return state["added"]
        touched = {str(r["p"]) for r in rows.select(address(keys, state["parts"]).alias("p")).distinct().collect()}  # parts at most
        return [p for k, (p, _) in state["files"].items() if k in touched]

    def touched(self, table: str, rows: DataFrame, keys: list[str], version: int) -> DataFrame | None:
        """The parts of a table, dealt by `keys`, that an upsert of rows would read; None if they hold nothing."""
        return self._read(self._parts(self.state(table, version), rows, keys))

    def _moved(self, table: str, rows: DataFrame, keys: list[str], base: int, now: int) -> bool:
        """Whether a row with one of these keys differs between two versions."""
        mine = rows.select(*keys).distinct()
        old, new = [self.touched(table, rows, keys, v) for v in (base, now)]
        if old is None or new is None:
            found = new if old is None else old
            return found is not None and not found.join(mine, keys, "left_semi").isEmpty()
        old, new = old.join(mine, keys, "left_semi"), new.join(mine, keys, "left_semi").select(*old.columns)
        return not (old.exceptAll(new).isEmpty() and new.exceptAll(old).isEmpty())

    def _upsert(self, name: str, state: dict, rows: DataFrame, keys: list[str], merge: Merge) -> dict | None:
        before = state["parts"]
        came = {r["p"]: r["n"] for r in rows.groupBy(address(keys, max(1, before)).alias("p")).agg(F.count("*").alias("n")).collect()}  # parts at most
        if not came:
            return None
        if before:
            held = sum(n for _, n in state["files"].values())
        else:
            held = self._read(state["added"]).count() if state["added"] else 0
        parts = max(1, before, -(-(held + sum(came.values())) // self.part_rows))
        grown = range(before, parts) if before else range(parts)
        touched = set(came) | {split_of(k, before) for k in grown} if before else set(grown)
        old = [p for k, (p, _) in state["files"].items() if int(k) in touched] if before else state["added"]
        path = self.folder(name)
        out = merge(self._read(old), rows).withColumn("__part", address(keys, parts))
        (out.coalesce(1) if parts == 1 and held + sum(came.values()) <= self.part_rows else out.repartition("__part")).write.partitionBy("__part").parquet(path)
        there = {r["p"]: r["n"] for r in self.spark.read.parquet(path).groupBy(F.col("__part").alias("p")).agg(F.count("*").alias("n")).collect()} if self._any(path) else {}
        return {"table": name, "kind": "parts", "parts": parts, "files": {str(k): [f"{path}/__part={k}", there[k]] if k in there else [None, 0] for k in sorted(touched | set(grown))}}

    def _any(self, path: str) -> bool:
        return any(n.startswith("__part=") for n in self.log.files.names(path))

    def compact(self, table: str, at_least: int = 2) -> int | None:
        """Put what was appended to a table into one folder, sharing its version with appends that happen meanwhile. None if there are fewer folders than at_least."""
        v = self.version()
        old = self.state(table, v)["added"]
        if len(old) < at_least:
            return None
        path = self._written(table, self._read(old))
        for _ in range(50):
            now = self.version()
            if any(a["table"] == table and a["kind"] != "added" for a in self.log.actions(v, now)):
                raise Conflict(f"{table} was rewritten after version {v}")
            if self.log.publish(now + 1, [{"table": table, "kind": "compacted", "removed": old, "path": path}]):
                return now + 1
        raise Conflict(f"no version could be made for {table}")
