"""Tables as immutable directories behind one pointer file.

Every write makes a new directory; then the pointer file, which says which directories make up which
partition of which table of which schema, is replaced in one rename. A partitioned table names the SQL
expressions that give a row's partition; replacing a partition writes that one only and leaves the
others' directories where they are. Cloning a schema copies pointers; swapping two schemas is one
replacement, so readers see all of a build or nothing. One writer at a time.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cabstrata.operators import upsert

#: Appended directories of one size class in a partition beyond which they are written as one.
COMPACT_AT = 64
#: The partition of rows for which an expression is null.
NONE = "none"
#: Between the values of several expressions in a partition's key.
SEP = "|"

Keys = Iterable[str] | Callable[[str], bool] | None


def _chosen(keys: Keys) -> Callable[[str], bool]:
    if keys is None:
        return lambda k: True
    return keys if callable(keys) else frozenset(keys).__contains__


def _level(d: str) -> int:
    return int(re.search(r"/[0-9a-f]{32}-(\d+)", d)[1])


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._conf = spark._jsc.hadoopConfiguration()
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._pointer = self._path(f"{self.root}/_pointer.json")
        self._fs = self._pointer.getFileSystem(self._conf)

    # The pointer file.

    def _load(self) -> dict:
        if not self._fs.exists(self._pointer):
            return {"schemas": {}, "pending": {}, "streams": {}}
        s = self._fs.open(self._pointer)
        try:
            return json.loads(bytes(s.readAllBytes()).decode())
        finally:
            s.close()

    def _store(self, state: dict) -> None:
        tmp = self._path(f"{self.root}/_pointer-{uuid.uuid4().hex}")
        out = self._fs.create(tmp, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        jvm = self.spark._jvm
        overwrite = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        opts = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        opts[0] = overwrite
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._pointer.toUri(), self._conf).rename(tmp, self._pointer, opts)

    def _table(self, schema: str, table: str) -> dict:
        t = self._load()["schemas"].get(schema, {}).get(table)
        if not t:
            raise LookupError(f"no table {schema}.{table}")
        return t

    def schemas(self) -> list[str]:
        return sorted(self._load()["schemas"])

    def tables(self, schema: str) -> list[str]:
        return sorted(self._load()["schemas"].get(schema, {}))

    def exists(self, schema: str, table: str) -> bool:
        return table in self._load()["schemas"].get(schema, {})

    def parts(self, schema: str, table: str, keys: Keys = None) -> set[str]:
        """The keys of a table's partitions, from the pointer file alone; none if there is no such table."""
        t = self._load()["schemas"].get(schema, {}).get(table)
        return {k for k in t["parts"] if _chosen(keys)(k)} if t else set()

    def part_directories(self, schema: str, table: str) -> dict[str, list[str]]:
        """The directories of each partition; none if there is no such table."""
        return self._load()["schemas"].get(schema, {}).get(table, {"parts": {}})["parts"]

    def latest(self, schema: str, table: str, most: int = 16) -> set[str]:
        """The keys of the partitions written last, from the pointer file; those of one step belong together."""
        written = self._table(schema, table).get("written", {})
        steps = sorted(set(written.values()), reverse=True)
        out: set[str] = set()
        for t in steps:
            out |= {k for k, x in written.items() if x == t}
            if len(out) >= most:
                break
        return out

    def pending(self, name: str) -> set[str]:
        """What earlier runs have left to be done."""
        return set(self._load()["pending"].get(name, []))

    def settle(self, name: str) -> None:
        state = self._load()
        state["pending"].pop(name, None)
        self._store(state)

    # Reading and writing.

    def _scan(self, t: dict, dirs: list[str]) -> DataFrame:
        kind = StructType.fromJson(t["columns"])
        if not dirs:
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).parquet(*[f"{self.root}/{d}" for d in dirs])

    def read(self, schema: str, table: str, keys: Keys = None) -> DataFrame:
        """The table, or its partitions of these keys (a set or a predicate): the others' directories are
        never listed. Columns that came later are null in older directories."""
        t, ok = self._table(schema, table), _chosen(keys)
        return self._scan(t, [d for k, dirs in sorted(t["parts"].items()) if ok(k) for d in dirs])

    def _write(self, schema: str, table: str, df: DataFrame, by: list[str], sort_by: list[str], level: int = 0) -> dict[str, str]:
        """Writes the rows into a new directory; returns the directory of each partition's key. Rows are
        rebalanced: a large partition becomes several files of a bounded size, not one task's work."""
        top = f"{schema}/{table}/{uuid.uuid4().hex}-{level}"
        if not by:
            (df.sortWithinPartitions(*sort_by) if sort_by else df).write.parquet(f"{self.root}/{top}")
            return {"": top}
        cols = [f"_p{i}" for i in range(len(by))]
        df = df.withColumns({c: F.coalesce(F.expr(e).cast("string"), F.lit(NONE)) for c, e in zip(cols, by, strict=True)}).hint("rebalance", *cols)
        df.sortWithinPartitions(*cols, *sort_by).write.partitionBy(*cols).parquet(f"{self.root}/{top}")
        out = {"": top}
        for _ in by:
            deeper = {}
            for key, d in out.items():
                for f in self._fs.listStatus(self._path(f"{self.root}/{d}")):
                    name = f.getPath().getName()
                    if f.isDirectory() and "=" in name:
                        value = unquote(name.split("=", 1)[1])
                        deeper[f"{key}{SEP}{value}" if key else value] = f"{d}/{name}"
            out = deeper
        return out

    def _columns(self, df: DataFrame, old: dict | None = None) -> dict:
        """The columns of df, after those that the table has already; all may be null."""
        kinds = {f.name: f.dataType for f in StructType.fromJson(old["columns"])} if old else {}
        merged = kinds | {f.name: f.dataType for f in df.schema if f.name not in kinds}
        out = StructType()
        for name, kind in merged.items():
            out = out.add(name, kind)
        return out.jsonValue()

    def write(self, schema: str, table: str, df: DataFrame, by: list[str] | None = None, sort_by: list[str] | None = None) -> DataFrame:
        """Replaces the table. df may read the table itself: its directories stay as they are. by: SQL
        expressions of the partition; sort_by: columns by which files are clustered."""
        parts = self._write(schema, table, df, by or [], sort_by or [])
        state = self._load()
        state["schemas"].setdefault(schema, {})[table] = {"columns": self._columns(df), "by": by or [], "sort_by": sort_by or [], "parts": {k: [d] for k, d in parts.items()}, "written": dict.fromkeys(parts, time.time())}
        self._store(state)
        return self.read(schema, table)

    def append(self, schema: str, table: str, df: DataFrame) -> DataFrame:
        return self.replace(schema, table, df, ())

    def append_once(self, schema: str, table: str, df: DataFrame, stream: str, number: int) -> bool:
        """Appends the batch of a stream unless one of that number or a later one is in already; says whether it
        did. The number is kept in the pointer file, in the same step as the rows: no table is searched."""
        if self._load()["streams"].get(stream, -1) >= number:
            return False
        self.replace(schema, table, df, (), stream=(stream, number))
        return True

    def replace(self, schema: str, table: str, df: DataFrame, keys: Keys, by: list[str] | None = None, sort_by: list[str] | None = None, pending: dict[str, set[str]] | None = None, strict: bool = False, sync: bool = False, stream: tuple[str, int] | None = None) -> DataFrame:
        """The partitions of these keys are let go and df's rows added, in one step; a first run writes df
        by `by`. Other partitions are neither read nor written. strict: rows outside the keys are an
        error. sync: the table's columns become df's (a new one is null in other partitions, a missing one
        is dropped); otherwise they only grow. pending and the stream's last batch are noted in the same
        step."""
        old = self._table(schema, table) if self.exists(schema, table) else {"columns": self._columns(df), "by": by or [], "sort_by": sort_by or [], "parts": {}}
        ok = _chosen(keys)
        new = self._write(schema, table, df, old["by"], old["sort_by"])
        if strict and (beyond := [k for k in new if not ok(k)]):
            raise ValueError(f"{schema}.{table}: rows outside what is replaced: {sorted(beyond)[:5]}")
        parts = {k: list(d) for k, d in old["parts"].items() if not ok(k)}
        for k, d in new.items():
            parts.setdefault(k, []).append(d)
        entry = old | {"columns": self._columns(df, None if sync else old), "parts": parts}
        now = time.time()
        entry["written"] = {k: t for k, t in old.get("written", {}).items() if k in parts} | dict.fromkeys(new, now)
        for k in new:
            parts[k] = self._compact(schema, table, entry, parts[k])
        state = self._load()
        state["schemas"].setdefault(schema, {})[table] = entry
        for name, values in (pending or {}).items():
            state["pending"][name] = sorted({*state["pending"].get(name, []), *values})
        if stream:
            state["streams"][stream[0]] = stream[1]
        self._store(state)
        return self.read(schema, table)

    def _compact(self, schema: str, table: str, entry: dict, dirs: list[str]) -> list[str]:
        """Joins COMPACT_AT directories of one size class into one of the next, so that a row is written
        again a logarithmic number of times, however many appends there are."""
        level = 0
        while len(same := [d for d in dirs if _level(d) == level]) >= COMPACT_AT:
            (one,) = self._write(schema, table, self._scan(entry, same), [], entry["sort_by"], level + 1).values()
            dirs = [d for d in dirs if d not in same] + [one]
            level += 1
        return dirs

    def ensure(self, schema: str, table: str, empty: DataFrame, by: list[str] | None = None, sort_by: list[str] | None = None) -> None:
        if not self.exists(schema, table):
            self.write(schema, table, empty, by, sort_by)

    def _keys_of(self, df: DataFrame, by: list[str]) -> set[str]:
        """The partitions in which df has rows: at most as many as the table has."""
        cols = [F.coalesce(F.expr(e).cast("string"), F.lit(NONE)) for e in by]
        return {r[0] for r in df.select(F.concat_ws(SEP, *cols).alias("k")).distinct().collect()} if by else {""}

    def upsert(self, schema: str, table: str, df: DataFrame, keys: list[str], within: bool = False) -> DataFrame:
        """MERGE on keys, rows of df winning; a first run writes df. Columns follow df: new ones are added
        (null before), missing ones dropped. within: a key's rows are all in one partition, old and new, so
        only the partitions in which df has rows are read and written."""
        return self._merge(schema, table, df, keys, within, upsert.merge_upsert)

    def delete_insert(self, schema: str, table: str, df: DataFrame, keys: list[str], within: bool = False) -> DataFrame:
        return self._merge(schema, table, df, keys, within, upsert.delete_insert)

    def _merge(self, schema: str, table: str, df: DataFrame, keys: list[str], within: bool, how) -> DataFrame:
        if not self.exists(schema, table):
            return self.write(schema, table, df)
        touched = self._keys_of(df, self._table(schema, table)["by"]) if within else None
        return self.replace(schema, table, how(upsert.synced(self.read(schema, table, touched), df.columns), df, keys), touched, strict=True, sync=True)

    def clone(self, source: str, target: str) -> None:
        """The target becomes a copy of the source by reference; its own tables are let go."""
        state = self._load()
        state["schemas"][target] = json.loads(json.dumps(state["schemas"].get(source, {})))
        self._store(state)

    def swap(self, a: str, b: str, settled: str | None = None) -> None:
        """The schemas change places; what is pending under `settled` is done with it."""
        state = self._load()
        s = state["schemas"]
        s[a], s[b] = s.get(b, {}), s.get(a, {})
        if settled:
            state["pending"].pop(settled, None)
        self._store(state)

    def drop(self, schema: str, tables: list[str]) -> None:
        """Lets go of the tables that exist; directories stay until vacuum."""
        state = self._load()
        for t in tables:
            state["schemas"].get(schema, {}).pop(t, None)
        self._store(state)

    def vacuum(self) -> list[str]:
        """Deletes the directories that no table refers to."""
        used = {d for s in self._load()["schemas"].values() for t in s.values() for dirs in t["parts"].values() for d in dirs}
        gone = []

        def walk(d: str, depth: int) -> None:
            below = [f"{d}/{f.getPath().getName()}" for f in self._fs.listStatus(self._path(f"{self.root}/{d}")) if f.isDirectory()]
            for x in below:
                if x in used:
                    continue
                if depth < 2 or any(u.startswith(f"{x}/") for u in used):
                    walk(x, depth + 1)
                else:
                    self._fs.delete(self._path(f"{self.root}/{x}"), True)
                    gone.append(x)

        for f in self._fs.listStatus(self._path(self.root)):
            if f.isDirectory():
                walk(f.getPath().getName(), 1)
        return gone

    # For consumers.

    def publish_views(self, schema: str, prefix: str = "") -> list[str]:
        """Temporary views over a schema's tables, for SQL in this session."""
        for t in self.tables(schema):
            self.read(schema, t).createOrReplaceTempView(f"{prefix}{t}")
        return self.tables(schema)

    def register(self, schema: str, database: str) -> list[str]:
        """Views over a schema's tables in the session's catalog: as lasting as that catalog, and to be
        registered again after a swap."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        done = []
        for name in self.tables(schema):
            t = self._table(schema, name)
            dirs = [d for _, x in sorted(t["parts"].items()) for d in x]
            if dirs:
                cols = ", ".join(f"`{f.name}`" for f in StructType.fromJson(t["columns"]))
                self.spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS SELECT {cols} FROM parquet.`{self.root}/{{{','.join(dirs)}}}`")
                done.append(name)
        return done
