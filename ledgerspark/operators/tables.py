"""Tables of Parquet snapshots: appends, upserts, deletes by anti join, atomic commits over several tables.

A store is a folder of tables and of numbered states.  A state is a small JSON
file that names the folders of rows of every table, and counters.  A change
writes new folders of rows first; then one state file, the next by number, is
renamed into place.  States are never changed or replaced: readers take the
highest, so they see all of a commit or nothing of it, at any moment, and a job
that fails before its commit leaves the state as it was.  Two writers can't both
make the same number; the second fails.

Control tables, a few rows for each file of an import, are JSON rows in files of
their own: reading and changing them takes no job.
"""

from __future__ import annotations

import datetime
import json
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: So many of the last states are kept, with the rows that they name.
KEPT = 3


class Conflict(RuntimeError):
    """Another writer has made a state meanwhile."""


class Store:
    """The states of a folder of tables."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.open: Transaction | None = None

    def _at(self, name: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def names(self, folder: str) -> list[str]:
        store, where = self._at(folder)
        return sorted(x.getPath().getName() for x in store.listStatus(where)) if store.exists(where) else []

    def text(self, name: str) -> str:
        store, where = self._at(name)
        stream = store.open(where)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, body: str) -> None:
        """Writes a file that must not exist, under another name first."""
        store, where = self._at(name)
        _, new = self._at(f"_new/{uuid.uuid4().hex}")
        out = store.create(new, True)
        out.write(bytearray(body.encode()))
        out.close()
        store.mkdirs(where.getParent())
        if store.exists(where) or not store.rename(new, where):
            store.delete(new, False)
            raise Conflict(f"{self.path}/{name} exists")

    def remove(self, name: str) -> None:
        store, where = self._at(name)
        store.delete(where, True)

    def last(self) -> int:
        """The number of the current state, 0 before the first."""
        return max((int(x) for x in self.names("_states") if x.isdigit()), default=0)

    def state(self) -> dict:
        """What the open transaction has made of the current state, or that."""
        return self.open.state if self.open else self.stored()

    def stored(self) -> dict:
        n = self.last()
        return json.loads(self.text(f"_states/{n:012d}")) if n else {"tables": {}, "counters": {}}

    def counter(self, name: str) -> int:
        return self.state()["counters"].get(name, 0)

    @contextmanager
    def transaction(self):
        """All changes to tables within become visible together, at the end, or not at all. Within another one, it is part of that."""
        if self.open:
            yield self.open
            return
        self.open = Transaction(self)
        try:
            yield self.open
            self.open.commit()
        except BaseException:
            self.open.abandon()
            raise
        finally:
            self.open = None


class Transaction:
    def __init__(self, store: Store):
        self.store, self.base = store, store.last()
        self.state = json.loads(store.text(f"_states/{self.base:012d}")) if self.base else {"tables": {}, "counters": {}}
        self.made: list[str] = []
        self.changed = False

    def count(self, name: str, value: int) -> None:
        self.state["counters"][name], self.changed = value, True

    def name(self, table: str, parts: list[str]) -> None:
        self.state["tables"][table], self.changed = parts, True

    def commit(self) -> None:
        if not self.changed:
            return
        self.store.put(f"_states/{self.base + 1:012d}", json.dumps(self.state))
        self._tidy()

    def abandon(self) -> None:
        for part in self.made:
            self.store.remove(part)

    def _tidy(self) -> None:
        """Removes states before the last KEPT, and the folders of rows that only they name."""
        states = [x for x in self.store.names("_states") if x.isdigit()]
        old, kept = states[:-KEPT], states[-KEPT:]
        if not old:
            return
        parts = lambda x: {f"{t}/{p}" for t, ps in json.loads(self.store.text(f"_states/{x}"))["tables"].items() for p in ps}
        needed = set().union(*map(parts, kept))
        for x in old:
            gone = parts(x) - needed
            self.store.remove(f"_states/{x}")
            for part in gone:
                self.store.remove(part)


class Table:
    def __init__(self, store: Store, name: str, schema: T.StructType):
        self.store, self.name, self.schema, self.spark = store, name, schema, store.spark

    def parts(self) -> list[str]:
        """The folders that make up the current state."""
        return self.store.state()["tables"].get(self.name, [])

    def read(self) -> DataFrame:
        parts = self.parts()
        return self.spark.read.schema(self.schema).parquet(*[f"{self.store.path}/{self.name}/{p}" for p in parts]) if parts else self.spark.createDataFrame([], self.schema)

    def stored_schema(self) -> T.StructType | None:
        """The columns that the rows were written with, None without rows."""
        parts = self.parts()
        return self.spark.read.parquet(f"{self.store.path}/{self.name}/{parts[-1]}").schema if parts else None

    def _write(self, transaction: Transaction, rows: DataFrame) -> str:
        part = f"rows-{uuid.uuid4().hex}"
        transaction.made.append(f"{self.name}/{part}")
        rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]).write.parquet(f"{self.store.path}/{self.name}/{part}")
        return part

    def replace(self, rows: DataFrame) -> None:
        with self.store.transaction() as t:
            t.name(self.name, [self._write(t, rows)])

    def append(self, rows: DataFrame) -> None:
        """Writes the new rows only; the state's list of folders gets one more."""
        with self.store.transaction() as t:
            t.name(self.name, [*self.parts(), self._write(t, rows)])

    def truncate(self) -> None:
        with self.store.transaction() as t:
            t.name(self.name, [])

    def delete(self, condition: Column) -> int:
        """Rows that meet the condition go; how many."""
        rows = self.read()
        n = rows.filter(condition).count()
        if n:
            self.replace(rows.filter(~F.coalesce(condition, F.lit(False))))
        return n


class Control(Table):
    """A small table whose rows are kept as JSON and changed on the driver."""

    def rows(self) -> list[dict]:
        parts = self.parts()
        return [self._typed(x) for x in json.loads(self.store.text(f"{self.name}/{parts[0]}"))] if parts else []

    def _typed(self, row: dict) -> dict:
        times = {f.name for f in self.schema if isinstance(f.dataType, T.TimestampType)}
        return {k: datetime.datetime.fromisoformat(v) if k in times and v else v for k, v in row.items()}

    def read(self) -> DataFrame:
        return self.spark.createDataFrame([tuple(x.get(f.name) for f in self.schema) for x in self.rows()], self.schema)

    def write(self, rows: list[dict]) -> None:
        with self.store.transaction() as t:
            part = f"rows-{uuid.uuid4().hex}.json"
            plain = [{f.name: x.get(f.name) for f in self.schema} for x in rows]
            self.store.put(f"{self.name}/{part}", json.dumps(plain, default=lambda v: v.isoformat()))
            t.made.append(f"{self.name}/{part}")
            t.name(self.name, [part])

    def put(self, changes: list[dict], keys: tuple[str, ...]) -> None:
        """Rows of the same keys get what is given, others are added; updated_at is set."""
        now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
        found = {tuple(x[k] for k in keys): x for x in self.rows()}
        for x in changes:
            key = tuple(x[k] for k in keys)
            found[key] = found.get(key, {}) | x | {"updated_at": now}
        self.write(list(found.values()))

    def drop(self, condition) -> int:
        """Rows that meet the condition, a function of a row, go; how many."""
        rows = self.rows()
        kept = [x for x in rows if not condition(x)]
        if len(kept) < len(rows):
            self.write(kept)
        return len(rows) - len(kept)


def last_wins(rows: DataFrame, keys: tuple[str, ...], order: str) -> DataFrame:
    """One row a key: that of the greatest order. An aggregate, so it combines before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__row")).select(*keys, "__row.*").select(*rows.columns)


def first_wins(rows: DataFrame, keys: tuple[str, ...], order: str) -> DataFrame:
    """One row a key: that of the least order, by an aggregate as well."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("__row")).select(*keys, "__row.*").select(*rows.columns)


def upsert(target: DataFrame, source: DataFrame, keys: tuple[str, ...], now: Column | None = None) -> DataFrame:
    """The target with the source's rows: equal keys are updated, others added. created_at stays, updated_at is set to now."""
    now = F.current_timestamp() if now is None else now
    old, new = target.alias("o"), source.withColumn("__new", F.lit(True)).alias("n")
    both = old.join(new, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full_outer")
    is_new = F.coalesce(F.col("n.__new"), F.lit(False))
    out = []
    for c in target.columns:
        if c == "created_at":
            out.append(F.coalesce("o.created_at", now).alias(c))
        elif c == "updated_at":
            out.append(F.when(is_new, now).otherwise(F.col("o.updated_at")).alias(c))
        elif c in source.columns:
            out.append(F.when(is_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        else:
            out.append(F.col(f"o.{c}").alias(c))
    return both.select(*out)


def missing_codes(rows: DataFrame, column: str, lookup: DataFrame) -> DataFrame:
    """Different codes (without blanks) that the lookup lacks."""
    codes = rows.select(F.trim(F.col(column)).alias("code")).filter("code <> ''").distinct()
    return codes.join(lookup.select("code"), "code", "left_anti")
