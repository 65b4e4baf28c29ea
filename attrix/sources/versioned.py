"""Tables that a night's run changes in place, instead of building them again.

A store is a folder with any number of tables.  A table's rows lie in hash buckets of
some of its columns, one folder a bucket.  Changing rows writes the touched buckets anew
into fresh folders; the others stay as they are.  What is current is said by a manifest,
``_manifests/<version>``, that names the bucket folders of all tables.  A transaction
writes data first and the next manifest last, under a name that may appear only once:

* a run that dies before leaves folders that nothing names, and the old version stands;
* all tables of a transaction change together, and a reader keeps the version it opened;
* of two runs that start from one version, the second fails with ``Conflict``.

The manifest has a line per bucket, so its size depends on the bucket count, not the rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from attrix.operators.dedup import latest_per_key
from attrix.session import create_text, list_files, read_text, remove_path, scratch_path, stored_bytes, subfolders

BUCKET, PART = "__attrix_bucket", "__attrix_part"
BUCKETS = 64
PART_BYTES = 16 << 20      # of stored rows that one task merges; a larger bucket is dealt over several by key


class Conflict(RuntimeError):
    """Another transaction committed first."""


def bucket_of(by: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int")


@dataclass
class Snapshot:
    """One version of all tables of a store."""

    spark: SparkSession
    path: str
    version: int
    tables: dict

    def __contains__(self, name: str) -> bool:
        return name in self.tables

    def read(self, name: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """A table, or only some of its buckets; others are not listed, opened or planned."""
        t = self.tables[name]
        schema = StructType.fromJson(t["schema"])
        paths = self._paths(name, buckets)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _paths(self, name: str, buckets: Iterable[int] | None = None) -> list[str]:
        t = self.tables[name]
        wanted = t["folders"] if buckets is None else {str(b) for b in buckets} & set(t["folders"])
        return [f"{self.path}/data/{t['folders'][b]}" for b in sorted(wanted, key=int)]

    def touched(self, name: str, keys: DataFrame) -> list[int]:
        """The buckets of a table that ``keys`` (its bucket columns) fall into: at most its bucket count."""
        t = self.tables[name]
        found = keys.select(bucket_of(t["by"], t["buckets"]).alias("b")).distinct()
        return sorted(r["b"] for r in found.collect())


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        return [int(f.rsplit("/", 1)[-1]) for f in list_files(self.spark, f"{self.path}/_manifests")]

    def snapshot(self, version: int | None = None) -> Snapshot:
        if version is None:
            version = max(self.versions(), default=0)
        tables = json.loads(read_text(self.spark, self._manifest(version))) if version else {}
        return Snapshot(self.spark, self.path, version, tables)

    def begin(self) -> Transaction:
        return Transaction(self, self.snapshot())

    def vacuum(self, keep: int = 2) -> int:
        """Remove data folders that none of the last ``keep`` versions names, and older manifests; how many went.

        Call it while no transaction is open: what an open one has written is not named yet.
        """
        versions = sorted(self.versions())
        kept = {f.split("/")[0] for v in versions[-keep:] for t in self.snapshot(v).tables.values() for f in t["folders"].values()}
        for v in versions[:-keep]:
            remove_path(self.spark, self._manifest(v))
        gone = [f for f in subfolders(self.spark, f"{self.path}/data") if f not in kept]
        for f in gone:
            remove_path(self.spark, f"{self.path}/data/{f}")
        return len(gone)

    def _manifest(self, version: int) -> str:
        return f"{self.path}/_manifests/{version:012d}"


class Transaction:
    """Changes to the tables of one version; nothing shows until ``commit``."""

    def __init__(self, store: Store, base: Snapshot):
        self.store, self.base = store, base
        self.now = Snapshot(base.spark, base.path, base.version + 1, json.loads(json.dumps(base.tables)))
        self._scratch: list[str] = []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written to the shared folder, for what is read more than once; ``done`` removes it."""
        path = scratch_path(self.store.spark, name)
        self._scratch.append(path)
        df.write.parquet(path)
        return self.store.spark.read.schema(df.schema).parquet(path)

    def done(self) -> None:
        """Remove what ``keep`` and ``merge`` wrote beside the tables; changes that were read lazily end here."""
        for path in self._scratch:
            remove_path(self.store.spark, path)
        self._scratch.clear()

    def replace(self, name: str, rows: DataFrame, by: Sequence[str], touched: Sequence[int] | None = None,
                buckets: int = BUCKETS) -> None:
        """``rows`` become the content of the ``touched`` buckets of a table (of all, if None).

        A new table gets ``buckets`` buckets on the columns ``by``; an old one keeps its own.
        One shuffle by bucket precedes the write, so a small bucket is one file; those that grew
        past the advisory partition size are written by several tasks.
        """
        t = self._table(name, by, buckets)
        self._write(name, t, rows.withColumn(BUCKET, bucket_of(t["by"], t["buckets"])).hint("rebalance", BUCKET), touched)

    def _table(self, name: str, by: Sequence[str], buckets: int) -> dict:
        return self.now.tables.get(name) or {"by": list(by), "buckets": buckets, "folders": {}}

    def _write(self, name: str, t: dict, rows: DataFrame, touched: Sequence[int] | None) -> None:
        t["schema"] = json.loads(rows.drop(BUCKET).schema.json())
        folder = f"{name}-{uuid.uuid4().hex[:12]}"
        rows.write.partitionBy(BUCKET).parquet(f"{self.store.path}/data/{folder}")
        for b in (list(t["folders"]) if touched is None else map(str, touched)):
            t["folders"].pop(b, None)
        t["folders"] |= {f.split("=")[1]: f"{folder}/{f}" for f in subfolders(self.store.spark, f"{self.store.path}/data/{folder}")
                         if f.startswith(f"{BUCKET}=")}
        self.now.tables[name] = t

    def merge(self, name: str, rows: DataFrame, keys: Sequence[str], order: Sequence, buckets: int = BUCKETS,
              total_order: bool = True) -> Changes:
        """Upsert: the first row per ``keys`` under ``order`` of the table and ``rows`` together (see ``latest_per_key``).

        Only buckets that hold a key of ``rows`` are read and written.  The rows are reduced to one
        per key before anything else, so a key that repeats without end costs one row.
        """
        new = self.keep(latest_per_key(rows, keys, order, total_order), f"{name}-new")
        t, touched = self._table(name, keys, buckets), None
        if name not in self.now:         # one row per key already
            self._write(name, t, new.withColumn(BUCKET, bucket_of(t["by"], t["buckets"])).hint("rebalance", BUCKET), touched)
            return Changes(self, name, new.select(*keys), list(keys), touched)
        touched = self.now.touched(name, new.select(*keys))
        both = self.now.read(name, touched).unionByName(new, allowMissingColumns=True)
        # bucket and part are functions of the key: one shuffle serves the choice of rows and the write,
        # and a task's share does not grow with the table
        n = max(1, len(touched))
        size = stored_bytes(self.store.spark, [*self.now._paths(name, touched), self._scratch[-1]])
        parts = max(1, -(-size // (n * PART_BYTES)))
        both = (both.withColumn(BUCKET, bucket_of(t["by"], t["buckets"]))
                .withColumn(PART, F.pmod(F.xxhash64(F.lit(PART), *t["by"]), F.lit(parts))).repartition(n * parts, BUCKET, PART))
        self._write(name, t, latest_per_key(both, [BUCKET, PART, *keys], order, total_order).drop(PART), touched)
        return Changes(self, name, new.select(*keys), list(keys), touched)

    def commit(self) -> int:
        """Make all changes current at once; ``Conflict`` if another transaction was faster."""
        text = json.dumps(self.now.tables, separators=(",", ":"))
        if not create_text(self.store.spark, self.store._manifest(self.now.version), text):
            raise Conflict(f"version {self.now.version} of {self.store.path} is there already")
        return self.now.version


@dataclass
class Changes:
    """Which keys a merge was given, with their rows before and after it."""

    transaction: Transaction
    name: str
    keys: DataFrame
    columns: list[str]
    touched: list[int] | None

    def _rows(self, snapshot: Snapshot) -> DataFrame | None:
        if self.name not in snapshot:
            return None
        t = snapshot.read(self.name, self.touched)
        same = [t[c].eqNullSafe(self.keys[c]) for c in self.columns]
        return t.join(self.keys, same, "left_semi")

    def before(self) -> DataFrame | None:
        """The given keys' rows in the version that the transaction started from (None: no such table)."""
        return self._rows(self.transaction.base)

    def after(self) -> DataFrame:
        if self.name not in self.transaction.base:       # a new table has the given keys and no others
            return self.transaction.now.read(self.name)
        return self._rows(self.transaction.now)
