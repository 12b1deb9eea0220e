"""Versioned tables: immutable bucket files, and one small marker for each committed version.

A commit writes the tables that it changes under a new folder, dealt to buckets by a hash of their key, and reads counts and
checksums of what was written. Buckets that come out as they were keep their old files. The version exists once its marker,
which names the files of every bucket, has been renamed into place: a run that breaks before leaves files that nothing names,
one that breaks after has committed. Each marker also holds, for each writer, the number of its last commit, so
that a step that is delivered again changes nothing.

A marker has an entry for each table and bucket, which is all that the driver holds of a table. Renaming refuses an existing marker
where the store does (HDFS); two writers that commit at once should otherwise take turns.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, MapType, StructField, StructType

from scholarlake.operators import merge

BUCKET = "_bucket"
BUCKET_FIELD = StructField(BUCKET, IntegerType())


class Conflict(RuntimeError):
    """Another commit came first, or what a run began with has changed."""


class Files:
    """The few operations on a folder of any Hadoop store that Spark's readers and writers lack."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self.path = spark._jvm, path.rstrip("/")
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, folder: str) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._at(folder))] if self._fs.exists(self._at(folder)) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """A whole new file, by a rename; an error if it exists."""
        folder, _, last = name.rpartition("/")
        draft = self._at(f"{folder}/.{last}-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self._fs.exists(self._at(name)) or not self._fs.rename(draft, self._at(name)):
            self._fs.delete(draft, False)
            raise Conflict(f"{name} exists")

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


def hashable(df: DataFrame, columns: list[str]) -> list[Column]:
    return [F.array_sort(F.map_entries(c)) if isinstance(df.schema[c].dataType, MapType) else F.col(c) for c in columns]


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of a row, whatever the order of its columns; maps count as their sorted entries."""
    return F.xxhash64(*hashable(df, sorted(c for c in df.columns if c != BUCKET)), F.lit(0))


def bucket_sums(df: DataFrame) -> dict[str, dict]:
    """{bucket: n and checksum} of a table with its bucket column; the checksum doesn't depend on order and counts repeated rows."""
    total = F.sum(F.col("h").cast("decimal(20,0)")).cast("decimal(38,0)")
    sums = df.select(F.col(BUCKET), row_hash(df).alias("h")).groupBy(BUCKET).agg(F.count("*").alias("n"), F.concat_ws(":", F.hex(F.bit_xor("h")), total.cast("string")).alias("checksum"))
    return {str(r[BUCKET]): {"n": r["n"], "checksum": r["checksum"]} for r in sums.collect()}  # a row for each bucket


class VersionedTables:
    """Tables by name under a folder; `keys` gives the columns that deal a table's rows to buckets (all columns where it has no entry)."""

    def __init__(self, spark: SparkSession, path: str, keys: dict[str, list[str]] | None = None, buckets: int = 16):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys or {}, buckets
        self.files = Files(spark, path)

    def version(self) -> int:
        """The newest version; 0 before any commit."""
        return max((int(n[:-5]) for n in self.files.names("versions") if n.endswith(".json") and not n.startswith(".")), default=0)

    def marker(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        return json.loads(self.files.read(f"versions/{version:012d}.json")) if version else {"version": 0, "writers": {}, "tables": {}}

    def writer(self, name: str, version: int | None = None) -> dict | None:
        """What a writer's last commit left: its sequence and notes."""
        return self.marker(version)["writers"].get(name)

    def read(self, version: int | None = None, names: list[str] | None = None) -> dict[str, DataFrame]:
        tables = self.marker(version)["tables"]
        return {n: self._rows(tables[n], list(tables[n]["buckets"])) for n in (tables if names is None else names)}

    def _rows(self, table: dict, buckets: list[str]) -> DataFrame:
        schema = StructType.fromJson(table["schema"])
        paths = [f"{self.path}/data/{table['buckets'][b]['path']}/{BUCKET}={b}" for b in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def bucket_of(self, name: str, df: DataFrame, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*hashable(df, self.keys.get(name, df.columns)), F.lit(0)), F.lit(buckets)).cast("int")

    def commit(self, tables: dict[str, DataFrame | tuple[DataFrame, list[str]]], writer: str, sequence: int, notes: dict | None = None) -> int:
        """The version in which `tables` are as given and all others as before; a table given with buckets has new rows in those alone.

        A sequence that the writer has committed already changes nothing. `notes` (JSON values) stay with the writer.
        """
        now = self.marker()
        done = now["writers"].get(writer)
        if done is not None and done["sequence"] >= sequence:
            return now["version"]
        fresh = {n: self._written(n, *(t if isinstance(t, tuple) else (t, None)), now["tables"].get(n)) for n, t in tables.items()}
        new = {
            "version": now["version"] + 1,
            "writers": {**now["writers"], writer: {"sequence": sequence, **(notes or {})}},
            "tables": {**now["tables"], **fresh},
        }
        self.files.create(f"versions/{new['version']:012d}.json", json.dumps(new))
        return new["version"]

    def _written(self, name: str, df: DataFrame, only: list[str] | None, before: dict | None) -> dict:
        buckets = before["dealt"] if before else self.buckets
        if only is not None and before:
            df = df.to(StructType.fromJson(before["schema"]))
        schema = json.loads(StructType([StructField(f.name, f.dataType) for f in df.schema]).json())
        folder = f"{uuid.uuid4().hex}/{name}"
        path = f"{self.path}/data/{folder}"
        # a bucket is as many tasks and files as its size asks for
        df.withColumn(BUCKET, self.bucket_of(name, df, buckets)).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)
        back = self.spark.read.schema(StructType([*df.schema.fields, BUCKET_FIELD])).parquet(path)
        sums = bucket_sums(back)
        old = before["buckets"] if before and before["schema"] == schema else {}
        out = {} if only is None else {b: v for b, v in old.items() if b not in only}
        for b, s in sums.items():
            if b in old and {k: old[b][k] for k in s} == s:
                out[b] = old[b]
                self.files.delete(f"data/{folder}/{BUCKET}={b}")
            else:
                out[b] = {**s, "path": folder}
        return {"schema": schema, "dealt": buckets, "buckets": out}

    def counts(self, version: int | None = None) -> dict[str, int]:
        """Rows of each table, from the marker alone."""
        return {n: sum(b["n"] for b in t["buckets"].values()) for n, t in self.marker(version)["tables"].items()}

    def verify(self, version: int | None = None) -> DataFrame:
        """table_name, bucket, ok of every bucket: whether its files still have its count and checksum."""
        out = []
        for name, table in self.marker(version)["tables"].items():
            schema = StructType([*StructType.fromJson(table["schema"]).fields, BUCKET_FIELD])
            parts = [self._rows(table, [b]).withColumn(BUCKET, F.lit(int(b))) for b in table["buckets"]]
            sums = bucket_sums(reduce(DataFrame.unionByName, parts, self.spark.createDataFrame([], schema)))
            out += [(name, int(b), sums.get(b) == {"n": s["n"], "checksum": s["checksum"]}) for b, s in table["buckets"].items()]
        return self.spark.createDataFrame(out, "table_name string, bucket int, ok boolean")

    def rows_of(self, name: str, buckets: list[str], version: int | None = None) -> DataFrame:
        """A version's rows in some buckets; no other file is read."""
        table = self.marker(version)["tables"][name]
        return self._rows(table, [b for b in buckets if b in table["buckets"]])


Snapshot = tuple[VersionedTables, int]


def differing_buckets(name: str, one: Snapshot, other: Snapshot) -> list[str]:
    """Buckets of a table whose count or checksum differs between two snapshots (store, version), from the markers alone."""
    (s, v), (t, w) = one, other
    a, b = s.marker(v)["tables"].get(name), t.marker(w)["tables"].get(name)
    if a and b and a["dealt"] != b["dealt"]:
        raise ValueError(f"{name} is dealt to {a['dealt']} and {b['dealt']} buckets")
    sums = [{k: (x["n"], x["checksum"]) for k, x in t["buckets"].items()} if t else {} for t in (a, b)]
    return sorted((k for k in {*sums[0], *sums[1]} if sums[0].get(k) != sums[1].get(k)), key=int)


def changes(name: str, one: Snapshot, other: Snapshot) -> DataFrame:
    """Keys and kind (added, removed, changed) of a table's rows from one snapshot to the other; only differing buckets are read."""
    buckets, keys = differing_buckets(name, one, other), one[0].keys[name]

    def hashed(snapshot: Snapshot, column: str) -> DataFrame:
        df = snapshot[0].rows_of(name, buckets, snapshot[1])
        return df.select(*keys, row_hash(df).alias(column))

    both = hashed(one, "_old").join(hashed(other, "_new"), keys, "full")
    kind = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(F.col("_old") != F.col("_new"), "changed")
    return both.select(*keys, kind.alias("kind")).where("kind is not null")


def copy_status(names: list[str], source: VersionedTables, target: VersionedTables) -> DataFrame:
    """table_name, source_n, target_n, buckets, differing, added, removed, changed of each table, from source to target: what a copy has still to do."""
    at = (target, target.version()), (source, source.version())
    held = target.counts(), source.counts()
    parts = []
    for n in names:
        count = lambda kind: F.count_if(F.col("kind") == kind).alias(kind)
        buckets = len({*at[0][0].marker(at[0][1])["tables"][n]["buckets"], *at[1][0].marker(at[1][1])["tables"][n]["buckets"]})
        head = [F.lit(n).alias("table_name"), F.lit(held[1][n]).cast("long").alias("source_n"), F.lit(held[0][n]).cast("long").alias("target_n"), F.lit(buckets).cast("long").alias("buckets"), F.lit(len(differing_buckets(n, *at))).cast("long").alias("differing")]
        parts.append(changes(n, *at).agg(count("added"), count("removed"), count("changed")).select(*head, "added", "removed", "changed"))
    return reduce(DataFrame.unionByName, parts)


def copy_differing(name: str, source: VersionedTables, target: VersionedTables, writer: str, sequence: int, mode: str = "changed") -> int:
    """The target's version after a copy of a table (modes of merge.copy_table) that reads and writes only the buckets that differ."""
    buckets = differing_buckets(name, (source, source.version()), (target, target.version()))
    copied = merge.copy_table(source.rows_of(name, buckets), target.rows_of(name, buckets), target.keys[name], mode=mode)
    return target.commit({name: (copied, buckets)}, writer, sequence)
