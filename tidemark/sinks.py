"""Versioned tables: a version is written in full, checked against its seal by reading it back, and made current by one rename.

Everything goes through Spark's writers and the Hadoop file system of the path, so any store will do whose rename is
atomic. A reader sees the old version or the new one; a run that dies leaves the old one, a folder nobody points to, and
perhaps a claim on a number, which the next writer takes over once it is old.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from functools import reduce
from operator import or_

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Conflict(Exception):
    """The table has changed since it was read."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, stale: float = 3_600):
        """stale: seconds after which a claim on a version that was not made current counts as that of a dead writer."""
        self.spark, self.path, self.stale = spark, path.rstrip("/"), stale

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def version(self) -> str | None:
        """The current version, or None. Versions are names of the form n-id; the pointer is the greatest n committed, a
        folder that holds the name."""
        fs, p = self._fs(f"{self.path}/_current")
        numbers = [int(s.getPath().getName()) for s in fs.listStatus(p)] if fs.exists(p) else []
        return self._marked(max(numbers)) if numbers else None

    def _marked(self, number: int | str) -> str:
        fs, p = self._fs(f"{self.path}/_current/{number}")
        return next(s.getPath().getName() for s in fs.listStatus(p) if s.isFile())

    def read(self, version: str | None = None) -> DataFrame:
        version = version or self.version()
        if version is None:
            raise FileNotFoundError(self.path)
        return self.spark.read.parquet(f"{self.path}/{version}")

    def write(self, df: DataFrame, expected: str | None) -> str:
        """The next version, if the current one is still `expected`."""
        if self.version() != expected:
            raise Conflict(f"{self.path} is at {self.version()}, not at {expected}")
        name = f"{int(expected.split('-')[0]) + 1 if expected else 1}-{uuid.uuid4().hex[:8]}"
        written = Observation()
        df.observe(written, *seal_sums(df, df.columns)).write.mode("errorifexists").parquet(f"{self.path}/{name}")
        if (lost := differences(written.get, df.sparkSession.read.schema(df.schema).parquet(f"{self.path}/{name}"), name)):
            raise Conflict(lost)
        return self.commit(name, expected)

    def commit(self, name: str, expected: str | None) -> str:
        """The mark of a version, a folder with its name, is made aside and renamed into the place of its number, which a
        store gives to one writer only: a folder that is there is not replaced."""
        number = name.split("-")[0]
        fs, mark = self._fs(f"{self.path}/_pending/{name}/{name}")
        aside = mark.getParent()
        fs.mkdirs(aside)
        fs.create(mark, True).close()
        if self.version() != expected or not self._claim(number, name):
            raise Conflict(f"{self.path}: another run has written version {number}, or is writing it")
        _, to = self._fs(f"{self.path}/_current/{number}")
        fs.mkdirs(to.getParent())
        if self._claimed(number) != name:
            raise Conflict(f"{self.path}: version {number} was taken over by another run")
        if not fs.rename(aside, to) or self._marked(number) != name:
            raise Conflict(f"{self.path}: version {number} could not be made current")
        return name

    def _claimed(self, number: str) -> str:
        fs, claim = self._fs(f"{self.path}/_claims/{number}")
        stream = fs.open(claim)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _claim(self, number: str, name: str) -> bool:
        """One writer at a time has a number. A claim that is old and led to no version is put aside by one rename, which one
        writer alone can do; then all of them may claim anew."""
        fs, claim = self._fs(f"{self.path}/_claims/{number}")
        fs.mkdirs(claim.getParent())
        for _ in range(2):
            try:
                stream = fs.create(claim, False)
            except Py4JJavaError:  # it is there
                if time.time() - fs.getFileStatus(claim).getModificationTime() / 1000 < self.stale:
                    return False
                _, aside = self._fs(f"{self.path}/_claims/stale-{number}-{uuid.uuid4().hex[:8]}")
                if not fs.rename(claim, aside):
                    return False
                continue
            stream.write(bytearray(name.encode()))
            stream.close()
            return True
        return False

    def rollback(self, version: str) -> str:
        """An earlier version made current again, as a new one."""
        return self.write(self.read(version), self.version())


def differences(written: DataFrame | dict, read: DataFrame, name: str) -> str:
    """Empty if the files of a version hold the rows that were written, by their sums (`seal_sums`, as a rule observed while
    they were written, so that nothing is computed twice)."""
    try:
        sums = [x if isinstance(x, dict) else x.agg(*seal_sums(x, x.columns)).first().asDict() for x in (written, read)]
    except Exception as e:  # what the store says goes into the conflict
        return f"{name} cannot be read back: {e}"
    same = len({tuple(x.get(k) or 0 for k in ("n", "a", "b")) for x in sums}) == 1
    return "" if same else f"{name} holds other rows than were written"


def upsert(old: DataFrame, changes: DataFrame, keys: list[str], deleted: str | None = None) -> DataFrame:
    """old with the rows of changes put in by key; a column that changes lacks keeps its value. deleted: a boolean column
    of changes that takes a row away. Two changes of one key, and null keys, are refused."""
    null = reduce(or_, [F.col(k).isNull() for k in keys])
    if wrong := changes.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(null | (F.col("_n") > 1)).take(1):
        raise ValueError(f"a key is null or changed twice: {wrong[0].asDict()}")
    o, c = old.alias("o"), changes.alias("c")
    there = F.col(f"c.{keys[0]}").isNotNull()
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"o.{k}") == F.col(f"c.{k}"))
    out = o.join(c, cond, "full")
    if deleted:
        out = out.where(~F.coalesce(F.col(f"c.{deleted}"), F.lit(False)))
    pick = lambda n: F.coalesce(F.col(f"o.{n}"), F.col(f"c.{n}")) if n in keys else F.when(there, F.col(f"c.{n}")).otherwise(F.col(f"o.{n}")) if n in changes.columns else F.col(f"o.{n}")
    return out.select(*(pick(n).alias(n) for n in old.columns))


def schema_patch(have: T.StructType, want: T.StructType) -> tuple[list[T.StructField], list[str]]:
    """Columns to add, and those whose type differs, which no patch mends."""
    types = {f.name: f.dataType for f in have}
    return [f for f in want if f.name not in types], [f.name for f in want if f.name in types and types[f.name] != f.dataType]


def migrate(df: DataFrame, want: T.StructType, allowed: bool) -> DataFrame:
    """df with the missing columns added as nulls; only if that is allowed, and never with a changed type."""
    add, wrong = schema_patch(df.schema, want)
    if wrong:
        raise ValueError(f"types differ: {', '.join(wrong)}")
    if add and not allowed:
        raise PermissionError(f"columns are missing: {', '.join(f.name for f in add)}")
    return df.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in add))


def seal_sums(df: DataFrame, columns: list[str]) -> list[Column]:
    """Aggregates that tell rows, whatever their order: a count and two sums of row hashes, kept whole as decimals. Every
    field is hashed with a mark of whether it is null, and nested ones as JSON with their nulls, since the hash skips nulls."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    fields = []
    for c in columns:
        own = F.col(f"`{c}`")
        fields += [own.isNull(), F.to_json(F.struct(own), {"ignoreNullFields": "false"}) if isinstance(df.schema[c].dataType, nested) else own]
    row = lambda salt: F.xxhash64(*fields, F.lit(salt)).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("n"), F.sum(row(1)).alias("a"), F.sum(row(2)).alias("b")]


def seal(df: DataFrame, columns: list[str]) -> str:
    """A hash over all rows, whatever their order."""
    n, a, b = df.agg(*seal_sums(df, columns)).first()
    return hashlib.sha256(f"{n}:{a or 0}:{b or 0}".encode()).hexdigest()
