"""What the training-data operators share: scratch tables in the cluster's shared folder, and small helpers."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import tempfile
import time
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: A bitmap has eight bits for each hash, and so many at most (64 MB, for 134 million hashes at a quarter full; a fuller one
#: tells too little to be used).
BITS, BLOCK_BITS = 1 << 29, 1 << 15
ROWS = 100_000  # short rows that are worth a task of their own
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where the setting is missing, a local master gets a temporary folder; on a
    cluster, whose executors would not see that, it is an error."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="tidemark-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def _delete(spark: SparkSession, conf, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)


class Scratch:
    """Tables written once and read again. They cut lineage and outlive lost executors. They go when the program ends, also
    after the session was stopped; those of a program that was killed are taken away by `sweep`."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.conf = spark, spark.sparkContext._jsc.hadoopConfiguration()
        self.path = f"{shared_dir(spark)}/tidemark-{name}-{uuid.uuid4().hex[:12]}"
        self.tables: list[str] = []
        atexit.register(self.drop)

    @staticmethod
    def shuffled(df: DataFrame) -> DataFrame:
        """For the side of a join that grows with the data: these files are packed tightly, and their size on disk says
        too little about what a broadcast of their rows would weigh."""
        return df.hint("merge")

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """What Spark shuffled for it goes as soon as it is written, and not when the driver happens to collect its garbage."""
        path, before = f"{self.path}/{name}", self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.unset(CLEANUP) if before is None else self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def forget(self, *names: str) -> None:
        """Takes away tables that nothing still to be computed reads."""
        for name in names:
            _delete(self.spark, self.conf, f"{self.path}/{name}")

    def bucketed(self, df: DataFrame, name: str, column: str) -> tuple[DataFrame, DataFrame]:
        """A table laid out by a hash of a column, so that joins and groups on it need not move it; given twice: as that
        table, and as plain files with columns of their own."""
        path, table = f"{self.path}/{name}", f"{self.path.rsplit('/', 1)[1]}-{name}".replace("-", "_")
        df.write.option("compression", "zstd").option("path", path).bucketBy(parts(self.spark), column).saveAsTable(table)
        self.tables.append(table)
        return self.spark.table(table), self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        with contextlib.suppress(Exception):  # where the session has ended, its catalog of temporary tables has too
            for table in self.tables:
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        with contextlib.suppress(Exception):  # the JVM has ended before the program
            _delete(self.spark, self.conf, self.path)


def sweep(spark: SparkSession, hours: float = 48) -> int:
    """Takes away scratch folders, and tables over them, that no program has touched for so long; returns how many."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    top = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    fs = top.getFileSystem(conf)
    old = [s.getPath() for s in (fs.listStatus(top) if fs.exists(top) else []) if s.getPath().getName().startswith("tidemark-") and s.getModificationTime() < (time.time() - 3600 * hours) * 1000]
    gone = {p.getName().replace("-", "_") for p in old}
    for t in spark.catalog.listTables():
        if any(t.name.startswith(f"{name.lower()}_") for name in gone):
            spark.sql(f"DROP TABLE IF EXISTS {t.name}")
    for p in old:
        fs.delete(p, True)
    return len(old)


def bitmap(hashes: DataFrame, most: int = BITS) -> np.ndarray | None:
    """hashes: one column of longs. A bitmap of them, built in blocks by Spark, of a size that follows their number, up to
    `most` bits; None if it is too full to be of use, so that all rows count as possible."""
    bits = max(BLOCK_BITS, min(most, 1 << max(20, (8 * hashes.count()).bit_length())))

    def pack(group: pa.Table) -> pa.Table:
        marks = np.zeros(BLOCK_BITS, np.uint8)
        marks[group.column("bit").to_numpy()] = 1
        return pa.table({"block": group.column("block").slice(0, 1), "marks": pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary())})

    at = F.pmod(F.col(hashes.columns[0]), F.lit(bits))
    blocks = hashes.select(at.alias("at")).distinct().select((F.col("at") / BLOCK_BITS).cast("int").alias("block"), (F.col("at") % BLOCK_BITS).cast("int").alias("bit"))
    told = blocks.groupBy("block").applyInArrow(pack, "block int, marks binary").toArrow()  # at most bits / BLOCK_BITS rows of 4 KB
    out = np.zeros((-(-bits // BLOCK_BITS), BLOCK_BITS // 8), np.uint8)
    for block, marks in zip(told.column("block").to_pylist(), told.column("marks"), strict=True):
        out[block] = np.frombuffer(marks.as_py(), np.uint8)
    return out.ravel() if 4 * int(np.bitwise_count(out).sum()) <= bits else None


def possible(spark: SparkSession, marks: np.ndarray | None, h: Column) -> Column:
    """Whether a hash may be among those of the bitmap: true for all of them, and for one in four others at most."""
    if marks is None:
        return F.lit(True)
    shared = spark.sparkContext.broadcast(marks)  # BITS / 8 bytes at most

    @F.arrow_udf("boolean")
    def found(at: pa.Array) -> pa.Array:
        return pa.array(among(shared.value, at.to_numpy()))

    return found(h)


def among(marks: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The same for an array of hashes, inside a task that has other work in Python to do on the rows: two functions in one
    task are two Python workers, which live on in the executor's memory."""
    at = np.mod(h, 8 * len(marks))
    return (marks[at >> 3] >> (at & 7) & 1).astype(bool)


def give_back() -> None:
    """For the end of a task whose Python worker lives on for later stages: what its batches and caches took and set free
    goes back to the system, where the C library has a way to do so."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def narrowed(df: DataFrame, rows: int | None, worth: int = ROWS) -> DataFrame:
    """df in no more tasks than about so many rows are worth, but in as many as there are cores, so that a table of few rows
    is not as many files, shuffle files and tasks as there are shuffle partitions. No rows are moved for it."""
    return df if rows is None else df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // worth)))


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def owners_of(docs: DataFrame, rows: int = 1_000_000) -> int:
    """How many owners what tasks exchange is dealt to: as many as there are shuffle partitions, or more, so that no owner
    answers for over so many documents on average. The rows are counted, which a table's files tell without their texts."""
    return max(parts(docs.sparkSession), -(-docs.count() // rows))


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def load(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def two(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text under fixed names, so that other columns cannot clash; a null text is empty."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
