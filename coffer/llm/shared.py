"""Helpers of the corpus operators: shared tables, bound values, a filter of fixed size."""

from __future__ import annotations

import gc
import shutil
import tempfile
import uuid
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of the membership filter; fixed, so what is sent to executors never grows with the data.
FILTER_BITS = 1 << 26
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Settings while a table is written. Shuffle files of a finished step go with it; else they pile up step by step. What
#: goes to a Python worker at a time is bounded in bytes, however long the texts and sets are.
WRITING = {CLEANUP: "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 22)}


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; one of its own only where that is unset, as in local tests."""
    return (spark.conf.get("spark.checkpoint.dir", None) or _own_folder()).rstrip("/")


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return f"file://{tempfile.mkdtemp(prefix='llm-')}"


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, for drivers that were not started with --py-files or PYTHONPATH."""
    _ship(spark.sparkContext.applicationId, spark.sparkContext)


@lru_cache(maxsize=4)
def _shipped(application: str) -> list:
    return []


def _ship(application: str, context) -> None:
    if not _shipped(application):
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='llm-')}/{package.name}", "zip", package.parent, package.name)
        context.addPyFile(archive)
        _shipped(application).append(archive)


class Scratch:
    """Tables of one run under the shared folder. They outlive lost executors and cut lineage."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.made = 0

    def table(self, df: DataFrame, name: str) -> DataFrame:
        self.made += 1
        path = f"{self.root}/{self.made:03d}-{name}"
        before = {key: self.spark.conf.get(key, None) for key in WRITING}
        for key, value in WRITING.items():
            self.spark.conf.set(key, value)
        try:
            df.write.parquet(path)
        finally:
            for key, value in before.items():
                if value is None:
                    self.spark.conf.unset(key)
                else:
                    self.spark.conf.set(key, value)
        gc.collect()
        self.spark._jvm.System.gc()
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, table: DataFrame) -> None:
        """Delete a table that nothing reads any more."""
        for path in {f.rpartition("/")[0] for f in table.inputFiles()}:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def let(value: Column, use) -> Column:
    """use(value), with value computed once per row, however often use refers to it."""
    return F.transform(F.array(value), use)[0]


def filter_table(ids: DataFrame, column: str) -> DataFrame:
    """Words (word, bits) of a bitmap of hashed ids: FILTER_BITS / 64 rows at most, whatever the number of ids.

    A set bit says "perhaps", so users follow it with an exact join; it only spares moving rows that cannot match.
    """
    return (
        ids.select(filter_bit(column).alias("bit"))
        .groupBy((F.col("bit") / 64).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
    )


def perhaps_in(docs: DataFrame, ids: DataFrame, column: str, flag: str) -> DataFrame:
    """docs with a column that is false only where the filter of ids rules the row out. No row moves."""
    bit = filter_bit(column)
    words = F.broadcast(filter_table(ids, column).withColumnsRenamed({"word": "_word", "bits": "_bits"}))
    marked = docs.join(words, (bit / 64).cast("int") == F.col("_word"), "left")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))
    return marked.select(*docs.columns, F.coalesce(F.col("_bits").bitwiseAND(mask) != 0, F.lit(False)).alias(flag))


def without(docs: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of docs whose column is in no row of ids; NULL never is.

    Rows that the fixed-size filter rules out stay where they are; only the others move to an exact anti join.
    """
    marked = perhaps_in(docs, ids, column, "_perhaps")
    doubtful = marked.where("_perhaps").select(docs.columns).join(ids.select(column), column, "left_anti")
    return marked.where("not _perhaps").select(docs.columns).union(doubtful.select(docs.columns))


def filter_bit(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))
