"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import tempfile
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table `name` of a data folder, through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session's spark.checkpoint.dir names; where it is unset a temporary one, on a single machine only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or "-cluster" in spark.sparkContext.master:
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
    return folder.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Spark has it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept by checkpoint() in the shared folder."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(spark))
    # Its shuffle files go with the end of the run, not when the driver next collects garbage.
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        return df.select("*").checkpoint()
    finally:
        spark.conf.set(CLEANUP, before)


def spread_join(rows: DataFrame, facts: DataFrame, key: str, hot: DataFrame | None, how: str = "inner") -> DataFrame:
    """rows joined with facts (one row for each key), where the rows of hot keys are dealt out.

    hot has (key, salts): rows of such a key go to that many tasks, by their place in a table that was
    cut, and its one row of facts to each of them. Its size is bounded by the number of rows over the
    least number that makes a key hot, so it is broadcast.
    """
    if hot is None:
        return rows.join(facts, key, how)
    salts = F.coalesce("salts", F.lit(1))
    dealt = rows.join(F.broadcast(hot), key, "left").withColumn("salt", F.pmod(F.monotonically_increasing_id(), salts).cast("int")).drop("salts")
    many = facts.join(F.broadcast(hot), key, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), (salts - 1).cast("int")))).drop("salts")
    return dealt.join(many, [key, "salt"], how).drop("salt")


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def portions(batches: Iterable[pa.RecordBatch], rows: int, column: str = "text", most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches, sliced to at most `rows` rows and about `most_bytes` of `column`."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            n = min(rows, batch.num_rows - at)
            while n > 1 and batch.column(column).slice(at, n).nbytes > most_bytes:
                n = (n + 1) // 2
            yield batch.slice(at, n)
            at += n


def text_crc(value: object) -> int:
    """crc32 of an id as text; of the empty text where it is null."""
    return zlib.crc32(b"" if value is None else str(value).encode())
