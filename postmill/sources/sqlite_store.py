"""A Spark data source over SQLite files with a table of addresses, read in ranges of rowid."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from postmill.functions.helpers import partition
from postmill.operators.ingest import skipping
from postmill.schema import FIELDS


def _number(value: object) -> float | None:
    """A coordinate; null if it isn't a number, so that its row is skipped."""
    try:
        return None if value is None else float(value)
    except (TypeError, ValueError):
        return None


@dataclass
class RowRange(InputPartition):
    low: int
    high: int


class SqliteSource(DataSource):
    """Options: path, table (addresses), rows (in one partition, 200000)."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_addresses"

    def schema(self) -> str:
        return "rowid long, lat double, lon double, number string, street string, unit string, city string, district string, region string, postcode string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return SqliteReader(self.options)


class SqliteReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.table, self.rows = options["path"], options.get("table", "addresses"), int(options.get("rows", 200_000))

    def _open(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{self.path}?mode=ro&immutable=1", uri=True)

    def partitions(self) -> list[RowRange]:
        with self._open() as db:
            low, high = db.execute(f'SELECT min(rowid), max(rowid) FROM "{self.table}"').fetchone()
        if low is None:
            return [RowRange(0, -1)]
        return [RowRange(a, b) for a, b in partition(low, high, max(1, -(-(high - low + 1) // self.rows))) if a <= b]

    def read(self, part: RowRange) -> Iterator[pa.RecordBatch]:
        """Batches of rows."""
        columns = ", ".join(f'"{f}"' for f in FIELDS)
        with self._open() as db:
            db.text_factory = lambda raw: raw.decode("utf-8", "replace")
            rows = db.execute(f'SELECT rowid, {columns} FROM "{self.table}" WHERE rowid BETWEEN ? AND ? ORDER BY rowid', (part.low, part.high))
            while some := rows.fetchmany(10_000):
                ids, lat, lon, *texts = zip(*some, strict=True)
                numbers = [pa.array([_number(v) for v in x], pa.float64()) for x in (lat, lon)]
                shown = [pa.array([None if v is None else str(v) for v in x], pa.string()) for x in texts]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *numbers, *shown], names=["rowid", *FIELDS])


def read_sqlite(spark: SparkSession, path: str, table: str = "addresses", rows: int = 200_000, seen: Observation | None = None) -> DataFrame:
    """Addresses of a store; rows without coordinates go, and are counted in `seen`. The file must be readable on every executor."""
    spark.dataSource.register(SqliteSource)
    found = spark.read.format("sqlite_addresses").options(path=path, table=table, rows=rows).load()
    position = F.struct(F.lit(path).alias("file_path"), F.lit(0).cast("long").alias("file_block_start"), F.col("rowid").alias("row")).alias("_position")
    return skipping(found, F.col("lat").isNotNull() & F.col("lon").isNotNull(), seen).select(*FIELDS, position)
