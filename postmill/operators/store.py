"""A store of addresses in Parquet: what importers and the deduplicator keep, count and look up."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.operators import dedupe, ingest
from postmill.operators.cutting import cut
from postmill.schema import DUPLICATE_KEY, FIELDS

#: `kind` is null for addresses and the reason of a rejection for other rows.
ROWS = "id long, lat double, lon double, number string, street string, unit string, city string, district string, region string, postcode string, source string, rank double, kind string"


class AddressStore:
    """Addresses (id, fields, source, rank) and rejected rows under one folder, added batch by batch; a batch is in whole or not at all."""

    def __init__(self, spark: SparkSession, path: str, fresh: bool = False):
        self.spark, self.path = spark, path.rstrip("/")
        if fresh:
            self.remove()

    def _folder(self, name: str):
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _has(self, name: str) -> bool:
        fs, where = self._folder(name)
        return fs.exists(where)

    def remove(self) -> None:
        """Drop the store, with its construction files."""
        fs, where = self._folder("")
        fs.delete(where, True)

    def _rows(self) -> DataFrame:
        """All rows of all batches; `kind` says why one was rejected."""
        reader = self.spark.read.schema(ROWS).option("recursiveFileLookup", True)
        return reader.parquet(f"{self.path}/rows") if self._has("rows") else self.spark.createDataFrame([], ROWS)

    def addresses(self) -> DataFrame:
        return self._rows().where(F.col("kind").isNull()).drop("kind")

    def errors(self) -> DataFrame:
        return self._rows().where(F.col("kind").isNotNull()).select(*FIELDS, "kind")

    def _next_id(self) -> int:
        most = self._rows().agg(F.max("id")).first()[0]
        return 0 if most is None else most + 1

    def _write(self, rows: DataFrame, batch: str) -> None:
        """One folder for a batch, published whole by renaming: kept and rejected rows come in together or not at all."""
        staged = f"staged/{uuid.uuid4().hex}"
        rows.select("id", *FIELDS, "source", "rank", "kind").write.parquet(f"{self.path}/{staged}")
        fs, where = self._folder(staged)
        _, target = self._folder(f"rows/{batch}")
        fs.mkdirs(target.getParent())
        fs.delete(target, True)
        if not fs.rename(where, target):
            raise OSError(f"{where} couldn't be renamed to {target}")

    def _fresh(self, batch: str | None) -> str:
        """The batch's folder, emptied of what an earlier try of it has left."""
        name = f"batch-{batch or uuid.uuid4().hex}"
        fs, where = self._folder(f"rows/{name}")
        fs.delete(where, True)
        return name

    def add(self, rows: DataFrame, batch: str | None = None, keep: Callable[[DataFrame], DataFrame] = ingest.number_guard, rank: Callable[[DataFrame], DataFrame] = ingest.ranked) -> None:
        """Add a batch with source and `_order`, rows numbered after those that are there.

        A batch that is added again under the same name takes its own place. `keep` filters rows, `rank` adds the column `rank`.
        """
        name = self._fresh(batch)
        self._write(rank(ingest.numbered(keep(rows), start=self._next_id())).withColumn("kind", F.lit(None).cast("string")), name)

    def add_imported(self, rows: DataFrame, batch: str | None = None, rank: Callable[[DataFrame], DataFrame] = ingest.ranked) -> None:
        """Add a batch of an importer: its natural key is unique over the store, rejected rows are kept apart.

        Only the batch is ordered; what is there is joined by key.
        """
        name = self._fresh(batch)
        numbered = cut(rank(ingest.numbered(rows, start=self._next_id())))
        kept, rejected = ingest.natural_key(numbered)
        there = self.addresses().where(F.col("city").isNotNull()).select(*ingest.NATURAL_KEY).distinct()
        again = kept.join(there, list(ingest.NATURAL_KEY), "left_semi").select("id").withColumn("again", F.lit(True))
        known = kept.join(again, "id", "left").withColumn("kind", F.when(F.col("again"), DUPLICATE_KEY)).drop("again")
        none = rejected.withColumns({"id": F.lit(None).cast("long"), "source": F.lit(None).cast("string"), "rank": F.lit(None).cast("double")})
        self._write(known.unionByName(none, allowMissingColumns=True), name)

    def nb_addresses(self) -> int:
        return self.addresses().count()

    def nb_cities(self) -> int:
        return count_cities(self.addresses()).first()[0]

    def nb_errors(self) -> int:
        return self.errors().count()

    def nb_by_errors_kind(self) -> list[tuple[str, int]]:
        return [(r.kind, r.n) for r in errors_by_kind(self.errors()).orderBy("kind").collect()]

    def get_address(self, number: int, street: str) -> DataFrame:
        return get_address(self.addresses(), number, street)

    def deduplicated(self, **options) -> DataFrame:
        return dedupe.survivors(self.addresses(), **options)


def import_stats(addresses: DataFrame) -> DataFrame:
    """(source, n, cities): addresses and distinct cities by source."""
    return addresses.groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("city").alias("cities"))


def count_cities(addresses: DataFrame) -> DataFrame:
    return addresses.agg(F.count_distinct("city").alias("n"))


def errors_by_kind(errors: DataFrame) -> DataFrame:
    return errors.groupBy("kind").agg(F.count("*").alias("n"))


def get_address(addresses: DataFrame, number: int, street: str) -> DataFrame:
    """Rows with exactly this number (as text) and street."""
    return addresses.where((F.col("number") == str(number)) & (F.col("street") == street))
