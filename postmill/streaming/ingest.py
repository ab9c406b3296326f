"""New files join the store as they arrive; each micro-batch is a batch of the store."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postmill.operators.store import AddressStore
from postmill.schema import FIELDS


def stream_into(store: AddressStore, spark: SparkSession, path: str, source: str, checkpoint: str, schema: str | None = None) -> StreamingQuery:
    """Follow a folder of Parquet addresses and add what is new; stops when all files present are in."""
    fields = schema or ", ".join(f"{f} {'double' if f in ('lat', 'lon') else 'string'}" for f in FIELDS)

    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def add(batch: DataFrame, epoch: int) -> None:
        # A restart gives the same epoch with the same rows; it then takes the place of what it left.
        store.add(batch.withColumns({"source": F.lit(source), "_order": F.struct(F.lit(epoch).alias("epoch"), F.monotonically_increasing_id().alias("row"))}), f"{name}-{epoch}")

    stream = spark.readStream.schema(fields).parquet(path)
    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
