"""Headerless CSV: id, number, street, postcode, city, source, lat, lon."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill.operators.ingest import skipping
from postmill.schema import FIELDS

NAMES = ("id", "number", "street", "postcode", "city", "origin", "lat", "lon")
CORRUPT = "_corrupt_record"
SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in (*NAMES, CORRUPT)])
#: A decimal number, as strict readers take it (no white space, no type suffix).
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def number(x: Column) -> Column:
    """A double, or null if the text isn't a plain decimal number."""
    return F.when(x.rlike(NUMBER), x.try_cast("double"))


def parsed(raw: DataFrame, seen: Observation | None = None) -> DataFrame:
    """Addresses of raw rows (NAMES, all text): rows without readable coordinates go, empty texts stay empty."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    none = lambda c: F.lit(None).cast("string").alias(c)
    out = raw.select(number(F.col("lat")).alias("lat"), number(F.col("lon")).alias("lon"), text("number"), text("street"), none("unit"), text("city"), none("district"), none("region"), text("postcode"), *(F.col(c) for c in ("_position", CORRUPT) if c in raw.columns))
    good = F.col("lat").isNotNull() & F.col("lon").isNotNull() & (F.col(CORRUPT).isNull() if CORRUPT in raw.columns else F.lit(True))
    return skipping(out, good, seen).select(*FIELDS, *(["_position"] if "_position" in raw.columns else []))


def read_bano(spark: SparkSession, path: str | list[str], seen: Observation | None = None) -> DataFrame:
    """Addresses of one or more files; malformed records are skipped, and counted in `seen`. `_position` orders rows as in the files."""
    raw = (
        spark.read.schema(SCHEMA)
        .options(header=False, escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, nullValue="\u0000", enforceSchema=True)
        .csv(path)
        .withColumn("_position", F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row")))
    )
    return parsed(raw, seen)
