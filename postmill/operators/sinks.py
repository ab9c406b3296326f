"""The published CSV, written and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.functions.text import empty_to_null, null_to_empty
from postmill.schema import FIELDS, OUTPUT

SCHEMA = ", ".join(f"{name} {'double' if field in ('lat', 'lon') else 'string'}" for name, field in OUTPUT)


def output_projection(addresses: DataFrame) -> DataFrame:
    """OUTPUT columns: null texts are empty, the id always is."""
    shown = {None: F.lit(""), "lat": F.col("lat"), "lon": F.col("lon")}
    return addresses.select(*((shown[f] if f in shown else null_to_empty(F.col(f))).alias(name) for name, f in OUTPUT))


def from_output(rows: DataFrame) -> DataFrame:
    """Addresses of OUTPUT rows: empty texts are null."""
    names = {f: name for name, f in OUTPUT if f}
    return rows.select(*((F.col(names[f]) if f in ("lat", "lon") else empty_to_null(F.col(names[f]))).alias(f) for f in FIELDS))


def write_csv(addresses: DataFrame, path: str, single_file: bool = False, compression: str = "gzip", mode: str = "overwrite") -> None:
    """OUTPUT as CSV with a header, compressed: a folder of files or, with `single_file`, one file at the path.

    One file goes through one task; leave it off for large results.
    """
    out = output_projection(addresses)
    form = {"header": True, "emptyValue": "", "nullValue": "", "escape": '"', "compression": compression}
    if not single_file:
        out.write.mode(mode).options(**form).csv(path)
        return
    spark = addresses.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target, folder = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.parts-{uuid.uuid4().hex}")
    fs = target.getFileSystem(conf)
    if mode != "overwrite" and fs.exists(target):
        raise FileExistsError(path)
    out.coalesce(1).write.options(**form).csv(folder.toString())
    try:
        (part,) = [x.getPath() for x in fs.listStatus(folder) if x.getPath().getName().startswith("part-")]
        fs.delete(target, True)
        if not fs.rename(part, target):
            raise OSError(f"{part.toString()} couldn't be renamed to {path}")
    finally:
        fs.delete(folder, True)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Addresses of a published CSV."""
    return from_output(spark.read.schema(SCHEMA).options(header=True, escape='"').csv(path).fillna(""))
