"""From parsed rows to a store: guards, source filter, order, natural key, quarantine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from postmill.functions.geo import in_polygons
from postmill.functions.ranking import rank
from postmill.functions.text import trimmed
from postmill.schema import DUPLICATE_KEY, FIELDS, NULL_COORDINATE

NATURAL_KEY = ("lat", "lon", "number", "street", "city")
#: Order of sources in a store: stores of each kind first, then raw files.
SOURCE_ORDER = ("bano_db", "osm_db", "openaddresses_db", "bano", "osm", "openaddresses")
SOURCE_OF = {"bano_db": "bano", "bano": "bano", "osm_db": "osm", "osm": "osm", "openaddresses_db": "openaddress", "openaddresses": "openaddress"}


def has_place() -> Column:
    return F.col("lat").isNotNull() & F.col("lon").isNotNull() & ~F.isnan("lat") & ~F.isnan("lon")


def skipping(frame: DataFrame, good: Column, seen: Observation | None) -> DataFrame:
    """The rows that are good; `seen` gets how many were `read` and `skipped`, counted as they pass."""
    if seen is None:
        return frame.where(good)
    return frame.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if(~good).alias("skipped")).where(good)


def importer_guard(addresses: DataFrame) -> DataFrame:
    """Rows without street or number go, silently."""
    return addresses.where(F.col("street").isNotNull() & F.col("number").isNotNull())


def number_guard(addresses: DataFrame) -> DataFrame:
    """Rows with an empty house number or 'S/N' (in this case only) go, and those a store can't hold: no street, no place."""
    number = trimmed(F.coalesce("number", F.lit("")))
    return addresses.where(~number.isin("", "S/N") & F.col("street").isNotNull() & has_place())


def source_filter(addresses: DataFrame, region: list[list[list[tuple[float, float]]]]) -> DataFrame:
    """Inside the region only the national source is taken; `region` is a list of polygons of (lon, lat)."""
    return addresses.where((F.col("source") == "bano") | ~in_polygons(F.col("lat"), F.col("lon"), region))


def union_sources(frames: dict[str, DataFrame]) -> DataFrame:
    """All sources one after the other in SOURCE_ORDER, with their source and an `_order` to number rows by."""
    parts = []
    for place, name in enumerate(SOURCE_ORDER):
        if name in frames:
            frame = frames[name]
            position = F.col("_position") if "_position" in frame.columns else F.struct(F.lit("").alias("file_path"), F.lit(0).cast("long").alias("file_block_start"), F.monotonically_increasing_id().alias("row"))
            parts.append(frame.select(*FIELDS, F.lit(SOURCE_OF[name]).alias("source"), F.struct(F.lit(place).alias("place"), position.alias("at")).alias("_order")))
    if not parts:
        raise ValueError("no sources")
    return reduce(DataFrame.unionByName, parts)


def numbered(addresses: DataFrame, order: str = "_order", start: int = 0) -> DataFrame:
    """Ids that rise with the order, from a range partitioning instead of one sorted partition.

    Write the result before using it twice: ids of another run may be others, in the same order.
    """
    return addresses.repartitionByRange(order).sortWithinPartitions(order).withColumn("id", F.monotonically_increasing_id() + F.lit(start)).drop(order)


def ranked(addresses: DataFrame) -> DataFrame:
    return addresses.withColumn("rank", rank(F.col("source")))


def natural_key(addresses: DataFrame, order: str = "id") -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): of rows equal in place, number, street and city the first stays; rows without city never conflict.

    Rejected rows have the fields and a `kind`. Rows without coordinates are rejected too.
    """
    guarded = importer_guard(addresses)
    # Rows without city never conflict, so each has a key of its own instead of meeting in one task.
    alone = F.when(F.col("city").isNull(), F.col(order))
    turn = F.row_number().over(Window.partitionBy(*NATURAL_KEY, alone).orderBy(order))
    marked = guarded.withColumn("_kind", F.when(~has_place(), NULL_COORDINATE).when(F.col("city").isNotNull() & (turn > 1), DUPLICATE_KEY))
    return marked.where(F.col("_kind").isNull()).drop("_kind"), marked.where(F.col("_kind").isNotNull()).select(*FIELDS, F.col("_kind").alias("kind"))
