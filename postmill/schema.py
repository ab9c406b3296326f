"""Schemas and constants shared by all parts."""

from __future__ import annotations

from pyspark.sql import types as T

#: Text fields of an address, in order.
TEXT_FIELDS = ("number", "street", "unit", "city", "district", "region", "postcode")
FIELDS = ("lat", "lon", *TEXT_FIELDS)
ADDRESS = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType()), *(T.StructField(f, T.StringType()) for f in TEXT_FIELDS)])
#: Columns of the published CSV, in order, and the address field that each one shows.
OUTPUT = (
    ("ID", None), ("STREET", "street"), ("POSTCODE", "postcode"), ("DISTRICT", "district"), ("REGION", "region"),
    ("CITY", "city"), ("NUMBER", "number"), ("UNIT", "unit"), ("LAT", "lat"), ("LON", "lon"),
)
#: How alike two values are, in rising order.
DIFFERENT, REVIEW, LIKELY, EXACT = 0, 3, 6, 9
#: Sources with their priority: a higher one survives.
PRIORITY = {"openaddress": 1.0, "osm": 2.0, "bano": 3.0}
#: Kinds of rejected rows.
DUPLICATE_KEY, NULL_COORDINATE = "duplicate_key", "null_coordinate"
EARTH_RADIUS_M = 6371008.8
#: Blocks of more addresses than this aren't compared.
LARGEST_BLOCK = 5000
