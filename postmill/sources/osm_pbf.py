"""A Spark data source over OpenStreetMap extracts in the PBF format: one partition for each blob.

Rows are objects: type, id, lat, lon, tags, nodes (of ways) and refs (of relations). The driver
reads only the headers of the blobs, to learn where each one is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "type string, id long, lat double, lon double, tags map<string,string>, nodes array<long>, refs array<struct<type:string,id:long,role:string>>"
MEMBERS = pa.list_(pa.struct([("type", pa.string()), ("id", pa.int64()), ("role", pa.string())]))
ARROW = pa.schema([("type", pa.string()), ("id", pa.int64()), ("lat", pa.float64()), ("lon", pa.float64()), ("tags", pa.map_(pa.string(), pa.string())), ("nodes", pa.list_(pa.int64())), ("refs", MEMBERS)])
MEMBER = {0: "node", 1: "way", 2: "relation"}


def varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while data[at] & 128:
        value |= (data[at] & 127) << shift
        at, shift = at + 1, shift + 7
    return value | data[at] << shift, at + 1


def message(data: bytes) -> dict[int, list]:
    """Raw values by field number."""
    out: dict[int, list] = {}
    at = 0
    while at < len(data):
        key, at = varint(data, at)
        if key & 7 == 0:
            value, at = varint(data, at)
        elif key & 7 == 2:
            size, at = varint(data, at)
            value, at = data[at : at + size], at + size
        elif key & 7 in (1, 5):
            size = 8 if key & 7 == 1 else 4
            value, at = data[at : at + size], at + size
        else:
            raise ValueError("not a readable block")
        out.setdefault(key >> 3, []).append(value)
    return out


def signed(value: int) -> int:
    return (value >> 1) ^ -(value & 1)


def plain(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def packed(parts: list) -> Iterator[int]:
    for part in parts:
        if isinstance(part, int):
            yield part
            continue
        at = 0
        while at < len(part):
            value, at = varint(part, at)
            yield value


def inflate(blob: bytes) -> bytes:
    fields = message(blob)
    if 1 in fields:
        return fields[1][0]
    if 3 in fields:
        return zlib.decompress(fields[3][0])
    raise ValueError("a blob in a compression that isn't supported")


def objects(block: bytes) -> Iterator[tuple]:
    """Rows of one primitive block."""
    b = message(block)
    strings = [s.decode("utf-8", "replace") for s in message(b[1][0]).get(1, [])]
    step, lat_0, lon_0 = b.get(17, [100])[0], plain(b.get(19, [0])[0]), plain(b.get(20, [0])[0])
    degrees = lambda offset, value: (offset + step * value) * 1e-9
    named = lambda m: {strings[k]: strings[v] for k, v in zip(packed(m.get(2, [])), packed(m.get(3, [])))}
    for group in b.get(2, []):
        g = message(group)
        for raw in g.get(1, []):
            m = message(raw)
            yield ("node", signed(m[1][0]), degrees(lat_0, signed(m[8][0])), degrees(lon_0, signed(m[9][0])), list(named(m).items()), None, None)
        for raw in g.get(2, []):
            m = message(raw)
            ids, lats, lons = (accumulate(map(signed, packed(m.get(f, [])))) for f in (1, 8, 9))
            tags = packed(m.get(10, []))
            for i, lat, lon in zip(ids, lats, lons):
                own = {}
                while k := next(tags, 0):
                    own[strings[k]] = strings[next(tags)]
                yield ("node", i, degrees(lat_0, lat), degrees(lon_0, lon), list(own.items()), None, None)
        for raw in g.get(3, []):
            m = message(raw)
            yield ("way", plain(m[1][0]), None, None, list(named(m).items()), list(accumulate(map(signed, packed(m.get(8, []))))), None)
        for raw in g.get(4, []):
            m = message(raw)
            members = zip(packed(m.get(8, [])), accumulate(map(signed, packed(m.get(9, [])))), packed(m.get(10, [])))
            yield ("relation", plain(m[1][0]), None, None, list(named(m).items()), None, [{"type": MEMBER.get(kind, "?"), "id": i, "role": strings[role]} for role, i, kind in members])


@dataclass
class Blob(InputPartition):
    start: int
    size: int


class PbfSource(DataSource):
    """Option: path."""

    @classmethod
    def name(cls) -> str:
        return "osm_pbf"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return PbfReader(self.options["path"])


class PbfReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Blob]:
        out, at = [], 0
        with open(self.path, "rb") as f:
            while head := f.read(4):
                header = message(f.read(int.from_bytes(head, "big")))
                at, size = f.tell(), header[3][0]
                if header[1][0] == b"OSMData":
                    out.append(Blob(at, size))
                f.seek(at + size)
        return out or [Blob(0, 0)]

    def read(self, part: Blob) -> Iterator[pa.RecordBatch]:
        if not part.size:
            return
        with open(self.path, "rb") as f:
            f.seek(part.start)
            rows = objects(inflate(f.read(part.size)))
        while some := list(islice(rows, 10_000)):
            columns = zip(*some, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, ARROW.types, strict=True)], schema=ARROW)


def read_pbf(spark: SparkSession, path: str) -> DataFrame:
    """Objects of an extract, which must be readable on every executor."""
    spark.dataSource.register(PbfSource)
    return spark.read.format("osm_pbf").option("path", path).load().withColumn("tags", F.coalesce("tags", F.create_map().cast("map<string,string>")))
