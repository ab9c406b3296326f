"""Command line: addresses of several sources in, deduplicated CSV out."""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postmill.functions.helpers import logger, parse_duration
from postmill.operators import dedupe, ingest, sinks
from postmill.operators.ingest import skipping
from postmill.operators.osm_graph import osm_addresses
from postmill.operators.store import AddressStore
from postmill.schema import FIELDS
from postmill.sources.bano import read_bano
from postmill.sources.openaddresses import read_openaddresses
from postmill.sources.osm_pbf import read_pbf
from postmill.sources.sqlite_store import read_sqlite


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("postmill", description="Deduplicate addresses from several sources.")
    for name in ("bano", "openaddresses", "osm", "bano-db", "openaddresses-db", "osm-db"):
        p.add_argument(f"--{name}", action="append", default=[], metavar="PATH")
    p.add_argument("--skip-source-filters", action="store_true", help="take all raw sources inside the region (stores are filtered all the same)")
    p.add_argument("--region", metavar="GEOJSON", help="polygons inside which only the national source is taken")
    p.add_argument("--output-db", default="addresses.store")
    p.add_argument("-k", "--keep", action="store_true", help="add to the store that is there, and leave it at the end")
    p.add_argument("-o", "--output-compressed-csv", default="deduplicated.csv.gz")
    p.add_argument("--single-file", action="store_true")
    p.add_argument("--oversize", choices=("delete_all", "keep_all"), default="delete_all")
    p.add_argument("-n", "--num-threads", type=int)
    p.add_argument("--refresh-delay", type=parse_duration, default=parse_duration("1000"), help="accepted; progress is in Spark's UI")
    p.add_argument("-c", "--cache-size", type=int, default=10_000, help="accepted; the store is Parquet")
    return p


def region_of(path: str | None) -> list:
    """Polygons of a GeoJSON geometry, feature or collection."""
    if not path:
        return []
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    out = []
    for item in data.get("features", [data]):
        shape = item.get("geometry", item)
        out += shape["coordinates"] if shape["type"] == "MultiPolygon" else [shape["coordinates"]]
    return [[[tuple(point[:2]) for point in ring] for ring in polygon] for polygon in out]


def opened(spark: SparkSession, path: str, seen: Observation | None = None) -> DataFrame:
    """Addresses of a store given by its path: a folder of this engine or a SQLite file."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(where) and fs.getFileStatus(where).isDirectory():
        rows = AddressStore(spark, path).addresses()
        position = F.struct(F.lit(path).alias("file_path"), F.lit(0).cast("long").alias("file_block_start"), F.col("id").alias("row"))
        return skipping(rows, F.lit(True), seen).select(*FIELDS, position.alias("_position"))
    return read_sqlite(spark, path, seen=seen)


#: How each kind of raw file is read.
READERS: dict[str, Callable[..., DataFrame]] = {
    "bano": read_bano,
    "openaddresses": read_openaddresses,
    "osm": lambda spark, path, seen=None: skipping(osm_addresses(read_pbf(spark, path)), F.lit(True), seen),
}


def import_main(argv: list[str] | None = None) -> None:
    """postmill.cli import KIND PATH...: files of one kind into a store, with the natural key kept unique and rejects apart."""
    p = argparse.ArgumentParser("postmill import")
    p.add_argument("kind", choices=sorted(READERS))
    p.add_argument("path", nargs="+")
    p.add_argument("--output-db", default="addresses.db", help="the store's folder")
    p.add_argument("-k", "--keep", action="store_true", help="add to the store that is there")
    a, log = p.parse_args(argv), logger("import")
    spark = SparkSession.builder.appName("postmill").getOrCreate()
    store = AddressStore(spark, a.output_db, fresh=not a.keep)
    for path in a.path:
        seen = Observation(f"{a.kind} {path}")
        store.add_imported(ingest.union_sources({a.kind: READERS[a.kind](spark, path, seen=seen)}))
        log.info("%s: %d rows read, %d skipped", path, seen.get["read"], seen.get["skipped"])
    log.info("Got %d addresses in %d cities (and %d errors)", store.nb_addresses(), store.nb_cities(), store.nb_errors())
    for kind, n in store.nb_by_errors_kind():
        log.info("  %s => %d occurences", kind, n)


def main(argv: list[str] | None = None) -> None:
    argv = sys.argv[1:] if argv is None else argv
    if argv[:1] == ["import"]:
        import_main(argv[1:])
        return
    a, log = parser().parse_args(argv), logger("main")
    builder = SparkSession.builder.appName("postmill")
    spark = (builder.master(f"local[{a.num_threads}]") if a.num_threads else builder).getOrCreate()
    region = region_of(a.region)
    if not region and not a.skip_source_filters:
        log.warning("no --region is given: all sources are taken everywhere")
    store = AddressStore(spark, a.output_db, fresh=not a.keep)
    for name in ingest.SOURCE_ORDER:
        raw = not name.endswith("_db")
        for path in getattr(a, name):
            if raw and not path:
                continue
            seen = Observation(f"{name} {path}")
            read = READERS[name] if raw else opened
            rows = ingest.union_sources({name: read(spark, path, seen=seen)})
            if region and not (raw and a.skip_source_filters):
                rows = ingest.source_filter(rows, region)
            store.add(rows)
            log.info("%s: %d rows read from %s, %d skipped", name, seen.get["read"], path, seen.get["skipped"])
    addresses = store.addresses()
    blocks = dedupe.block_keys(addresses)
    for r in dedupe.oversized_report(blocks).orderBy("key", "cx", "cy", "place").limit(100).collect():
        log.warning("a block of %d addresses isn't compared (%s): %d", r.n, r.key, r.address)
    kept = store.deduplicated(oversize=a.oversize)
    sinks.write_csv(kept, a.output_compressed_csv, a.single_file)
    log.info("%d of %d addresses are written", sinks.read_csv(spark, a.output_compressed_csv).count(), store.nb_addresses())
    if not a.keep:
        store.remove()


if __name__ == "__main__":
    main()
