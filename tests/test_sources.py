import json
import sqlite3

from pyspark.sql import Observation
from pyspark.sql import functions as F

from postmill.cli import main
from postmill.operators import ingest, sinks
from postmill.operators.osm_graph import osm_addresses
from postmill.operators.store import AddressStore
from postmill.plans.queries import pbf_blobs
from postmill.schema import FIELDS
from postmill.sources.bano import read_bano
from postmill.sources.openaddresses import read_openaddresses
from postmill.sources.osm_pbf import read_pbf
from postmill.sources.sqlite_store import read_sqlite
from postmill.streaming.ingest import stream_into

OBJECT = "type string, id long, lat double, lon double, tags map<string,string>, nodes array<long>, refs array<struct<type:string,id:long,role:string>>"


def test_bano(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('1,12,"Rue ""A"", B",75001,Paris,OSM,48.5,2.5\n2,13,,75001,,OSM,x,2.5\n3,14,Rue\n4,15,Rue C,,"",OSM,1e1,-2\n5,1,R,,,O,1d,2\n')
    got = {r.number: r for r in read_bano(spark, str(path)).collect()}
    assert set(got) == {"12", "15"}
    assert got["12"].street == 'Rue "A", B' and got["15"].city == "" and got["15"].postcode == "" and got["15"].unit is None and got["15"].lat == 10.0


def feature(number="1", coordinates=(2.5, 48.5), **more):
    return json.dumps({"properties": {"number": number, "street": "S", "unit": "", "city": "C", "district": "", "region": "", "postcode": "1"} | more, "geometry": {"coordinates": coordinates}})


def test_openaddresses(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "deep" / "a.geojson").write_text("\n".join([feature("1"), "broken", feature(2), feature("3", (1, 2, 3)), feature("4", ("1", 2)), "", feature("")]))
    (tmp_path / "in" / "b.json").write_text(feature("9"))
    got = read_openaddresses(spark, str(tmp_path / "in")).collect()
    assert sorted((r.number or "", r.lat, r.lon, r.unit) for r in got) == [("", 48.5, 2.5, None), ("1", 48.5, 2.5, None)]
    assert read_openaddresses(spark, str(tmp_path / "in" / "deep" / "a.geojson")).count() == 2


def test_openaddresses_is_a_stream_of_values(spark, tmp_path):
    one, two, three = (json.loads(feature(n, (2.5, 48.5), street='S "{} }" \\\\ {')) for n in "123")
    (tmp_path / "a.geojson").write_text(json.dumps(one) + json.dumps(two) + " " + json.dumps(three))
    (tmp_path / "b.geojson").write_text("\n".join(json.dumps(x, indent=2) for x in (one, two)) + '\n{"broken": \n' + "}\n" + json.dumps(three, indent=1))
    (tmp_path / "c.geojson").write_text(json.dumps(one) + "\nnot json } {\n" + json.dumps(two) + "\n[1, 2]\n" + json.dumps(three))
    seen = Observation("rows")
    got = read_openaddresses(spark, str(tmp_path), seen).collect()
    assert sorted((r._position.file_path[-9], r.number) for r in got) == [(f, n) for f in "abc" for n in "123"]
    assert {r.street for r in got} == {'S "{} }" \\\\ {'} and seen.get["read"] - seen.get["skipped"] == 9


def test_sqlite(spark, tmp_path):
    path = str(tmp_path / "a.db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE addresses (lat, lon, number TEXT, street TEXT, unit TEXT, city TEXT, district TEXT, region TEXT, postcode TEXT)")
        db.executemany("INSERT INTO addresses VALUES (?,?,?,?,?,?,?,?,?)", [(1.0 + i, 2.0, str(i), "S", None, None, None, None, None) for i in range(5)] + [("x", 1, "9", "S", None, None, None, None, None), (None, 1, "8", "S", None, None, None, None, None)])
    assert sorted(r.number for r in read_sqlite(spark, path, rows=2).collect()) == ["0", "1", "2", "3", "4"]


def test_pbf(spark, tmp_path):
    path, tags = tmp_path / "a.pbf", {"addr:housenumber": "7", "addr:street": "Rue É"}
    nodes = [(i, 48.5 + i * 1e-7, -1.5, tags if i % 2 else {}) for i in range(-3, 9)]
    path.write_bytes(b"".join(pbf_blobs(nodes, 5)))
    got = read_pbf(spark, str(path)).orderBy("id").collect()
    assert [(r.type, r.id, round(r.lat, 7), r.lon, r.tags) for r in got] == [("node", i, round(lat, 7), lon, own) for i, lat, lon, own in nodes]


def test_osm_rules(spark):
    addr = lambda n, s="S": {"addr:housenumber": n, "addr:street": s}
    node = lambda i, tags={}, lat=1.0, lon=1.0: ("node", i, lat, lon, tags, None, None)
    way = lambda i, nodes, tags={}: ("way", i, None, None, tags, nodes, None)
    rel = lambda i, refs, name=None, kind="associatedStreet": ("relation", i, None, None, {"type": kind} | ({"name": name} if name else {}), None, [(t, k, "") for t, k in refs])
    rows = [
        node(1, addr("1")), node(2, addr("123456789")), node(3, addr("éééé")), node(4, addr("ééééé")), node(5, lat=0.0, lon=0.0), node(6, lat=0.0, lon=3.0), node(7, lat=3.0, lon=0.0),
        way(10, [5, 6, 7, 5], addr("10") | {"addr:city": "lost"}), way(11, [5], addr("11")), way(12, [5, 6, 7], addr("12")), way(13, [5, 99, 7, 5], addr("13")), way(14, [5, 6, 7, 5], addr("14")), way(15, [], addr("15")), way(16, [5], addr("16")),
        rel(20, [("node", 1), ("way", 14), ("node", 2)], "Rue R"), rel(21, [("way", 16), ("node", 98)], "Rue Lost"), rel(22, [("relation", 23), ("relation", 24)], "Rue Outer"),
        rel(23, [("node", 3)], "Rue Inner", "x"), rel(24, [("node", 3)], None, "x"), rel(25, [("relation", 25)], "Cycle"), rel(26, [("node", 1)], None),
    ]
    got = sorted((r.number, r.street, r.city) for r in osm_addresses(spark.createDataFrame(rows, OBJECT)).collect())
    assert got == sorted([
        ("1", "S", None), ("éééé", "S", None), ("10", "S", None), ("11", "S", None),
        ("1", "Rue R", None), ("14", "Rue R", None), ("123456789", "Rue R", None), ("éééé", "Rue Inner", None),
    ])


def test_csv_is_complete(spark, tmp_path):
    rows = [(1.5, 2.5, "1", 'Rue "A", b', None, "C", None, None, "1"), (1e-5, -3.0, "2", "x", "u", None, "d", "r", None)]
    kept = spark.createDataFrame(rows, "lat double, lon double, number string, street string, unit string, city string, district string, region string, postcode string")
    sinks.write_csv(kept, str(tmp_path / "one.csv.gz"), single_file=True)
    assert (tmp_path / "one.csv.gz").is_file() and not [p for p in tmp_path.iterdir() if "parts" in p.name]
    assert sorted(map(tuple, sinks.read_csv(spark, str(tmp_path / "one.csv.gz")).collect()), key=repr) == sorted(rows, key=repr)
    sinks.write_csv(kept, str(tmp_path / "out"))
    assert sorted(map(tuple, sinks.read_csv(spark, str(tmp_path / "out")).collect()), key=repr) == sorted(rows, key=repr)
    head = spark.read.text(str(tmp_path / "out")).first().value
    assert head == "ID,STREET,POSTCODE,DISTRICT,REGION,CITY,NUMBER,UNIT,LAT,LON"


def test_store(spark, tmp_path):
    store = AddressStore(spark, str(tmp_path / "store"), fresh=True)
    rows = [(1.0, 2.0, "1", "S", None, "C", None, None, None), (1.0, 2.0, "1", "S", None, "C", None, None, None), (1.0, 2.0, "2", "S", None, None, None, None, None), (1.0, 2.0, "2", "S", None, None, None, None, None), (None, 2.0, "3", "S", None, "C", None, None, None), (1.0, 2.0, None, "S", None, "C", None, None, None)]
    batch = ingest.union_sources({"osm": spark.createDataFrame(rows, "lat double, lon double, number string, street string, unit string, city string, district string, region string, postcode string")})
    store.add_imported(batch)
    assert (store.nb_addresses(), store.nb_cities(), store.nb_errors()) == (3, 1, 2)
    assert store.nb_by_errors_kind() == [("duplicate_key", 1), ("null_coordinate", 1)]
    assert store.get_address(2, "S").count() == 2 and store.get_address(2, "s").count() == 0
    store.add_imported(batch)
    assert store.nb_by_errors_kind() == [("duplicate_key", 3), ("null_coordinate", 2)] and store.nb_addresses() == 5
    before = sorted(r.id for r in store.addresses().collect())
    store.add_imported(batch, "again")
    assert store.nb_addresses() == 7 and len({r.id for r in store.addresses().collect()}) == 7
    store.add_imported(batch, "again")
    assert store.nb_addresses() == 7 and set(before) < {r.id for r in store.addresses().collect()}


def test_a_batch_that_is_tried_again_counts_once(spark, tmp_path):
    store = AddressStore(spark, str(tmp_path / "store"), fresh=True)
    rows = spark.createDataFrame([(1.0, 2.0, "1", "S", None, "C", None, None, None)], "lat double, lon double, number string, street string, unit string, city string, district string, region string, postcode string")
    for name in ("a", "b", "b", "a"):
        store.add(ingest.union_sources({"osm": rows}), name, keep=lambda x: x.where("number = '1'"), rank=lambda x: x.withColumn("rank", F.lit(7.0)))
    assert store.nb_addresses() == 2 and {r["rank"] for r in store.addresses().collect()} == {7.0}


def test_deep_relations_give_their_addresses(spark):
    rel = lambda i, refs, name: ("relation", i, None, None, {"type": "associatedStreet" if i == 100 else "x", "name": name}, None, [(t, k, "") for t, k in refs])
    chain = [rel(100 + i, [("relation", 101 + i)], f"Rue {i}") for i in range(6)] + [rel(106, [("node", 1)], "Rue Deep")]
    rows = [("node", 1, 1.0, 1.0, {"addr:housenumber": "1"}, None, None), *chain, rel(200, [("relation", 201)], "A"), rel(201, [("relation", 200)], "B")]
    assert [(r.number, r.street) for r in osm_addresses(spark.createDataFrame(rows, OBJECT)).collect()] == [("1", "Rue Deep")]


def test_importers_and_their_stores(spark, tmp_path, caplog):
    (tmp_path / "a.csv").write_text("1,12,Rue A,75001,Paris,OSM,48.5,2.5\n2,12,Rue A,75001,Paris,OSM,48.5,2.5\n3,13,Rue A,75001,Paris,OSM,x,2.5\n4,14,Rue B,75001,Paris,OSM,48.5,2.6\n5,14\n")
    (tmp_path / "b.geojson").write_text(feature("12", (2.5, 48.5), street="Rue A") + "\n" + feature("99", (2.5, 10.0)))
    main(["import", "bano", str(tmp_path / "a.csv"), "--output-db", str(tmp_path / "bano.store")])
    main(["import", "openaddresses", str(tmp_path / "b.geojson"), "--output-db", str(tmp_path / "oa.store")])
    bano = AddressStore(spark, str(tmp_path / "bano.store"))
    assert (bano.nb_addresses(), bano.nb_errors()) == (2, 1)
    main(["--bano-db", str(tmp_path / "bano.store"), "--openaddresses-db", str(tmp_path / "oa.store"), "--output-db", str(tmp_path / "store"), "-o", str(tmp_path / "o.csv.gz"), "--single-file"])
    assert sorted(r.number for r in sinks.read_csv(spark, str(tmp_path / "o.csv.gz")).collect()) == ["12", "14", "99"]


def test_skipped_rows_are_counted(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,12,Rue A,75001,Paris,OSM,48.5,2.5\n2,12,a,b,c,d,x,2.5\n3,14\n")
    seen = Observation("bano")
    assert read_bano(spark, str(tmp_path / "a.csv"), seen).count() == 1 and seen.get == {"read": 3, "skipped": 2}


def test_streaming(spark, tmp_path):
    store = AddressStore(spark, str(tmp_path / "store"), fresh=True)
    kind = "lat double, lon double, number string, street string, unit string, city string, district string, region string, postcode string"
    one = spark.createDataFrame([(1.0, 2.0, "1", "S", None, "C", None, None, None), (1.0, 2.0, " S/N ", "S", None, "C", None, None, None)], kind)
    for _ in range(2):
        one.write.mode("append").parquet(str(tmp_path / "new"))
        stream_into(store, spark, str(tmp_path / "new"), "osm", str(tmp_path / "state")).awaitTermination()
    assert store.nb_addresses() == 2 and store.deduplicated().count() == 1


def test_command_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,12,Rue A,75001,Paris,OSM,48.5,2.5\n2,12,rue a,75001,Paris,OSM,48.50001,2.5\n")
    (tmp_path / "b.geojson").write_text("\n".join([feature("12", (2.5, 48.5), street="Rue A"), feature("99", (2.5, 10.0))]))
    region = {"type": "Polygon", "coordinates": [[[0, 40], [5, 40], [5, 50], [0, 50], [0, 40]]]}
    (tmp_path / "region.json").write_text(json.dumps(region))
    common = ["--bano", str(tmp_path / "a.csv"), "--openaddresses", str(tmp_path / "b.geojson"), "--openaddresses", "", "--output-db", str(tmp_path / "store")]
    main([*common, "--region", str(tmp_path / "region.json"), "-o", str(tmp_path / "out"), "--keep"])
    got = sinks.read_csv(spark, str(tmp_path / "out")).collect()
    assert sorted(r.number for r in got) == ["12", "99"] and len(FIELDS) == 9
    assert AddressStore(spark, str(tmp_path / "store")).nb_addresses() == 3
    main([*common, "--skip-source-filters", "--region", str(tmp_path / "region.json"), "-o", str(tmp_path / "out"), "--keep"])
    assert AddressStore(spark, str(tmp_path / "store")).nb_addresses() == 7
