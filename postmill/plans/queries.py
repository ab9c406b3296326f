"""Every operator as a query over the driver tables, next to SQL for the same rows."""

from __future__ import annotations

import os
import sqlite3
import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postmill.functions import compare, geo, ranking, text
from postmill.functions.helpers import partition
from postmill.operators import dedupe, ingest, osm_graph, sinks, store
from postmill.operators.cutting import shared_base
from postmill.plans import dialect as d
from postmill.plans.views import PLANTED, RANKED, addresses, customers, duck_sql, spark_sql
from postmill.schema import FIELDS, TEXT_FIELDS
from postmill.sources import bano, openaddresses
from postmill.sources.osm_pbf import read_pbf
from postmill.sources.sqlite_store import read_sqlite

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
ADDR = f"with addr as ({duck_sql(RANKED)})"


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE[f.__name__] = oracle
        return f

    return add


def new_folder(spark: SparkSession) -> str:
    """A new folder that all executors see."""
    return f"{shared_base(spark)}/postmill-{uuid.uuid4().hex}"


def shared_file(spark: SparkSession, name: str) -> str:
    """Where to write a small file that plain readers open on all executors; the shared folder must be mounted."""
    folder = new_folder(spark).removeprefix("file://")
    os.makedirs(folder)
    return os.path.join(folder, name)


def named(spark: SparkSession, folder: str, ending: str) -> None:
    """Give all files that Spark wrote to a folder another ending."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    for x in fs.listStatus(where):
        name = x.getPath().getName()
        if name.startswith("part-"):
            fs.rename(x.getPath(), spark._jvm.org.apache.hadoop.fs.Path(where, name.rsplit(".", 1)[0] + ending))


# Ranking and guards


@query(f"""{ADDR} select id, source, case source when 'openaddress' then 1.0::double when 'osm' then 2.0::double else 3.0::double end as priority,
  cast(4 + (city is not null)::int + (postcode is not null)::int as integer) as n_fields, round(rank, 9) as rank from addr""")
def q_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = addresses(spark, sf_dir).drop("rank")
    return a.select("id", "source", ranking.priority(F.col("source")).alias("priority"), ranking.non_empty_fields().alias("n_fields"), F.round(ranking.rank(F.col("source")), 9).alias("rank"))


NUMBERS = "case id % 7 when 0 then '' when 1 then concat(' ', 'S/N', ' ') when 2 then concat(CHR(9), number) when 3 then null when 4 then 's/n' else number end"


@query(f"""{ADDR}, n as (select id, {NUMBERS.replace('CHR', 'chr')} as number from addr) select id, number from n where trim(coalesce(number, ''), concat(' ',
  chr(9), chr(10), chr(13))) not in ('', 'S/N')""")
def q_guard_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = addresses(spark, sf_dir).withColumn("number", F.expr(NUMBERS.replace("CHR", "char")))
    return ingest.number_guard(a).select("id", "number")


@query(f"""{ADDR}, n as (select id, nullif(number, '7') as number, case when id % 11 = 0 then null else street end as street from addr) select id, number,
  street from n where number is not null and street is not null""")
def q_guard_importer(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = addresses(spark, sf_dir).withColumns({"number": F.nullif("number", F.lit("7")), "street": F.when(F.col("id") % 11 != 0, F.col("street"))})
    return ingest.importer_guard(a).select("id", "number", "street")


BOX = [[[(-1.6, 40.305), (-1.495, 40.305), (-1.495, 41.205), (-1.6, 41.205), (-1.6, 40.305)]]]


@query(f"{ADDR} select id, source from addr where source = 'bano' or not (lon > -1.6 and lon < -1.495 and lat > 40.305 and lat < 41.205)")
def q_source_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.source_filter(addresses(spark, sf_dir), BOX).select("id", "source")


# Natural key and quarantine

TWICE = "twice as (select * from addr union all select id + 1000000000 as id, * exclude (id) from addr where id % 5 = 0)"
TURN = """marked as (select *, case when lat is null then 'null_coordinate' when city is not null and row_number() over (partition by lat, lon, number, street,
  city order by id) > 1 then 'duplicate_key' end as kind from twice)"""


def twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = addresses(spark, sf_dir)
    return a.unionByName(a.where(F.col("id") % 5 == 0).withColumn("id", F.col("id") + 1_000_000_000))


@query(f"{ADDR}, {TWICE}, {TURN} select id, city from marked where kind is null")
def q_natural_key_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.natural_key(twice(spark, sf_dir))[0].select("id", "city")


@query(f"{ADDR}, {TWICE}, {TURN} select lat, lon, number, street, city, kind from marked where kind is not null")
def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.natural_key(twice(spark, sf_dir))[1].select("lat", "lon", "number", "street", "city", "kind")


@query(f"{ADDR}, {TWICE}, {TURN} select kind, count(*) as n from marked where kind is not null group by kind")
def q_errors_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.errors_by_kind(ingest.natural_key(twice(spark, sf_dir))[1])


# Counts and look-ups


@query(f"{ADDR} select count(*) as n from addr")
def q_count_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addresses(spark, sf_dir).agg(F.count("*").alias("n"))


@query(f"{ADDR} select count(distinct city) as n from addr")
def q_count_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.count_cities(addresses(spark, sf_dir))


@query(f"{ADDR} select id, number, street, city from addr where number = '12' and street = 'av. etoile 11'")
def q_get_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.get_address(addresses(spark, sf_dir), 12, "av. etoile 11").select("id", "number", "street", "city")


@query(f"{ADDR} select source, count(*) as n, count(distinct city) as cities from addr group by source")
def q_import_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.import_stats(addresses(spark, sf_dir))


# Text forms and comparison

KEYED = f"""keyed as (select *, {d.number_key('number')} as k_number, {d.expand(d.fold('street'))} as k_street, {d.fold('city')} as k_city,
  {d.postcode_key('postcode')} as k_postcode from addr), forms as (select *, {d.light('k_street')} as k_light, {d.core('k_street')} as k_core
  from keyed)"""


@query(f"{ADDR}, {KEYED} select id, {d.fold('street')} as folded, k_street as expanded, k_light as light, k_core as core, k_number as number_key from forms")
def q_normalize_street(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = compare.with_keys(addresses(spark, sf_dir))
    return a.select("id", text.fold(F.col("street")).alias("folded"), F.col("k_street").alias("expanded"), F.col("k_light").alias("light"), F.col("k_core").alias("core"), F.col("k_number").alias("number_key"))


SPELLED = """select id, number, case id % 5 when 0 then concat(number, ' bis') when 1 then concat(number, 'BIS') when 2 then number when 3 then null
  else concat(number, '/2') end as other, case when id % 6 = 0 then null when id % 2 = 0 then concat(number, 'bis') else number end as one from"""


@query(f"{ADDR}, s as ({SPELLED} addr) select id, one, other, case when {d.number_key('one')} = {d.number_key('other')} then 9 else 0 end as status from s")
def q_house_number_cmp(spark: SparkSession, sf_dir: str) -> DataFrame:
    addresses(spark, sf_dir).createOrReplaceTempView("addr_numbers")
    return spark.sql(f"{SPELLED} addr_numbers").select("id", "one", "other", compare.number_status(F.col("one"), F.col("other")).alias("status"))


@query(f"""{ADDR}, s as ({SPELLED} addr) select id, case when one is null or other is null then 0 when one = other then 9
  when {d.number_key('one')} = {d.number_key('other')} then 9 else 0 end as status from s""")
def q_field_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    addresses(spark, sf_dir).createOrReplaceTempView("addr_numbers")
    return spark.sql(f"{SPELLED} addr_numbers").select("id", compare.field_compare(F.col("one"), F.col("other"), compare.number_status).alias("status"))


@query(f"""{ADDR}, s as ({SPELLED} addr) select id, case when one is null and other is null then 9 when one is null or other is null then 0
  when one = other then 9 when {d.number_key('one')} = {d.number_key('other')} then 9 else 0 end as status from s""")
def q_opt_field_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    addresses(spark, sf_dir).createOrReplaceTempView("addr_numbers")
    return spark.sql(f"{SPELLED} addr_numbers").select("id", compare.opt_field_compare(F.col("one"), F.col("other"), compare.number_status).alias("status"))


STATUS = """case when x.street is null or y.street is null then 0 when x.street = y.street then 9 when x.k_street = y.k_street then 9
  when x.k_light = y.k_light then 6 when x.k_core = y.k_core then 3 else 0 end"""


@query(f"{ADDR}, {KEYED} select x.id as a, y.id as b, {STATUS} as status from forms x join forms y on x.g = y.g and x.v < y.v")
def q_street_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = addresses(spark, sf_dir)
    x, y = a.alias("x"), a.alias("y")
    return x.join(y, (F.col("x.g") == F.col("y.g")) & (F.col("x.v") < F.col("y.v"))).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), compare.field_compare(F.col("x.street"), F.col("y.street"), compare.street_status).alias("status"))


@query(f"""{ADDR} select x.id as a, y.id as b, round({d.haversine('x.lat', 'x.lon', 'y.lat', 'y.lon')}, 3) as metres from addr x join addr y on x.g = y.g
  and x.v < y.v""")
def q_haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = addresses(spark, sf_dir)
    x, y = a.alias("x"), a.alias("y")
    metres = geo.haversine(F.col("x.lat"), F.col("x.lon"), F.col("y.lat"), F.col("y.lon"))
    return x.join(y, (F.col("x.g") == F.col("y.g")) & (F.col("x.v") < F.col("y.v"))).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.round(metres, 3).alias("metres"))


# Cells and blocks


@query(f"{ADDR} select id, {d.cell_x('lon')} as cx, {d.cell_y('lat')} as cy from addr")
def q_geo_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addresses(spark, sf_dir).select("id", geo.cell_x(F.col("lon")).alias("cx"), geo.cell_y(F.col("lat")).alias("cy"))


BLOCKS = f"""{KEYED}, steps as (select unnest([-1, 0, 1]) as s), blocks as (
  select id as address, concat(k_number, '|', k_core) as key, cast(({d.cell_x('lon')} + i.s + 8192) % 8192 as integer) as cx, cast({d.cell_y('lat')} + j.s as integer) as cy
  from forms, steps i, steps j)"""


@query(f"{ADDR}, {BLOCKS} select address, key, cx, cy from blocks")
def q_block_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.block_keys(addresses(spark, sf_dir))


@query(f"{ADDR}, {BLOCKS} select count(*) as n, count(distinct (key, cx, cy)) as blocks from blocks")
def q_count_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.hashes(addresses(spark, sf_dir)).agg(F.count("*").alias("n"), F.count_distinct("hash").alias("blocks"))


@query(f"{ADDR}, {BLOCKS} select cast(coalesce(sum(n), 0) as bigint) as n from (select count(*) as n from blocks group by key, cx, cy having count(*) > 1) t")
def q_count_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.count_collisions(dedupe.hashes(addresses(spark, sf_dir)))


EXISTS = f"""{ADDR}, {BLOCKS} select address, key, cx, cy from blocks b where exists (select 1 from blocks o where o.key = b.key and o.cx = b.cx
  and o.cy = b.cy and o.address <> b.address)"""


@query(EXISTS)
def q_collisions_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.collisions_by_pairs(dedupe.block_keys(addresses(spark, sf_dir)))


@query(EXISTS)
def q_collisions_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.collisions(dedupe.block_keys(addresses(spark, sf_dir)))


@query(f"""{ADDR}, {BLOCKS} select key, cx, cy, address, cast(row_number() over (partition by key, cx, cy order by rank desc, id desc) as integer) as place
  from blocks join addr on addr.id = address""")
def q_pack_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = addresses(spark, sf_dir)
    return dedupe.in_order(dedupe.block_keys(a), a)


@query(f"""{ADDR}, {BLOCKS}, big as (select key, cx, cy, count(*) as n from blocks group by key, cx, cy having count(*) > 3) select key, cx, cy, n, address,
  place from (select key, cx, cy, n, address, cast(row_number() over (partition by key, cx, cy order by address) as integer) as place
  from blocks join big using (key, cx, cy)) t where place <= 10""")
def q_oversize_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten members of each block of more than three: the report on oversized blocks, with a small limit."""
    return dedupe.oversized_report(dedupe.block_keys(addresses(spark, sf_dir)), limit=3)


@query("""select cast(part as bigint) as part, cast(-100 + part * 1001 // 7 as bigint) as low, cast(-100 + (part + 1) * 1001 // 7 - 1 as bigint) as high
  from range(7) t(part)""")
def q_partition_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(partition(-100, 900, 7))], "part long, low long, high long")


# Deduplication

BETTER = "(x.rank > y.rank or (x.rank = y.rank and x.id > y.id))"
DISTANCE = d.haversine("x.lat", "x.lon", "y.lat", "y.lon")
NUMBER = """case when x.number is null and y.number is null then 9 when x.number is null or y.number is null then 0 when x.number = y.number
  or x.k_number = y.k_number then 9 else 0 end"""
SAME = lambda f: f"case when x.{f} is null or y.{f} is null then 0 when x.{f} = y.{f} or x.k_{f} = y.k_{f} then 9 else 0 end"
PAIRS = f"""near as (
  select x.id as better, y.id as worse, {DISTANCE} as metres, {NUMBER} as n, {STATUS} as s, {SAME('city')} as c, {SAME('postcode')} as p
  from forms x join forms y on x.k_number = y.k_number and x.k_core = y.k_core and {BETTER}
    and abs(x.lat - y.lat) < 0.02 and abs(x.lon - y.lon) < 0.05),
pairs as (select better, worse from near where metres < 1000 and n = 9 and ((metres < 10 and s >= 3) or (metres < 100 and s >= 6) or (s = 9 and c = 9 and p = 9)))"""
FOLD = f"""{PAIRS}, beside as (select worse, list(better) as near from pairs group by worse),
members as (
  select key, cx, cy, address as id, coalesce(near, []) as near, row_number() over (partition by key, cx, cy order by rank desc, address desc) as turn
  from blocks join addr on addr.id = address left join beside on worse = address),
walk as (
  select key, cx, cy, turn, [id] as kept from members where turn = 1
  union all
  select m.key, m.cx, m.cy, m.turn, case when list_has_any(w.kept, m.near) then w.kept else list_append(w.kept, m.id) end
  from walk w join members m on m.key = w.key and m.cx = w.cx and m.cy = w.cy and m.turn = w.turn + 1),
last as (select key, cx, cy, kept from (select *, row_number() over (partition by key, cx, cy order by turn desc) as r from walk) t where r = 1),
gone as (select distinct m.id as address_id from members m join last l using (key, cx, cy) where not list_contains(l.kept, m.id))"""
RECURSIVE = ADDR.replace("with addr", "with recursive addr")


@query(f"{ADDR}, {KEYED}, {PAIRS} select better, worse from pairs")
def q_duplicate_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.duplicate_pairs(addresses(spark, sf_dir))


@query(f"{RECURSIVE}, {BLOCKS}, {FOLD} select address_id from gone")
def q_to_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.to_delete(addresses(spark, sf_dir))


@query(f"{RECURSIVE}, {BLOCKS}, {FOLD} select id, round(rank, 9) as rank, number, street, city from addr where id not in (select address_id from gone)")
def q_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: what is left of all addresses after deduplication."""
    return dedupe.survivors(addresses(spark, sf_dir)).select("id", F.round("rank", 9).alias("rank"), "number", "street", "city")


BIG = "big as (select key, cx, cy from blocks group by key, cx, cy having count(*) > 3)"


ALIVE = "alive as (select b.* from blocks b anti join big using (key, cx, cy))"
FOLD_ALIVE = FOLD.replace("from blocks join addr", "from alive join addr")


@query(
    f"""{RECURSIVE}, {BLOCKS}, {BIG}, {ALIVE}, {FOLD_ALIVE}
select address_id from gone union select address as address_id from blocks join big using (key, cx, cy)"""
)
def q_oversize_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletions with a limit of three: all members of larger blocks, and the losers of the others."""
    return dedupe.to_delete(addresses(spark, sf_dir), limit=3)


@query(f"{RECURSIVE}, {BLOCKS}, {FOLD} select lat, lon, number, street, city from addr where id not in (select address_id from gone)")
def q_idempotence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten copies of all addresses leave what one copy leaves."""
    a = addresses(spark, sf_dir)
    copies = a.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(9)))).withColumn("id", F.col("id") + F.col("copy") * F.lit(10_000_000_000))
    return dedupe.survivors(copies).select("lat", "lon", "number", "street", "city")


@query(
    f"""{ADDR} select id as was, source, number, street,
  cast(row_number() over (partition by number order by case source when 'bano' then 0 when 'osm' then 1 else 2 end, id) as integer) as turn from addr"""
)
def q_union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of three sources with their turn among those of one house number, by the ids that the union gives them."""
    a = addresses(spark, sf_dir)
    position = F.struct(F.lit("file").alias("file_path"), F.lit(0).cast("long").alias("file_block_start"), F.col("id").alias("row"))
    kept = [*FIELDS, position.alias("_position")]
    frames = {name: a.where(F.col("source") == s).select(*kept) for name, s in (("openaddresses", "openaddress"), ("osm", "osm"), ("bano", "bano"))}
    united = ingest.numbered(ingest.union_sources(frames).withColumn("was", F.col("_order.at.row")))
    turn = F.row_number().over(Window.partitionBy("number").orderBy("id"))
    return united.select("was", "source", "number", "street", turn.alias("turn"))


#: Rows of the first batch come before those of the second one.
RENUMBERED = RECURSIVE.replace("addr as (", "was as (") + ", addr as (select * replace (row_number() over (order by id % 2, id) as id) from was)"


@query(
    f"""{RENUMBERED}, {BLOCKS}, {FOLD}
select round(lat, 9) as lat, round(lon, 9) as lon, number, street, source from addr where id not in (select address_id from gone)"""
)
def q_incremental_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A kept store, and a second batch that is added to it, are deduplicated together."""
    kept, a = store.AddressStore(spark, new_folder(spark)), addresses(spark, sf_dir)
    for low in (0, 1):
        kept.add(a.where(F.col("id") % 2 == low).select(*FIELDS, "source", F.col("id").alias("_order")))
    return kept.deduplicated().select(F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"), "number", "street", "source")


# Output

SHOWN = """select '' as "ID", coalesce(street, '') as "STREET", coalesce(postcode, '') as "POSTCODE", coalesce(district, '') as "DISTRICT", coalesce(region,
  '') as "REGION", coalesce(city, '') as "CITY", coalesce(number, '') as "NUMBER", coalesce(unit, '') as "UNIT", lat as "LAT", lon as "LON" from addr"""


@query(f"{ADDR} {SHOWN}")
def q_output_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.output_projection(addresses(spark, sf_dir))


@query(f"{ADDR} select {', '.join(FIELDS)} from addr")
def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    sinks.write_csv(addresses(spark, sf_dir), folder)
    return sinks.read_csv(spark, folder)


# Sources

OA_LINE = """case id % 6 when 0 then concat('{"properties":{"number":"', number, '","street":"', street, '","unit":"","city":"","district":"","region":"","postcode":"1"},"geometry":{"coordinates":[', lon, ',', lat, ']}}')
  when 1 then concat('{"properties":{"number":12,"street":"', street, '","unit":"","city":"","district":"","region":"","postcode":""},"geometry":{"coordinates":[1.5,2.5]}}')
  when 2 then '{"properties":{"number":"1"},"geometry":{"coordinates":[1.5,2.5]}}'
  when 3 then concat('{"properties":{"number":"', number, '","street":"x","unit":"u","city":"c","district":"d","region":"r","postcode":""},"geometry":{"coordinates":[1.5,2.5,3.5]}}')
  when 4 then 'not json'
  else concat('{"properties":{"number":"","street":"', street, '","unit":"u","city":"c","district":"d","region":"r","postcode":"2"},"geometry":{"coordinates":[1,2]}}') end"""


@query(
    f"""{ADDR.replace('addr as', 'planted as')} select * from (select case when id % 6 = 0 then round(lat, 6) else 2.0 end as lat, case
  when id % 6 = 0 then round(lon, 6) else 1.0 end as lon, case when id % 6 = 0 then number end as number, street, case
  when id % 6 = 5 then 'u' end as unit, case when id % 6 = 5 then 'c' end as city, case when id % 6 = 5 then 'd' end as district, case
  when id % 6 = 5 then 'r' end as region, case when id % 6 = 0 then '1' else '2' end as postcode from planted where id % 6 in (0, 5)) t"""
)
def q_oa_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of features, a third of them strictly right, written here; a sixth of the values go over two lines."""
    lines = addresses(spark, sf_dir).select(F.expr(OA_LINE).alias("value"))
    folder = new_folder(spark)
    lines.select(F.when(F.col("value").contains('"postcode":"2"'), F.replace("value", F.lit(',"geometry"'), F.lit('\n,"geometry"'))).otherwise(F.col("value")).alias("value")).write.text(folder)
    named(spark, folder, ".geojson")
    found = openaddresses.read_openaddresses(spark, folder).drop("_position")
    return found.withColumns({"lat": F.round("lat", 6), "lon": F.round("lon", 6)})


BANO_LAT = "case id % 5 when 0 then '' when 1 then concat(' ', cast(g as STR)) when 2 then '1d' when 3 then concat(cast(g as STR), '.5') else concat(cast(g % 90 as STR), 'e-1') end"


@query(f"""{ADDR} select round(case when id % 5 = 3 then cast(g as double) + 0.5::double else cast(g % 90 as double) * 0.1::double end, 6) as lat, round(lon,
  6) as lon, number, '' as street, cast(null as varchar) as unit, coalesce(city, '') as city, cast(null as varchar) as district,
  cast(null as varchar) as region, coalesce(postcode, '') as postcode from addr where id % 5 in (3, 4)""")
def q_bano_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of records written here: unreadable coordinates go, as do short records; empty texts stay empty."""
    a, folder = addresses(spark, sf_dir), new_folder(spark)
    quoted = lambda c: F.concat(F.lit('"'), F.coalesce(c, F.lit("")), F.lit('"'))
    whole = F.concat_ws(",", F.col("id").cast("string"), "number", F.lit(""), quoted(F.col("postcode")), quoted(F.col("city")), F.lit("OSM"), F.expr(spark_sql(BANO_LAT)), F.col("lon").cast("string"))
    a.select(F.explode(F.array(whole, F.concat(F.lit("short,"), "number"))).alias("value")).write.text(folder)
    return bano.read_bano(spark, folder).drop("_position").withColumns({"lat": F.round("lat", 6), "lon": F.round("lon", 6)})


# OpenStreetMap

TAGS = """case id % 5
  when 0 then map('addr:housenumber', number, 'addr:street', street, 'addr:city', 'x', 'shop', 'y')
  when 1 then map('addr:housenumber', '123456789', 'addr:street', street)
  when 2 then map('addr:housenumber', 'éééé', 'addr:street', street)
  when 3 then map('addr:street', street)
  else map('addr:housenumber', 'ééééé', 'addr:street', street) end"""


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = addresses(spark, sf_dir)
    kinds = F.element_at(F.lit(["node", "way", "relation"]), (F.col("id") % 3 + 1).cast("int"))
    tags = F.when(kinds == "relation", F.create_map(F.lit("type"), F.when(F.col("id") % 2 == 0, "associatedStreet").otherwise("site"), F.lit("name"), F.col("street"))).otherwise(F.expr(TAGS))
    objects = a.select(kinds.alias("type"), "id", "lat", "lon", tags.alias("tags"), F.when(F.col("id") % 4 == 0, F.array().cast("array<bigint>")).otherwise(F.array("id")).alias("nodes"), F.array(F.struct(F.lit("node").alias("type"), F.col("id"), F.lit("").alias("role"))).alias("refs"))
    # A generator keeps Spark from writing the long expression of the tags into each of their uses.
    return objects.select(F.explode(F.array(F.struct("*"))).alias("o")).select("o.*")


@query(f"""{ADDR} select id, case id % 3 when 0 then 'node' when 1 then 'way' else 'relation' end as type from addr where (id % 3 = 0 and id % 5 in (0, 2))
  or (id % 3 = 1 and id % 5 in (0, 2) and id % 4 <> 0) or (id % 3 = 2 and id % 2 = 0)""")
def q_osm_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagged(spark, sf_dir).where(osm_graph.is_root()).select("id", "type")


@query(
    f"""{ADDR} select id, case when id % 3 = 2 or id % 5 = 3 then null when id % 5 = 0 then number when id % 5 = 1 then '123456789'
  when id % 5 = 2 then 'éééé' else 'ééééé' end as number, case when id % 3 = 2 then null else street end as street, case when id % 3 = 0
  and id % 5 = 0 then 'x' end as city, cast(case when id % 3 = 2 then 1 when id % 5 = 0 then case when id % 3 = 0 then 3 else 2 end
  when id % 5 = 3 then 1 else 2 end as integer) as n_tags from addr"""
)
def q_osm_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tagged(spark, sf_dir).withColumn("tags", osm_graph.pruned_tags())
    return t.select("id", osm_graph.tag("addr:housenumber").alias("number"), osm_graph.tag("addr:street").alias("street"), osm_graph.tag("addr:city").alias("city"), F.size("tags").alias("n_tags"))


RINGS = """select g as id, 40.0 + cast(g % 200 as double) * 0.01 as y, -1.5 + cast(g % 90 as double) * 0.01 as x, cast(g % 5 + 1 as double) * 0.001 as w,
  g % 4 as kind from (select distinct cast((c_custkey - c_custkey % 4) / 4 as bigint) as g from customer) t"""


def drawn(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(ways, nodes): right triangles, closed (kind 0 and 1), open (2), or of one node (3)."""
    customers(spark, sf_dir)
    r = spark.sql(RINGS)
    corner = lambda i, lat, lon: F.struct((F.col("id") * 10 + i).alias("id"), lat.alias("lat"), lon.alias("lon"))
    nodes = r.select(F.explode(F.array(corner(0, F.col("y"), F.col("x")), corner(1, F.col("y") + F.col("w"), F.col("x")), corner(2, F.col("y"), F.col("x") + 2 * F.col("w")))).alias("n")).select("n.*")
    path = F.when(F.col("kind") < 2, F.array(F.lit(0), F.lit(1), F.lit(2), F.lit(0))).when(F.col("kind") == 2, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return r.select("id", F.create_map(F.lit("addr:housenumber"), F.lit("1"), F.lit("addr:street"), F.lit("s")).alias("tags"), F.transform(path, lambda i: F.col("id") * 10 + i).alias("nodes")), nodes


@query(f"""with r as ({RINGS}) select id, round(case when kind < 2 then y + w / 3 when kind = 3 then y + w end, 6) as lat, round(case
  when kind < 2 then x + 2 * w / 3 when kind = 3 then x end, 6) as lon from r""")
def q_osm_way_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = osm_graph.placed_ways(*drawn(spark, sf_dir))
    return placed.select("id", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query(
    f"""with r as ({RINGS}), s as (select id, case when kind = 1 then concat('Street ', cast(id as varchar)) else 's' end as street, round(case
  when kind < 2 then y + w / 3 else y + w end, 6) as lat, round(case when kind < 2 then x + 2 * w / 3 else x end, 6) as lon, kind from r
  where kind <> 2) select lat, lon, '1' as number, street from s union all select round(y, 6), round(x, 6), null, concat('Deep ',
  cast(id as varchar)) from r where kind = 2"""
)
def q_osm_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ways alone, ways (kind 1) in a street relation, which gives them its name, relations that lack a member, and nodes under five relations."""
    ways, nodes = drawn(spark, sf_dir)
    none = lambda t: F.lit(None).cast(t)
    refs = "array<struct<type:string,id:long,role:string>>"
    empty = F.create_map().cast("map<string,string>")
    n = nodes.select(F.lit("node").alias("type"), "id", "lat", "lon", empty.alias("tags"), none("array<long>").alias("nodes"), none(refs).alias("refs"))
    w = ways.select(F.lit("way").alias("type"), "id", none("double").alias("lat"), none("double").alias("lon"), "tags", "nodes", none(refs).alias("refs"))
    member = lambda i: F.struct(F.lit("way").alias("type"), i.alias("id"), F.lit("house").alias("role"))
    streets = ways.where(F.col("id") % 4 == 1)
    r = streets.select(F.lit("relation").alias("type"), "id", none("double").alias("lat"), none("double").alias("lon"), F.create_map(F.lit("type"), F.lit("associatedStreet"), F.lit("name"), F.concat(F.lit("Street "), F.col("id"))).alias("tags"), none("array<long>").alias("nodes"), F.array(member(F.col("id"))).alias("refs"))
    lost = r.withColumns({"id": F.col("id") + 1_000_000, "refs": F.array(F.struct(F.lit("node").alias("type"), F.lit(-1).cast("long").alias("id"), F.lit("").alias("role")))})
    inner = lambda level: F.when(level < 4, F.struct(F.lit("relation").alias("type"), (F.col("id") * 10 + level + 10_000_001).alias("id"), F.lit("").alias("role"))).otherwise(F.struct(F.lit("node").alias("type"), (F.col("id") * 10).alias("id"), F.lit("").alias("role")))
    kind = F.when(F.col("level") == 0, "associatedStreet").otherwise("part")
    levels = ways.where(F.col("id") % 4 == 2).withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(4))))
    deep = levels.select(
        F.lit("relation").alias("type"), (F.col("id") * 10 + F.col("level") + 10_000_000).alias("id"), none("double").alias("lat"), none("double").alias("lon"),
        F.create_map(F.lit("type"), kind, F.lit("name"), F.concat(F.lit("Deep "), F.col("id"))).alias("tags"), none("array<long>").alias("nodes"), F.array(inner(F.col("level"))).alias("refs"),
    )
    found = osm_graph.osm_addresses(n.unionByName(w).unionByName(r).unionByName(lost).unionByName(deep))
    return found.select(F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "number", "street")


@query(f"{ADDR} select lat, lon, number, street, unit, city, district, region, postcode from addr")
def q_sqlite_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store with all addresses, written here row by row and read by ranges of rowid."""
    path = shared_file(spark, "addresses.db")
    with sqlite3.connect(path) as db:
        db.execute(f"CREATE TABLE addresses (lat REAL, lon REAL, {', '.join(f'{f} TEXT' for f in TEXT_FIELDS)})")
        db.executemany("INSERT INTO addresses VALUES (?, ?, ?, ?, ?, ?, ?, ?, ?)", map(tuple, addresses(spark, sf_dir).select(*FIELDS).toLocalIterator()))
        db.execute("INSERT INTO addresses (lat, lon, number) VALUES ('north', 2.5, '1')")
    db.close()
    return read_sqlite(spark, path, rows=500).drop("_position")


def pbf_blobs(nodes: Iterable[tuple[int, float, float, dict[str, str]]], most: int = 8000) -> Iterator[bytes]:
    """Blobs of an extract with these nodes, field by field: sparse and dense ones in turn."""

    def varint(n: int) -> bytes:
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    field = lambda k, data: varint(k << 3 | 2) + varint(len(data)) + data
    whole = lambda k, n: varint(k << 3) + varint(n)
    zigzag = lambda n: n << 1 if n >= 0 else (-n << 1) - 1
    packed = lambda numbers: b"".join(map(varint, numbers))
    steps = lambda numbers: packed(zigzag(b - a) for a, b in zip([0, *numbers], numbers))
    rows, dense = iter(nodes), False
    while some := list(islice(rows, most)):
        strings = {"": 0}
        number = lambda x: strings.setdefault(x, len(strings))  # noqa: E731, B023
        tagged = [([number(k) for k in tags], [number(v) for v in tags.values()]) for *_, tags in some]
        places = [(i, round(lat * 1e7), round(lon * 1e7)) for i, lat, lon, _ in some]
        if dense:
            ids, lats, lons = zip(*places, strict=True)
            flat = [x for keys, values in tagged for x in (*(y for pair in zip(keys, values) for y in pair), 0)]
            group = field(2, field(1, steps(ids)) + field(8, steps(lats)) + field(9, steps(lons)) + field(10, packed(flat)))
        else:
            group = b"".join(field(1, whole(1, zigzag(i)) + field(2, packed(keys)) + field(3, packed(values)) + whole(8, zigzag(lat)) + whole(9, zigzag(lon))) for (i, lat, lon), (keys, values) in zip(places, tagged))
        block = field(1, b"".join(field(1, x.encode()) for x in strings)) + field(2, group)
        blob = field(3, zlib.compress(block)) + whole(2, len(block))
        header = field(1, b"OSMData") + whole(3, len(blob))
        yield struct.pack(">I", len(header)) + header + blob
        dense = not dense


@query(f"{ADDR} select round(lat, 6) as lat, round(lon, 6) as lon, number, street, city from addr where id % 3 <> 0")
def q_pbf_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of an extract with all addresses as nodes, written here; a third of them have too long a number."""
    path = shared_file(spark, "all.osm.pbf")
    number = F.when(F.col("id") % 3 == 0, F.lit("123456789")).otherwise(F.col("number"))
    rows = addresses(spark, sf_dir).select("id", "lat", "lon", number.alias("number"), "street", "city").toLocalIterator()
    tags = lambda r: {"addr:housenumber": r.number, "addr:street": r.street, "shop": "y"} | ({"addr:city": r.city} if r.city else {})
    with open(path, "wb") as f:
        for blob in pbf_blobs(((r.id, r.lat, r.lon, tags(r)) for r in rows), 400):
            f.write(blob)
    found = osm_graph.osm_addresses(read_pbf(spark, path))
    return found.select(F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "number", "street", "city")
