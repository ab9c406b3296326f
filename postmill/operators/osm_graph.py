"""Addresses of OpenStreetMap objects: nodes, ways by their position, members of street relations.

Objects are selected by their tags, then ways and relations are resolved by joins on their ordered
children. An object with a missing child gives nothing, at any depth. Selected nodes always give an
address of their own; ways and relations that a wanted relation refers to come through it alone, with
its name as street. Relations in relations are followed as deep as they go; those without a name
give nothing, cycles never resolve.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions.geo import centroid
from postmill.operators.cutting import cut
from postmill.schema import FIELDS, TEXT_FIELDS

NUMBER, STREET = "addr:housenumber", "addr:street"
#: Tags that are kept, by type of object.
KEPT_TAGS = {
    "node": (NUMBER, STREET, "addr:unit", "addr:city", "addr:district", "addr:region", "addr:postcode", "name"),
    "way": (NUMBER, STREET),
    "relation": ("name",),
}
TAG_OF = {"number": NUMBER, **{f: f"addr:{f}" for f in TEXT_FIELDS if f != "number"}}
LONGEST_NUMBER = 8


def tag(name: str) -> Column:
    return F.try_element_at("tags", F.lit(name))


def valid_number() -> Column:
    """A house number of at most eight bytes."""
    return F.coalesce(F.octet_length(tag(NUMBER)) <= LONGEST_NUMBER, F.lit(False))


def is_root() -> Column:
    """Whether an object is an address or a street by its own tags."""
    addressed = valid_number() & tag(STREET).isNotNull()
    street = (F.size("refs") > 0) & (tag("type") == "associatedStreet") & tag("name").isNotNull()
    return F.coalesce(F.when(F.col("type") == "node", addressed).when(F.col("type") == "way", addressed & (F.size("nodes") > 0)).when(F.col("type") == "relation", street), F.lit(False))


def pruned_tags() -> Column:
    keep = lambda kind: F.map_filter("tags", lambda k, _: k.isin(*KEPT_TAGS[kind]))
    return F.when(F.col("type") == "node", keep("node")).when(F.col("type") == "way", keep("way")).otherwise(keep("relation"))


def as_address(frame: DataFrame, street: Column | None = None) -> DataFrame:
    """Address fields from tags, lat and lon; a given street overrides the tag."""
    texts = [(street if street is not None and f == "street" else tag(t)).alias(f) for f, t in TAG_OF.items()]
    return frame.select("lat", "lon", *texts).select(*FIELDS)


def placed_ways(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, tags, lat, lon) of ways with all their nodes; without a position (an open or broken ring) lat and lon are null."""
    children = ways.select("id", F.posexplode("nodes").alias("pos", "child"))
    found = children.join(nodes.select(F.col("id").alias("child"), "lat", "lon"), "child")
    points = found.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "lat", "lon"))).alias("points"))
    joined = ways.join(points, "id", "left").withColumn("points", F.coalesce("points", F.array().cast("array<struct<pos:int,lat:double,lon:double>>")))
    whole = joined.where(F.size("points") == F.greatest(F.size(F.coalesce("nodes", F.array().cast("array<bigint>"))), F.lit(0)))
    place = F.when(F.size("points") > 0, centroid(F.col("points")))
    return whole.withColumn("place", place).select("id", "tags", F.col("place.lat").alias("lat"), F.col("place.lon").alias("lon"))


def osm_addresses(objects: DataFrame) -> DataFrame:
    """Addresses of a frame of objects (see the PBF reader for its columns), which are read once and kept by type."""
    kept = cut(objects)
    marked = kept.withColumn("root", is_root())
    of = lambda kind: marked.where(F.col("type") == kind).withColumn("tags", pruned_tags())
    nodes, ways, relations = of("node"), of("way"), of("relation")

    # Members of wanted relations: the selected ones and, level by level, the relations in them.
    edges = cut(relations.select(F.col("id").alias("parent"), F.explode("refs").alias("r")).select("parent", F.col("r.type").alias("kind"), F.col("r.id").alias("child")))
    level = wanted = cut(relations.where("root").select("id"))
    while True:  # a relation is new once, so cycles come to an end
        inner = edges.where(F.col("kind") == "relation").join(level, edges.parent == level.id, "left_semi").select(F.col("child").alias("id")).distinct()
        level = cut(inner.join(wanted, "id", "left_anti"))
        if level.isEmpty():
            break
        wanted = cut(wanted.unionByName(level))
    own = cut(edges.join(wanted, edges.parent == wanted.id, "left_semi"))
    refs = own.select("kind", "child").distinct()
    way_refs = refs.where(F.col("kind") == "way").select(F.col("child").alias("id"))

    needed = ways.join(way_refs, "id", "left_semi").unionByName(ways.where("root").join(way_refs, "id", "left_anti"))
    placed = cut(placed_ways(needed, nodes))
    node_refs = refs.where(F.col("kind") == "node").select(F.col("child").alias("id"))
    wanted_nodes = nodes.join(node_refs, "id", "left_semi")
    known = wanted_nodes.select(F.lit("node").alias("kind"), F.col("id").alias("child"), "tags", "lat", "lon").unionByName(placed.select(F.lit("way").alias("kind"), F.col("id").alias("child"), "tags", "lat", "lon"))
    members = cut(own.where(F.col("kind") != "relation").join(known, ["kind", "child"]))

    # A relation is whole once all its children are; its relations one level later each.
    expected = own.groupBy("parent").agg(F.count("*").alias("all"), F.sum((F.col("kind") == "relation").cast("int")).alias("deep"))
    met = members.groupBy("parent").agg(F.count("*").alias("met"))
    state = cut(expected.join(met, "parent", "left").withColumn("met", F.coalesce("met", F.lit(0))))
    whole = state.where((F.col("deep") == 0) & (F.col("met") == F.col("all"))).select("parent")
    deep_edges = own.where(F.col("kind") == "relation").select("parent", "child")
    deep, known_whole = not deep_edges.isEmpty(), -1
    while deep and (n := whole.count()) > known_whole:
        known_whole = n
        done = deep_edges.join(whole.select(F.col("parent").alias("child")), "child").groupBy("parent").agg(F.count("*").alias("done"))
        more = state.where(F.col("deep") > 0).join(done, "parent").where(F.col("met") + F.col("done") == F.col("all")).select("parent")
        whole = cut(whole.unionByName(more).distinct())

    # From the selected relations that no wanted one refers to, down; shared children come once for each parent.
    named = cut(relations.where(tag("name").isNotNull()).select("id", tag("name").alias("street")).join(whole, F.col("id") == whole.parent, "left_semi"))
    inside = refs.where(F.col("kind") == "relation").select(F.col("child").alias("id"))
    turn = relations.where("root").select("id").join(inside, "id", "left_anti").join(named, "id")
    found = []
    while True:
        found.append(as_address(turn.join(members, turn.id == members.parent).select("street", "tags", "lat", "lon"), F.col("street")))
        if not deep:
            break
        turn = cut(turn.select("id").join(deep_edges, turn.id == deep_edges.parent).select(F.col("child").alias("id")).join(named, "id"))
        if turn.isEmpty():
            break
    alone = placed.join(ways.where("root").select("id"), "id", "left_semi").join(way_refs, "id", "left_anti")
    parts = [as_address(nodes.where("root")), as_address(alone), *found]
    return reduce(DataFrame.unionByName, parts).where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
