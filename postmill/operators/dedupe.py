"""Block-wise greedy deduplication.

An address is in the nine blocks (its key, a cell around it). Within each block on its own, members
are taken from the highest (rank, id) down; one is deleted if it duplicates a kept member. All
blocks' deletions together go. Blocks above the limit aren't compared: all their members go ("delete_all")
or none ("keep_all").

What the plan does instead of comparing all pairs of each block:

* exact copies are counted, and one stands for all of them (see copies.py);
* blocks are counted with partial sums, and members of oversized blocks settled without meeting;
* each pair of close addresses is compared once, where the home cell of the better one meets the
  neighbourhood of the other, and not once for each of up to nine shared blocks;
* only addresses that have a duplicate at all are dealt to their blocks, where a fold over at most
  `limit` members decides with the ids of each one's duplicates;
* its joins are merged by hint: Spark's estimate of a size leaves out what an explode multiplies and how
  far Parquet packs the rows, so it would broadcast millions of rows through the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.functions.compare import KEYS, is_duplicate, with_keys
from postmill.functions.geo import around, cell_x, cell_y
from postmill.functions.text import core, expand, fold, number_key
from postmill.operators.copies import alike, apart
from postmill.operators.cutting import cut
from postmill.schema import FIELDS, LARGEST_BLOCK


#: Degrees from which on a cell is less than 1 km wide, with some room.
NARROW = 77.0
#: So many oversized blocks, as counted, are broadcast.
FEW = 100_000


def block_keys(addresses: DataFrame, *more: str) -> DataFrame:
    """(address, key, cx, cy) of every block, with `more` columns; addresses with an empty key or no place have none."""
    key = F.concat_ws("|", number_key(F.col("number")), core(expand(fold(F.col("street")))))
    place = F.when((F.col("key") != "|") & F.col("lat").isNotNull() & F.col("lon").isNotNull(), around(cell_x(F.col("lon")), cell_y(F.col("lat"))))
    # The key has a projection of its own and rows without place go after the outer explode: else Spark computes the key again for each cell, or for a filter.
    keyed = addresses.select(F.col("id").alias("address"), key.alias("key"), "lat", "lon", *more)
    return keyed.withColumn("c", F.explode_outer(place)).where(F.col("c").isNotNull()).select("address", "key", "c.cx", "c.cy", *more)


def hashes(addresses: DataFrame, *more: str) -> DataFrame:
    """Distinct (address, hash) of all blocks, with `more` columns."""
    return block_keys(addresses, *more).select("address", F.xxhash64("key", "cx", "cy").alias("hash"), *more)


def collisions(blocks: DataFrame) -> DataFrame:
    """(address, key, cx, cy) of blocks of two or more."""
    shared = blocks.groupBy("key", "cx", "cy").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return blocks.join(shared, ["key", "cx", "cy"], "left_semi")


def collisions_by_pairs(blocks: DataFrame) -> DataFrame:
    """The same rows, as those for which another address in the block exists."""
    other = blocks.select(F.col("address").alias("other"), F.col("key").alias("k"), F.col("cx").alias("x"), F.col("cy").alias("y"))
    return blocks.join(other, (F.col("key") == F.col("k")) & (F.col("cx") == F.col("x")) & (F.col("cy") == F.col("y")) & (F.col("address") != F.col("other")), "left_semi")


def in_order(blocks: DataFrame, addresses: DataFrame) -> DataFrame:
    """blocks with `place`: 1 for the member that a block takes first, by rank and id from the highest down."""
    ranked = blocks.join(addresses.select(F.col("id").alias("address"), "rank"), "address")
    order = Window.partitionBy("key", "cx", "cy").orderBy(F.desc("rank"), F.desc("address"))
    return ranked.withColumn("place", F.row_number().over(order)).drop("rank")


def oversized_report(blocks: DataFrame, limit: int = LARGEST_BLOCK, most: int = 10) -> DataFrame:
    """(key, cx, cy, n, address, place): the first `most` members by id of each block above the limit, which has n members."""
    key = ["key", "cx", "cy"]
    counts = blocks.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > limit)
    place = F.row_number().over(Window.partitionBy(*key).orderBy("address"))
    return blocks.join(counts, key).withColumn("place", place).where(F.col("place") <= most).select(*key, "n", "address", "place")


def count_collisions(blocks: DataFrame) -> DataFrame:
    """One row: how many (address, hash) are in a block of two or more."""
    shared = blocks.groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    return shared.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def oversized(blocks: DataFrame, limit: int = LARGEST_BLOCK, members: Column | None = None) -> DataFrame:
    """(hash, n) of blocks with more members than the limit; `members` counts them, one a row if it isn't given."""
    counts = blocks.groupBy("hash").agg((F.count("*") if members is None else members).alias("members"))
    return counts.where(F.col("members") > limit).withColumnRenamed("members", "n")


#: Whether the addresses of two rows are the same, given a column of each by its name (`a.`, `b.` in joins).
Matcher = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


def duplicate_pairs(addresses: DataFrame, blocks: DataFrame | None = None, matches: Matcher = is_duplicate) -> DataFrame:
    """(better, worse): each pair of duplicates once, the one with the higher (rank, id) first.

    `blocks` limits the comparison to addresses that are in some of these blocks. `matches` may be a matcher of one's own
    over the fields and the keys of `with_keys`.
    """
    keyed = with_keys(addresses.select("id", "rank", *FIELDS))
    if blocks is not None:
        keyed = keyed.join(blocks.select(F.col("address").alias("id")).distinct().hint("merge"), "id", "left_semi")
    keyed = keyed.withColumn("k_block", F.xxhash64("k_number", "k_core")).select("id", "rank", *FIELDS, *KEYS, "k_block", cell_x(F.col("lon")).alias("cx"), cell_y(F.col("lat")).alias("cy"))
    a = keyed.alias("a")
    # Two addresses may share a block two cells apart; towards the poles that can be within reach.
    near = F.when(F.abs("lat") < NARROW, around(F.col("cx"), F.col("cy"))).otherwise(around(F.col("cx"), F.col("cy"), 2))
    b = keyed.withColumn("c", F.explode(near)).withColumns({"cx": F.col("c.cx"), "cy": F.col("c.cy")}).drop("c").alias("b")
    of = lambda side: lambda name: F.col(f"{side}.{name}")
    better = (F.col("a.rank") > F.col("b.rank")) | (F.col("a.rank") == F.col("b.rank")) & (F.col("a.id") > F.col("b.id"))
    meet = (F.col("a.k_block") == F.col("b.k_block")) & (F.col("a.cx") == F.col("b.cx")) & (F.col("a.cy") == F.col("b.cy"))
    return a.join(b.hint("merge"), meet & better & matches(of("a"), of("b"))).select(F.col("a.id").alias("better"), F.col("b.id").alias("worse"))


def settled(addresses: DataFrame, limit: int, oversize: str, matches: Matcher) -> tuple[DataFrame, DataFrame, bool]:
    """Addresses that met (id, rank and the fields), distinct address_id of those of them that lose in some block, and
    whether there are others: copies for which one has met, and which are lost."""
    if oversize not in ("delete_all", "keep_all"):
        raise ValueError("oversize is delete_all or keep_all")
    rows = alike(addresses)
    big = cut(oversized(hashes(rows, "n"), limit, F.sum("n")).select("hash"))
    n_big = big.count()
    some_big, big = n_big > 0, F.broadcast(big) if n_big <= FEW else big.hint("merge")
    alive = lambda frame: frame.join(big, "hash", "left_anti") if some_big else frame
    copied = not rows.where("n > 1").isEmpty()
    compared = alive(hashes(rows)).select(F.col("address").alias("id")) if some_big and oversize == "keep_all" else None
    met = apart(addresses, rows, matches, compared) if copied else rows.drop("n")
    blocks = hashes(met)
    pairs = cut(duplicate_pairs(met, alive(blocks) if some_big else None, matches))
    near = pairs.groupBy("worse").agg(F.collect_list("better").alias("near")).hint("merge")
    members = pairs.select(F.col("better").alias("id")).unionByName(pairs.select(F.col("worse").alias("id"))).distinct()
    involved = met.join(members.hint("merge"), "id", "left_semi")
    ranked = involved.select("id", "rank").join(near, F.col("id") == near.worse, "left").select("id", F.struct("rank", "id", F.coalesce("near", F.array().cast("array<bigint>")).alias("near")).alias("m"))
    dealt = alive(hashes(involved)).join(ranked.hint("merge"), F.col("address") == F.col("id")).select("hash", "m")
    ordered = F.reverse(F.array_sort(F.collect_list("m")))
    kept = F.aggregate("pack", F.array().cast("array<bigint>"), lambda k, m: F.when(F.arrays_overlap(k, m["near"]), k).otherwise(F.array_append(k, m["id"])))
    packs = dealt.groupBy("hash").agg(ordered.alias("pack")).where(F.size("pack") > 1)
    lost = packs.select(F.explode(F.array_except(F.transform("pack", lambda m: m["id"]), kept)).alias("address_id"))
    if oversize == "delete_all":
        lost = lost.unionByName(blocks.join(big, "hash", "left_semi").select(F.col("address").alias("address_id")))
    return met, lost.distinct(), copied


def to_delete(addresses: DataFrame, limit: int = LARGEST_BLOCK, oversize: str = "delete_all", matches: Matcher = is_duplicate) -> DataFrame:
    """Distinct address_id of all addresses that lose in some block."""
    met, lost, copied = settled(addresses, limit, oversize, matches)
    if copied:
        lost = lost.unionByName(addresses.select(F.col("id").alias("address_id")).join(met.select(F.col("id").alias("address_id")).hint("merge"), "address_id", "left_anti"))
    return lost


def survivors(addresses: DataFrame, limit: int = LARGEST_BLOCK, oversize: str = "delete_all", matches: Matcher = is_duplicate) -> DataFrame:
    """The rows of addresses (id, rank and the fields) that aren't deleted."""
    met, lost, copied = settled(addresses, limit, oversize, matches)
    lost = lost.hint("merge")
    if copied:
        kept = met.select(F.col("id").alias("kept")).join(lost, F.col("kept") == lost.address_id, "left_anti")
        return addresses.join(kept.hint("merge"), addresses.id == kept.kept, "left_semi")
    return addresses.join(lost, addresses.id == lost.address_id, "left_anti")
