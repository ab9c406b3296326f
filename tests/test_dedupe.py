import random
import re

import pytest
from pyspark.sql import functions as F

from postmill.functions.geo import cell_x
from postmill.operators import dedupe
from postmill.operators.store import AddressStore
from postmill.schema import FIELDS

from known_addresses import DIFFERENT, SPELLINGS

SCHEMA = "id long, rank double, lat double, lon double, number string, street string, unit string, city string, district string, region string, postcode string"

def frame(spark, rows, ranks=None):
    return spark.createDataFrame([(i, (ranks or {}).get(i, 1.0), a, b, n, s, None, c, None, None, p) for i, (a, b, n, s, c, p) in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("seed", [None, 1, 2, 3])
def test_spellings_collapse_in_any_order(spark, seed):
    rows = list(SPELLINGS)
    if seed:
        random.Random(seed).shuffle(rows)
    assert len(rows) == 26
    kept = dedupe.survivors(frame(spark, rows)).collect()
    assert len(kept) == 10 and len({(r.number, r.street.lower()[:2], round(r.lat, 2)) for r in kept}) == 10


@pytest.mark.parametrize("copies", [1, 10])
def test_different_addresses_stay(spark, copies):
    rows = DIFFERENT * copies
    random.Random(copies).shuffle(rows)
    assert len(DIFFERENT) == 109
    kept = dedupe.survivors(frame(spark, rows)).collect()
    assert sorted((r.lat, r.lon, r.number, r.street, r.city or "") for r in kept) == sorted((a, b, n, t, c or "") for a, b, n, t, c, _ in DIFFERENT)


def test_far_north_neighbours_two_cells_apart_are_compared(spark):
    # At 79 degrees cells are 0.93 km wide: these are 932 m apart, in cells that have one between them.
    width = 360 / 8192
    rows = [(79.0, -180 + (9 + 0.999) * width, "1", "Rue A", "X", "1"), (79.0, -180 + (11 + 0.0) * width, "1", "Rue A", "X", "1")]
    cells = {r.cx for r in frame(spark, rows).select(cell_x(F.col("lon")).alias("cx")).collect()}
    assert max(cells) - min(cells) == 2
    assert [r.id for r in dedupe.survivors(frame(spark, rows)).collect()] == [1]
    same = [(79.0, -180 + 0.01 * width, "1", "Rue A", "X", "1"), (79.0, 180 - 1.0 * width, "1", "Rue A", "X", "1")]
    assert dedupe.survivors(frame(spark, same)).count() == 1


def test_copies_leave_one(spark):
    rows = [(48.0 + i, 2.0, str(i), "Rue A", "X", "1") for i in range(6)]
    assert dedupe.survivors(frame(spark, rows * 4)).count() == 6


def test_near_but_other_number_or_street(spark):
    rows = [(48.580068, -2.057383, "2E", "Rue Jean Boyer", "P", "35730"), (48.579941, -2.057431, "2D", "Rue Jean Boyer", "P", "35730"), (48.58007, -2.05738, "2E", "Rue du Port", "P", "35730")]
    assert dedupe.survivors(frame(spark, rows)).count() == 3


def test_chain_keeps_both_ends(spark):
    # A and B, B and C are under 100 m apart, A and C are not; the order is A, B, C.
    rows = [(48.0, 2.0, "1", "Rue Longue", None, None), (48.0008, 2.0, "1", "Rue Longue", None, None), (48.0016, 2.0, "1", "rue longue", None, None)]
    kept = dedupe.survivors(frame(spark, rows, {0: 3.0, 1: 2.0, 2: 1.0}))
    assert sorted(r.id for r in kept.collect()) == [0, 2]


def test_blocks_decide_on_their_own(spark):
    # B loses to A in the blocks that hold both, and still beats C in a block without A.
    rows = [(48.0, lon, "1", "Rue Longue", None, None) for lon in (-0.0001, 0.0001, 0.00135)]
    blocks = {r.hash: set() for r in dedupe.hashes(frame(spark, rows)).collect()}
    for r in dedupe.hashes(frame(spark, rows)).collect():
        blocks[r.hash].add(r.address)
    assert {1, 2} in blocks.values()
    kept = dedupe.survivors(frame(spark, rows, {0: 3.0, 1: 2.0, 2: 1.0}))
    assert sorted(r.id for r in kept.collect()) == [0]


def test_equal_rank_later_row_wins(spark):
    rows = [(48.0, 2.0, "1", "Rue A", None, None)] * 2
    assert [r.id for r in dedupe.survivors(frame(spark, rows)).collect()] == [1]


def test_oversized_blocks(spark):
    rows = [(48.0, 2.0, "1", "Rue A", None, None)] * 5 + [(10.0, 2.0, "2", "Rue B", None, None)]
    assert [r.id for r in dedupe.survivors(frame(spark, rows), limit=4).collect()] == [5]
    assert dedupe.survivors(frame(spark, rows), limit=4, oversize="keep_all").count() == 6
    with pytest.raises(ValueError):
        dedupe.to_delete(frame(spark, rows), oversize="other")


def test_empty_and_collisions(spark):
    none = frame(spark, SPELLINGS).limit(0)
    assert dedupe.survivors(none).count() == 0
    assert dedupe.count_collisions(dedupe.hashes(none)).first().n == 0


def test_plan_has_no_product_and_no_python(spark):
    for found in (dedupe.survivors(frame(spark, SPELLINGS)), dedupe.duplicate_pairs(frame(spark, SPELLINGS))):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan


def broadcast(monkeypatch, addresses, **options):
    """Lines of all plans of a deduplication that broadcast a side of a join, but for the oversized blocks, which are counted."""
    planned, cut = [], dedupe.cut
    with monkeypatch.context() as m:
        m.setattr(dedupe, "cut", lambda df: planned.append(df) or cut(df))
        planned.append(dedupe.survivors(addresses, **options))
    assert len(planned) == 3
    lines = [line for df in planned for line in df._jdf.queryExecution().executedPlan().toString().splitlines()]
    assert any("SortMergeJoin" in line for line in lines)
    return [line for line in lines if "Broadcast" in line and "Join" in line and not re.search(r"\[hash#\d+L\], \[hash#\d+L\], Left(Semi|Anti), BuildRight", line)]


@pytest.mark.parametrize("limit", [5000, 25])
def test_copies_are_not_broadcast(spark, monkeypatch, tmp_path, limit):
    # An estimate of their size leaves out the explode, so it is under the limit of a broadcast however many copies there are.
    frame(spark, SPELLINGS).write.parquet(f"{tmp_path}/one")
    ten = spark.read.parquet(f"{tmp_path}/one").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(9)))).withColumn("id", F.col("id") + F.col("copy") * 1000).drop("copy")
    assert broadcast(monkeypatch, ten, limit=limit) == []


def test_a_store_of_batches_is_not_broadcast(spark, monkeypatch, tmp_path):
    # Parquet packs addresses into a few bytes each, so an estimate of a store's size is far too small.
    kept, rows = AddressStore(spark, f"{tmp_path}/store"), frame(spark, SPELLINGS)
    for low in (0, 1):
        kept.add(rows.where(F.col("id") % 2 == low).select(*FIELDS, F.lit("osm").alias("source"), F.col("id").alias("_order")))
    assert broadcast(monkeypatch, kept.addresses()) == []
    assert kept.deduplicated().count() == 10


def test_pairs_are_found_once(spark):
    pairs = dedupe.duplicate_pairs(frame(spark, SPELLINGS))
    assert pairs.count() == pairs.distinct().count()
    assert pairs.where(F.col("better") == F.col("worse")).count() == 0


def test_a_matcher_of_ones_own(spark):
    kept = dedupe.survivors(frame(spark, SPELLINGS), matches=lambda a, b: (a("street") == b("street")) & (a("number") == b("number")))
    assert kept.count() == len({(n, s) for _, _, n, s, _, _ in SPELLINGS})


def folded(rows, pairs, limit, oversize):
    """Ids that lose, by plain loops over all blocks with all their members."""
    rank, beside, blocks = {r.id: r.rank for r in rows.collect()}, {(r.better, r.worse) for r in pairs.collect()}, {}
    for r in dedupe.hashes(rows).collect():
        blocks.setdefault(r.hash, []).append(r.address)
    lost = set()
    for members in blocks.values():
        kept = []
        for m in sorted(members, key=lambda m: (rank[m], m), reverse=True) if len(members) <= limit else []:
            (lost.add if any((k, m) in beside for k in kept) else kept.append)(m)
        if len(members) > limit and oversize == "delete_all":
            lost |= set(members)
    return lost


def both_streets(a, b):
    return dedupe.is_duplicate(a, b) & (a("street") != b("street"))


@pytest.mark.parametrize(
    "limit, oversize, matches",
    [(5000, "delete_all", dedupe.is_duplicate), (11, "delete_all", dedupe.is_duplicate), (11, "keep_all", dedupe.is_duplicate), (5000, "delete_all", both_streets)],
)
def test_copies_are_settled_as_by_plain_loops(spark, limit, oversize, matches):
    # Some can't stand for their copies: without street, without place, in no block, in oversized blocks only, or not alike by the matcher.
    odd = [(48.0, 2.0, "1", None, "X", "1"), (None, 2.0, "1", "Rue A", "X", "1"), (48.0, 2.0, "", "", "X", "1"), (48.0, 2.0, None, "Rue A", "X", "1")]
    rows = SPELLINGS * 3 + odd * 3 + [(47.0, 1.0, "1", "Rue A", "X", "1")] * 12 + [(47.0, 1.04, "1", "Rue A", "X", "1")] * 2
    random.Random(4).shuffle(rows)
    addresses = frame(spark, rows, {i: float(i % 2) for i in range(len(rows))})
    options = {"limit": limit, "oversize": oversize, "matches": matches}
    lost = folded(addresses, dedupe.duplicate_pairs(addresses, matches=matches), limit, oversize)
    assert 0 < len(lost) < len(rows)
    assert sorted(r.address_id for r in dedupe.to_delete(addresses, **options).collect()) == sorted(lost)
    assert sorted(r.id for r in dedupe.survivors(addresses, **options).collect()) == sorted(set(range(len(rows))) - lost)


def test_copies_do_not_meet(spark, monkeypatch):
    # Ten copies have as many pairs as one; as pairs of their own they'd be 100 times as many.
    counts, pairs = [], dedupe.duplicate_pairs
    monkeypatch.setattr(dedupe, "duplicate_pairs", lambda *a: counts.append((found := pairs(*a)).count()) or found)
    one = frame(spark, SPELLINGS)
    ten = one.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(9)))).withColumn("id", F.col("id") + F.col("copy") * 1000)
    assert dedupe.survivors(one).count() == dedupe.survivors(ten).count() == 10
    assert counts[0] == counts[1] > 0


def test_keys_are_computed_once_for_all_cells(spark, tmp_path):
    frame(spark, SPELLINGS).write.parquet(f"{tmp_path}/one")
    plan = dedupe.hashes(spark.read.parquet(f"{tmp_path}/one"))._jdf.queryExecution().executedPlan().toString().splitlines()
    cells = next(i for i, line in enumerate(plan) if "Generate" in line)
    assert [i > cells for i, line in enumerate(plan) if "translate(" in line] == [True]
