"""Exact copies, settled without meeting.

Rows with the same fields and rank are in the same blocks and match the same rows. Where such a row also matches
itself, a block keeps its copy with the highest id at most: if that one is kept it deletes the others, and what deletes
it deletes them too. So it stands for all of them, and the others are deleted in any block that is compared or goes as a
whole; n copies would have n(n-1)/2 pairs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions.compare import with_keys
from postmill.operators.cutting import cut
from postmill.schema import FIELDS

ALIKE = ("rank", *FIELDS)


def alike(addresses: DataFrame) -> DataFrame:
    """(id, rank, fields, n): each different row once, with the highest id and the number of its copies; computed once."""
    return cut(addresses.groupBy(*ALIKE).agg(F.max("id").alias("id"), F.count("*").alias("n")).select("id", *ALIKE, "n"))


def apart(addresses: DataFrame, rows: DataFrame, matches: Callable, compared: DataFrame | None = None) -> DataFrame:
    """(id, rank, fields) of all that has to meet: the rows of `alike`, and all copies of a row that can't stand for them.

    One can't if it doesn't match itself or is in no block; with `compared`, if its id isn't in there.
    """
    own = lambda name: F.col(name)
    in_blocks = F.col("lat").isNotNull() & F.col("lon").isNotNull() & (F.concat_ws("|", "k_number", "k_core") != "|")
    stands = F.col("rank").isNotNull() & in_blocks & matches(own, own)
    several = rows.where("n > 1")
    loose = with_keys(several).where(~F.coalesce(stands, F.lit(False))).select("id", *ALIKE)
    if compared is not None:
        loose = loose.unionByName(several.join(compared.hint("merge"), "id", "left_anti").select("id", *ALIKE)).distinct()
    if loose.count() == 0:
        return rows.select("id", *ALIKE)
    same: Column = F.lit(True)
    for name in ALIKE:
        same = same & F.col(f"x.{name}").eqNullSafe(F.col(f"y.{name}"))
    each = addresses.select("id", *ALIKE).alias("x").join(loose.drop("id").hint("merge").alias("y"), same, "left_semi")
    return cut(rows.join(loose.select("id").hint("merge"), "id", "left_anti").select("id", *ALIKE).unionByName(each))
