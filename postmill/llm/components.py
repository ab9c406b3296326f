"""Connected components of a large, unordered set of links, by star contraction.

Each round hangs the larger neighbours of a node on the least node that it knows (large star)
and then the smaller ones (small star), until nothing changes; links are then stars around the
least node of their component. All rounds are joins and grouped minima. Grouped minima are partial
aggregations; in the joins the links of a node with over `hot_links` of them are dealt to several
tasks (see `spread_join`), and nothing is gathered on the driver but three sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import cut, spread_join


def trees(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) reduced to one star for each connected set: nodes and the set's least node."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root) and np.array_equal(root[x], root[y]):
            break
        root = new
    own = root != np.arange(len(nodes))
    return nodes[own], nodes[root[own]]


def _in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = list(batches)
    a, b = (np.concatenate([x.column(c).to_numpy() for x in held] or [np.zeros(0, np.int64)]) for c in ("a", "b"))
    nodes, roots = trees(a, b)
    for at in range(0, len(nodes), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(x[at : at + 100_000]) for x in (nodes, roots)], names=["node", "root"])


def _star(links: DataFrame, larger_only: bool, hot_links: int, spread: bool) -> DataFrame:
    """One step over links (a, b): the neighbours of each a that take part are linked to the least one."""
    known = links.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    least = known.select("a", F.least("a", "m").alias("m"))
    hot = known.where(F.col("n") > hot_links).select("a", F.ceil(F.col("n") / F.lit(hot_links)).alias("salts")) if spread else None
    out = spread_join(links, least, "a", hot)
    if larger_only:
        out = out.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = out.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") > F.col("b")).distinct()


def components(links: DataFrame, rounds: int = 60, hot_links: int = 1_000_000, few_links: int = 500_000) -> DataFrame:
    """(node, root) for each node of links (a, b), longs, that isn't the least of its component.

    Up to `few_links` links (16 bytes each) are settled in one task; more of them by rounds over all tasks.

    Null ends and links of a node with itself are left out; repeated links count once. No links
    give no rows.
    """
    kept = cut(
        links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    n, most = kept.groupBy("b").count().agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).first()
    if n <= few_links:
        return kept.coalesce(1).mapInArrow(_in_one_task, "node long, root long")
    before = None
    for _ in range(rounds):
        both = kept.unionByName(kept.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # A step can gather the neighbours of several nodes on one; the small star gets those of the large one.
        wide = most > hot_links / 4
        large = cut(_star(both, True, hot_links, wide)) if wide else _star(both, True, hot_links, False)
        kept = cut(_star(large, False, hot_links, wide))
        by_root = kept.groupBy("b").agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"))
        n, s, most = by_root.agg(F.sum("n"), F.sum("s"), F.coalesce(F.max("n"), F.lit(0))).first()
        if (n, s) == before:
            return kept.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = n, s
    raise RuntimeError(f"links didn't settle in {rounds} rounds")
